"""Sources: exported XML files (F4) and binary files with a caller-supplied decoder."""

from __future__ import annotations

import os

import pytest

from eventloom import prepare_events
from eventloom.sources import scan_event_files, scan_event_xml

REC = '<Event><System><TimeCreated SystemTime="2024-01-02 03:04:0{i}"/></System><EventData><Data Name="n">{i}</Data></EventData></Event>'


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_export_files_bad_record_in_middle(spark, tmp_path):
    d = tmp_path / "export"
    d.mkdir()
    for f in range(3):
        recs = [REC.format(i=i) for i in range(5)]
        recs[2] = recs[2].replace("</Event>", "")  # unterminated in the middle
        body = "\n".join(recs)
        _write(d / f"f{f}.xml", f'<?xml version="1.0" encoding="utf-8"?>\n<Events>\n{body}\n</Events>\n')
    recs = scan_event_xml(spark, str(d))
    out = prepare_events(recs).select("source_file", "reason", "shape").collect()
    assert len(out) == 15
    assert sum(r["reason"] == "xml" for r in out) == 3
    assert sum(r["shape"] == "single" for r in out) == 12
    assert {os.path.basename(r["source_file"]) for r in out} == {"f0.xml", "f1.xml", "f2.xml"}


def test_export_file_split_across_tasks(spark, tmp_path):
    """A single file larger than a split is read by several tasks; no record is lost or duplicated."""
    d = tmp_path / "big"
    d.mkdir()
    n = 3000
    body = "\n".join(REC.format(i=i % 10) for i in range(n))
    _write(d / "big.xml", f"<Events>\n{body}\n</Events>\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        recs = scan_event_xml(spark, str(d))
        assert recs.rdd.getNumPartitions() > 4
        out = prepare_events(recs).groupBy("reason").count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r["reason"]: r["count"] for r in out} == {None: n}


def _stub_decode(content: bytes):
    return [line for line in content.decode("utf-8").split("\n") if line]


def test_binary_files_whole_file_mode(spark, tmp_path):
    d = tmp_path / "bin"
    d.mkdir()
    sizes = [3, 0, 7]
    for k, n in enumerate(sizes):
        _write(d / f"e{k}.bin", "".join(REC.format(i=i % 10) + "\n" for i in range(n)))
    recs = scan_event_files(spark, str(d), _stub_decode)
    assert recs.count() == sum(sizes)
    assert prepare_events(recs).where("reason is null").count() == sum(sizes)


def test_binary_files_chunked_mode(spark, tmp_path):
    """Fixed header + fixed-size chunks: each run of chunks is its own task."""
    d = tmp_path / "chunks"
    d.mkdir()
    header, chunk = 16, 512
    recs_per_chunk = 2
    total_chunks = 9
    blob = b"H" * header
    for c in range(total_chunks):
        body = "".join(REC.format(i=(c * recs_per_chunk + j) % 10) + "\n" for j in range(recs_per_chunk)).encode()
        blob += body.ljust(chunk, b"\0")
    (d / "one.bin").write_bytes(blob)

    def decode(head: bytes, chunks: bytes):
        assert head == b"H" * header
        for i in range(0, len(chunks), chunk):
            yield from _stub_decode(chunks[i : i + chunk].rstrip(b"\0"))

    out = scan_event_files(spark, str(d), decode, header_bytes=header, chunk_bytes=chunk, chunks_per_split=2)
    assert out.count() == total_chunks * recs_per_chunk


def test_decoder_error_fails_the_job(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    _write(d / "x.bin", "garbage")

    def boom(content):
        raise ValueError("bad file header")

    with pytest.raises(Exception, match="bad file header"):
        scan_event_files(spark, str(d), boom).count()


def test_chunk_runs_spread_over_tasks(spark, tmp_path):
    """Runs of one file in a folder with a blank and a percent sign: a task each, or as many tasks as asked."""
    d = tmp_path / "with blank %20"
    d.mkdir()
    n, chunk = 60, 256
    (d / "one.bin").write_bytes(b"H" * 16 + b"".join(REC.format(i=i % 10).encode().ljust(chunk) for i in range(n)))

    def decode(head: bytes, chunks: bytes):
        from pyspark import TaskContext

        assert len(chunks) == chunk
        yield f"{TaskContext.get().partitionId()} {chunks.decode().strip()}"

    args = {"header_bytes": 16, "chunk_bytes": chunk, "chunks_per_split": 1}
    for tasks, expected in ((None, n), (15, 15)):
        rows = [r["xml"] for r in scan_event_files(spark, str(d), decode, tasks=tasks, **args).collect()]
        assert len(rows) == n and len({r.split(" ")[0] for r in rows}) >= expected
        assert sorted(r.split(" ", 1)[1] for r in rows) == sorted(REC.format(i=i % 10) for i in range(n))


def test_unknown_store_is_an_error_at_once(spark):
    with pytest.raises(ValueError, match="dbfs"):
        scan_event_files(spark, "dbfs:/x", _stub_decode, header_bytes=16, chunk_bytes=64)


def test_paths_and_schemes():
    from eventloom.sources.ranges import check_readable, scheme_of

    assert [scheme_of(p) for p in ("s3a://b/k", "/a:b/c", "file:/a b", "a/b", "wasbs://x")] == ["s3a", "", "file", "", "wasbs"]
    check_readable(["s3a://b/k", "/x", "file:///x", "hdfs://h/x"])


@pytest.mark.parametrize("split", ["128m", "256"])
def test_file_cut_inside_its_last_record(spark, tmp_path, split):
    """The open piece is rejected wherever the cut lies; files that end with their last record are whole."""
    d = tmp_path / "cut files"
    d.mkdir()
    recs = [REC.format(i=i) for i in range(6)]
    whole = "<Events>" + "".join(recs)
    _write(d / "a.xml", whole[: -len("</Event>")])  # well-formed once closed
    _write(d / "b.xml", whole[:-3])
    _write(d / "c.xml", whole)
    _write(d / "d.xml", whole + "\n</Events>\n")
    _write(d / "e.xml", "")
    _write(d / "f.xml", recs[0][: -len("</Event>")])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        out = prepare_events(scan_event_xml(spark, str(d))).select("source_file", "reason").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    count = {f: [0, 0] for f in "abcdf"}
    for r in out:
        count[os.path.basename(r["source_file"])[0]][r["reason"] is not None] += 1
        assert r["reason"] in (None, "xml")
    assert count == {"a": [5, 1], "b": [5, 1], "c": [6, 0], "d": [6, 0], "f": [0, 1]}


def test_tasks_follow_bytes():
    """Many chunk runs share a task of a split's size; files together smaller than a split still reach every core."""
    from eventloom.sources.event_files import EventFileStreamReader, task_count
    from eventloom.sources.xml_records import EventXmlReader

    assert task_count(60, 60 << 10, 4, 128 << 20) == 60 and task_count(0, 0, 4, 128 << 20) == 1
    assert task_count(100_000, 100_000 << 20, 12, 128 << 20) == 782
    chunks = EventFileStreamReader(["x"], None, None, 4096, 4096, 256, None, None, None, 12, 128 << 20)
    parts = chunks.partitions({}, {f"f{i}": 64 << 10 for i in range(24)})  # 6 GB of chunks
    assert len(parts) == 192 and sum(n for p in parts for _, _, n in p.value) == 24 * (64 << 10)
    files = [(f"f{i}.xml", 10 << 20) for i in range(12)]
    parts = EventXmlReader(["x"], 128 << 20, 1 << 20, None, lambda paths: files, 4).partitions()
    assert len(parts) >= 12 and sum(hi - lo for p in parts for _, lo, hi, _ in p.value) == 120 << 20


def test_chunks_hold_many_records(spark, tmp_path):
    """F5 packs records into chunks, so that what is written follows the records' bytes; each comes back as it was."""
    from eventloom.fixtures import chunk_records, write_event_chunks

    size, n = 4096, 1000
    texts = [REC.format(i=i) + "é\n" * (i % 3) + "x" for i in range(n)] + ["<" + "y" * k for k in (size - 2, size - 9, size - 10, size - 11)]
    write_event_chunks(spark.createDataFrame([(t,) for t in texts], "xml string").repartition(2), str(tmp_path / "c"), size)
    files = [f.read_bytes() for f in (tmp_path / "c").glob("*.txt")]
    assert all(len(b) % size == 0 for b in files) and sum(map(len, files)) < 2 * sum(len(t.encode()) for t in texts)
    found = [x for b in files for lo in range(size, len(b), size) for x in chunk_records(b[lo : lo + size])]
    assert sorted(found) == sorted(texts)
