"""S2 and S1 by byte ranges, in batch and on streams; pushes from streams."""

from __future__ import annotations

import gzip
import json
import os
import re
import shutil

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom import prepare_events
from eventloom.sources import scan_event_xml, stream_event_files, stream_event_xml
from eventloom.sources import xml_records as X
from eventloom.sources.ranges import list_files, read_range, shown
from eventloom.streaming import start_bulk_push

REC = '<Event><System><TimeCreated SystemTime="2024-01-02 03:04:0{i}"/></System><EventData><Data Name="n">{i}</Data></EventData></Event>'


def plain_records(text: bytes) -> list[tuple[int, bytes]]:
    """All records of a whole text: from each start tag to the next end tag, start tag or the end."""
    starts = [m.start() for m in re.finditer(rb"<Event[\s/>]", text)]
    out = []
    for s, after in zip(starts, [*starts[1:], len(text)]):
        end = text.find(b"</Event>", s)
        out.append((s, text[s : end + 8] if 0 <= end and end + 8 <= after else text[s:after]))
    return out


TEXT = st.lists(
    st.sampled_from(["<Event>", "<Event a='1'>", "</Event>", "<Event/>", "</Event >", "<Events>", "</Events>", "<Eve", "nt>", "</Ev", "ent>", "x", "\n", "é", "<", "/"]), max_size=40
).map("".join).map(str.encode)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 30), st.integers(1, 20))
def test_ranges_give_each_record_once(text, split, block):
    read = lambda path, start, size: text[start : start + min(size, block)]
    got = []
    for start in range(0, len(text), split):
        stop = min(start + split, len(text))
        got += X.records_of(X._range_blocks(read, "f", start, stop, len(text)), start, stop, 1 << 20)
    assert got == plain_records(text)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.lists(st.integers(0, 200), max_size=3))
def test_growing_files_give_every_record_in_the_end(text, cuts):
    """Each trigger gives the records that begin in what is new, and before them one that was open where the file ended."""
    read = lambda path, start, size: text[start : start + size]
    seen, got = 0, {}
    for length in sorted({min(c, len(text)) for c in cuts} | {len(text)}):
        cut = lambda path, start, size: read(path, start, min(size, length - start))  # noqa: E731, B023
        start = X.open_start(cut, "f", seen, length, 1 << 20) if 0 < seen < length else seen
        now = list(X.records_of(X._range_blocks(cut, "f", start, length, length), start, length, 1 << 20))
        assert now == [r for r in plain_records(text[:length]) if r[0] >= start]
        got.update(now)
        seen = length
    whole = plain_records(text)
    assert sorted(got) == [at for at, _ in whole]
    assert all(got[at] == r for at, r in whole if r.endswith(b"</Event>"))  # an open one may have been cut in a mark


def test_a_record_beyond_the_limit_is_cut(spark, tmp_path):
    """Bounded memory: the record is handed on cut and rejected, the ones around it load."""
    big = REC.format(i=1).replace("<Data Name", f"<Binary>{'F' * 300_000}</Binary><Data Name", 1)
    (tmp_path / "a.xml").write_text("<Events>" + REC.format(i=0) + big + REC.format(i=2) + "</Events>")
    for split in (1 << 20, 70_000):
        out = prepare_events(scan_event_xml(spark, str(tmp_path), split_bytes=split, max_record=100_000))
        assert sorted((r["reason"] or "", len(r["xml"])) for r in out.select("reason", "xml").collect()) == [("", len(REC) - 4), ("", len(REC) - 4), ("xml", 100_000)]
        assert prepare_events(scan_event_xml(spark, str(tmp_path), split_bytes=split)).where("reason is null").count() == 3


def test_blocks_are_bounded():
    """A file of records and one without any end are read in blocks; what follows a range is read in small ones first."""
    text = b"<Event>" + b"x" * 3_000_000 + (b"</Event>" + b"<Event>" + b"y" * 50) * 1000
    sizes = []

    def read(path, start, size):
        sizes.append(size)
        return text[start : start + size]

    list(X.records_of(X._range_blocks(read, "f", 0, 100, len(text)), 0, 100, 1 << 20))
    assert sizes[0] == 100 and max(sizes) <= X.BLOCK and sum(sizes) < 4_500_000
    sizes.clear()
    found = list(X.records_of(X._range_blocks(read, "f", 3_000_100, 3_010_000, len(text)), 3_000_100, 3_010_000, 1 << 20))
    assert len(found) > 100 and sum(sizes) < 10_000 + (64 << 10) + 1
    sizes.clear()
    assert X.open_start(read, "f", 3_000_000, len(text), 1 << 30) == 0 and max(sizes) <= 3_000_008
    assert X.open_start(read, "f", 3_000_000, len(text), 1 << 20) == 3_000_000  # beyond the limit nothing is looked for


def test_equal_pieces_elsewhere_still_load(spark, tmp_path):
    """A record that equals the cut one byte for byte, but for its end, is a good one."""
    good = REC.format(i=3)
    (tmp_path / "cut.xml").write_text("<Events>" + good * 4 + good[: -len("</Event>")])
    (tmp_path / "late.xml").write_text("<Events>" + good + good[:-3])
    out = prepare_events(scan_event_xml(spark, str(tmp_path))).select("source_file", "reason").collect()
    assert sorted((os.path.basename(r[0])[0], r[1] or "") for r in out) == [("c", "")] * 4 + [("c", "xml"), ("l", ""), ("l", "xml")]


def test_scan_runs_no_job_and_joins_nothing(spark, tmp_path):
    (tmp_path / "cut.xml").write_text(REC.format(i=1) + REC.format(i=2)[:-3])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("scan", "building a scan")
    df = prepare_events(scan_event_xml(spark, str(tmp_path)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not tracker.getJobIdsForGroup("scan")
    spark.sparkContext._jsc.clearJobGroup()
    assert "Join" not in plan and "Exchange" not in plan


def test_offsets_compression_and_small_files(spark, tmp_path):
    d = tmp_path / "many files %20"
    d.mkdir()
    text = "<Events>\n" + "\n".join(REC.format(i=i) for i in range(5)) + "\n" + REC.format(i=6)[:-2]
    with gzip.open(d / "z.xml.gz", "wt") as f:
        f.write(text)
    for k in range(30):
        (d / f"p{k}.xml").write_text(text)
    (d / "_hidden.xml").write_text(text)
    df = scan_event_xml(spark, str(d), offsets=True)
    assert df.columns == ["source_file", "offset", "xml"] and df.rdd.getNumPartitions() < 10
    rows = df.collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r["source_file"], []).append((r["offset"], r["xml"].encode()))
    assert set(by_file) == {shown(str(d / n)) for n in ["z.xml.gz", *[f"p{k}.xml" for k in range(30)]]}
    assert all(sorted(found) == plain_records(text.encode()) for found in by_file.values())
    names = spark.read.text(str(d / "p1.xml")).selectExpr("_metadata.file_path").distinct().collect()
    assert names[0][0] in by_file
    (d / "s.xml.snappy").write_text("x")
    with pytest.raises(Exception, match="compression"):
        scan_event_xml(spark, str(d)).count()


def test_bytes_that_are_no_text(spark, tmp_path):
    (tmp_path / "a.xml").write_bytes(REC.format(i=1).encode() + REC.format(i=2).encode().replace(b">2<", b">\xff\xfe<"))
    assert prepare_events(scan_event_xml(spark, str(tmp_path))).where("reason is null").count() == 2


def test_own_store(spark, tmp_path):
    """A store that is not known is read by the caller's functions."""
    content = (REC.format(i=1) * 3).encode()
    files = lambda paths: [(f"{p}/one.xml", len(content)) for p in paths]
    read = lambda path, start, size: content[start : start + size]
    with pytest.raises(ValueError, match="dbfs"):
        scan_event_xml(spark, "dbfs:/x", read_range=read)
    rows = scan_event_xml(spark, "dbfs:/x", read_range=read, files=files, split_bytes=100).collect()
    assert [r["xml"] for r in rows] == [REC.format(i=1)] * 3 and rows[0]["source_file"] == "dbfs:///x/one.xml"


def test_text_reader_gives_the_same_of_whole_files(spark, tmp_path):
    text = "<Events>" + REC.format(i=1) + REC.format(i=2).replace("</Event>", "") + "<Event/>" + REC.format(i=3) + "</Events>"
    (tmp_path / "a.xml").write_text(text)
    both = [sorted(map(tuple, scan_event_xml(spark, str(tmp_path), check_tails=c).collect())) for c in (True, False)]
    assert both[0] == both[1] and len(both[0]) == 4


def test_listing_follows_spark(spark, tmp_path):
    for n in ("a.xml", "b.txt", "_c.xml", ".d.xml", "sub/e.xml", "k=1/f.xml", "k=1/j=2/g.xml", "[x].xml"):
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_text(n)
    for p in ("*.xml", "{a,b}.*", "[!a]*.*", "s*", "sub", "?.xml", "*/e.xml", "a.xml"):
        want = {r[0] for r in spark.read.text(f"{tmp_path}/{p}").selectExpr("_metadata.file_path").distinct().collect()}
        assert {shown(f) for f, _ in list_files([f"{tmp_path}/{p}"])} == want, p
    assert {f.rpartition("/")[2] for f, _ in list_files([str(tmp_path)])} == {"a.xml", "b.txt", "f.xml", "g.xml", "[x].xml"}
    with pytest.raises(FileNotFoundError):
        list(list_files([f"{tmp_path}/none*"]))


# ---------------------------------------------------------------- streams


def run_stream(df, tmp_path, out):
    """One run over all that is new; returns what was written so far by (reason, text)."""
    prepared = prepare_events(df).select("source_file", "reason", "xml")
    q = prepared.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ckpt")).option("path", out)
    q.trigger(availableNow=True).start().awaitTermination(300)


def test_stream_of_a_growing_file(spark, tmp_path):
    """A file cut in a record: one reject; when it is longer, that record and the rest load; other files come once."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    recs = [REC.format(i=i) for i in range(9)]
    (src / "a.xml").write_text("<Events>" + "".join(recs[:3]) + recs[3][:40])
    (src / "b.xml").write_text("<Events>" + "".join(recs[5:7]) + "</Events>")
    run_stream(stream_event_xml(spark, str(src)), tmp_path, out)
    got = lambda: sorted((r["reason"] or "", r["xml"]) for r in spark.read.parquet(out).collect())
    first = [("", r) for r in recs[:3] + recs[5:7]] + [("xml", recs[3][:40])]
    assert got() == sorted(first)
    run_stream(stream_event_xml(spark, str(src)), tmp_path, out)
    assert got() == sorted(first)  # nothing new
    with open(src / "a.xml", "a") as f:
        f.write(recs[3][40:] + recs[4] + "</Events>")
    (src / "c.xml").write_text(recs[7])
    run_stream(stream_event_xml(spark, str(src), split_bytes=60), tmp_path, out)
    assert got() == sorted(first + [("", r) for r in (recs[3], recs[4], recs[7])])


def test_stream_of_binary_files(spark, tmp_path):
    """Files added and grown between triggers, over restarts: every chunk is decoded once, an incomplete one waits."""
    src, out, log = tmp_path / "in", str(tmp_path / "out"), tmp_path / "log"
    src.mkdir()
    log.mkdir()
    header, chunk = 16, 512
    blob = lambda lo, hi: b"".join(REC.format(i=i % 10).encode().ljust(chunk) for i in range(lo, hi))

    def decode(head: bytes, chunks: bytes):
        assert head == b"H" * header and len(chunks) % chunk == 0
        for lo in range(0, len(chunks), chunk):
            text = chunks[lo : lo + chunk].decode().strip()
            with open(f"{log}/{os.getpid()}", "a") as f:
                f.write(text + "\n")
            yield text

    def run():
        df = stream_event_files(spark, str(src), decode, header, chunk, chunks_per_split=2, path_glob_filter="*.bin")
        run_stream(df, tmp_path, out)
        return sorted(r["xml"] for r in spark.read.parquet(out).collect())

    (src / "a.bin").write_bytes(b"H" * header + blob(0, 5))
    (src / "b.bin").write_bytes(b"H" * 7)  # not even a header
    (src / "c.txt").write_bytes(b"other")
    assert run() == sorted(REC.format(i=i) for i in range(5))
    with open(src / "a.bin", "ab") as f:
        f.write(blob(5, 8) + blob(8, 9)[:100])
    (src / "d.bin").write_bytes(b"H" * header + blob(0, 1))
    assert run() == sorted([REC.format(i=i) for i in range(8)] + [REC.format(i=0)])
    with open(src / "a.bin", "ab") as f:
        f.write(blob(8, 9)[100:])
    assert run() == run() == sorted([REC.format(i=i) for i in range(9)] + [REC.format(i=0)])
    decoded = [line for f in log.iterdir() for line in f.read_text().splitlines()]
    assert sorted(decoded) == sorted([REC.format(i=i) for i in range(9)] + [REC.format(i=0)])


def _append(path, text):
    with open(path, "a") as f:
        f.write(text + "\n")


def test_push_from_a_stream(spark, tmp_path):
    """Requests of the size asked for, a report per epoch; a replayed epoch is not sent or reported again."""
    src, ckpt, sent, told = tmp_path / "in", tmp_path / "ckpt", tmp_path / "sent", str(tmp_path / "told")
    src.mkdir()
    sent.mkdir()

    def send(lines):
        _append(f"{sent}/{os.getpid()}", json.dumps(len(lines)))

    def run():
        prepared = prepare_events(stream_event_xml(spark, str(src)), index="x")
        q = start_bulk_push(prepared, send, str(ckpt), batch_size=4, on_commit=lambda epoch, n: _append(told, json.dumps([epoch, sorted(n.items())])), available_now=True)
        q.awaitTermination(300)

    sizes = lambda: sorted(int(x) for f in sent.iterdir() for x in f.read_text().split())
    (src / "a.xml").write_text("".join(REC.format(i=i) for i in range(10)) + "<Event><bad></Event>")
    run()
    assert sizes() == [2, 4, 4] and open(told).read().splitlines() == ["[0, [[2, 1], [4, 2]]]"]
    (src / "b.xml").write_text("".join(REC.format(i=i) for i in range(3)))
    run()
    assert sizes() == [2, 3, 4, 4] and len(open(told).read().splitlines()) == 2
    # The last epoch's entry in the commit log is lost, as after a stop between the two: it runs again.
    last = max(p for p in os.listdir(ckpt / "commits") if p.isdigit())
    for name in (last, f".{last}.crc"):
        if (ckpt / "commits" / name).exists():
            shutil.move(ckpt / "commits" / name, tmp_path / f"was-{name}")
    run()
    assert sizes() == [2, 3, 4, 4] and len(open(told).read().splitlines()) == 2


def test_failing_send_fails_the_epoch(spark, tmp_path):
    src, flag, told = tmp_path / "in", tmp_path / "down", str(tmp_path / "told")
    src.mkdir()
    (src / "a.xml").write_text("".join(REC.format(i=i) for i in range(10)))
    flag.write_text("")

    def send(lines):
        if os.path.exists(flag):
            raise OSError("the service is down")
        _append(told, json.dumps(len(lines)))

    def run():
        prepared = prepare_events(stream_event_xml(spark, str(src)))
        q = start_bulk_push(
            prepared, send, str(tmp_path / "ckpt"), batch_size=6, available_now=True,
            on_commit=lambda epoch, n: _append(told, "committed"), on_abort=lambda epoch, n: _append(told, f"aborted {epoch}"),
        )
        q.awaitTermination(300)

    with pytest.raises(Exception, match="the service is down"):
        run()
    assert open(told).read().splitlines() == ["aborted 0"]
    shutil.move(flag, tmp_path / "up")
    run()
    assert sorted(open(told).read().splitlines()) == ["4", "6", "aborted 0", "committed"]


def test_default_range_reader(tmp_path):
    (tmp_path / "a b").write_bytes(b"0123456789")
    assert read_range(f"file:{tmp_path}/a b", 3, 4) == b"3456" and read_range(str(tmp_path / "a b"), 8, 9) == b"89"
