"""Event files in a binary format, decoded by a caller-supplied function.

The binary event-log codec is not part of this library; the caller passes it in.

* Whole-file mode: ``decode(content: bytes) -> Iterable[str]`` gets each file's
  bytes (one file per call, files packed into tasks by size).  Limited to files
  that fit in a task's memory (and Spark's 2 GB binary-file limit).
* Chunked mode, for formats made of a fixed-size header followed by fixed-size
  chunks that decode on their own (the Windows event-log format: a 4 KiB header,
  then 64 KiB chunks): each file is cut into runs of ``chunks_per_split`` chunks
  and the runs are dealt out evenly over tasks, so one huge file does not land on one
  task.  ``decode(header: bytes, chunks: bytes) -> Iterable[str]`` gets the header and
  one run.  Ranges are read with ``pyarrow.fs`` (local, HDFS, S3 and GCS paths, ``s3a:``
  included; another scheme is an error at once) or by the caller's
  ``read_range(path, start, size) -> bytes``.  Counting the runs takes one job over the
  list of files.

:func:`stream_event_files` is the chunked mode on a stream: its progress is the number of complete chunks of each
file, so that a file may grow and every chunk is decoded in one batch; a last chunk that is not complete waits.

A decoder error fails the task (and, after Spark's retries, the job): a damaged
file aborts the load as it does in the reference, unless the decoder chooses to
skip.  Malformed *records* are the parser's business and are quarantined.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from fnmatch import fnmatch

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .ranges import check_readable, list_files as _list_files, read_range as _read_range, shown
from .xml_records import split_size

OUT_SCHEMA = "source_file string, xml string"
_BATCH = 10_000
# A task reads several runs, one after the other, until it has the size of a file split, so that the number of tasks follows
# the bytes; while there are fewer tasks than these for a core, runs have a task each.
TASKS_PER_CORE = 16
MAX_TASKS = 20_000


def task_count(runs: int, size: int, cores: int, split_bytes: int) -> int:
    """Tasks for ``runs`` runs of ``size`` bytes in all."""
    return max(1, min(runs, max(TASKS_PER_CORE * cores, -(-size // split_bytes)), MAX_TASKS))


def _flush(rows: list) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["source_file", "xml"])


def scan_event_files(
    spark: SparkSession,
    path: str,
    decode: Callable[..., Iterable[str]],
    *,
    header_bytes: int | None = None,
    chunk_bytes: int | None = None,
    chunks_per_split: int = 256,
    path_glob_filter: str | None = None,
    tasks: int | None = None,
    read_range: Callable[[str, int, int], bytes] | None = None,
) -> DataFrame:
    """``source_file, xml``: one row per decoded record (see module doc for the two modes)."""
    chunked = header_bytes is not None and chunk_bytes is not None
    if chunked and read_range is None:
        check_readable([path])
    reader = spark.read.format("binaryFile")
    if path_glob_filter:
        reader = reader.option("pathGlobFilter", path_glob_filter)
    files = reader.load(path)
    if not chunked:
        return files.select("path", "content").mapInPandas(_whole_file_decoder(decode), OUT_SCHEMA)

    # Only path and length are read here: binaryFile skips the content column when it is pruned.
    run_bytes = chunk_bytes * chunks_per_split
    n_runs = F.greatest(F.lit(0), F.ceil((F.col("length") - F.lit(header_bytes)) / F.lit(run_bytes))).cast("int")
    files = files.select("path", "length", n_runs.alias("n")).where("n > 0")
    if tasks is None:
        n, size = files.agg(F.sum("n"), F.sum("length")).first()
        tasks = task_count(n or 0, size or 0, spark.sparkContext.defaultParallelism, split_size(spark))
    runs = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("run"))
    # With a number given, adaptive execution does not merge these tiny partitions.
    runs = runs.repartition(tasks)
    return runs.mapInPandas(_chunked_decoder(decode, header_bytes, run_bytes, read_range or _read_range), OUT_SCHEMA)


def _whole_file_decoder(decode):
    def run(batches):
        for pdf in batches:
            rows: list = []
            for p, content in zip(pdf["path"], pdf["content"]):
                for xml in decode(bytes(content)):
                    rows.append((p, xml))
                    if len(rows) >= _BATCH:
                        yield _flush(rows)
                        rows = []
            if rows:
                yield _flush(rows)

    return run


def _chunked_decoder(decode, header_bytes: int, run_bytes: int, read):
    def run(batches):
        for pdf in batches:
            rows: list = []
            for p, length, r in zip(pdf["path"], pdf["length"], pdf["run"]):
                start = header_bytes + int(r) * run_bytes
                header = read(p, 0, header_bytes)
                body = read(p, start, min(run_bytes, int(length) - start))
                for xml in decode(header, body):
                    rows.append((p, xml))
                    if len(rows) >= _BATCH:
                        yield _flush(rows)
                        rows = []
            if rows:
                yield _flush(rows)

    return run


class ChunkRuns(InputPartition):
    """What one task decodes: (path, first chunk, number of chunks) of each run."""

    def __init__(self, runs: list[tuple[str, int, int]]):
        super().__init__(runs)


class EventFileStreamReader(DataSourceStreamReader):
    """Chunks as files are added or grow; the offset is the number of complete chunks of every file that is there."""

    def __init__(self, paths, pattern, decode, header_bytes: int, chunk_bytes: int, per_split: int, tasks: int | None, read, listed, cores: int = 1, split_bytes: int = 128 << 20):
        self._paths, self._pattern, self._decode, self._read, self._listed = paths, pattern, decode, read, listed
        self._header, self._chunk, self._per_split, self._tasks = header_bytes, chunk_bytes, per_split, tasks
        self._cores, self._split = cores, split_bytes

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        found = self._listed(self._paths)
        return {p: max(0, n - self._header) // self._chunk for p, n in found if not self._pattern or fnmatch(p.rpartition("/")[2], self._pattern)}

    def partitions(self, start: dict, end: dict) -> list[ChunkRuns]:
        runs = []
        for path, n in sorted(end.items()):
            first = start.get(path, 0)
            first = first if first <= n else 0  # a file that became shorter is a new one
            runs += [(path, lo, min(self._per_split, n - lo)) for lo in range(first, n, self._per_split)]
        size = sum(n for _, _, n in runs) * self._chunk
        tasks = min(len(runs), self._tasks or task_count(len(runs), size, self._cores, self._split))
        return [ChunkRuns(runs[i::tasks]) for i in range(tasks)]

    def read(self, partition: ChunkRuns) -> Iterator[pa.RecordBatch]:
        names, texts = [], []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["source_file", "xml"])

        for path, first, n in partition.value:
            header = self._read(path, 0, self._header)
            body = self._read(path, self._header + first * self._chunk, n * self._chunk)
            for xml in self._decode(header, body):
                names.append(shown(path))
                texts.append(xml)
                if len(texts) >= _BATCH:
                    yield batch()
                    names, texts = [], []
        if texts:
            yield batch()


def stream_event_files(
    spark: SparkSession,
    path: str | list[str],
    decode: Callable[[bytes, bytes], Iterable[str]],
    header_bytes: int,
    chunk_bytes: int,
    chunks_per_split: int = 256,
    path_glob_filter: str | None = None,
    tasks: int | None = None,
    read_range: Callable[[str, int, int], bytes] | None = None,
    files: Callable[[list[str]], Iterable[tuple[str, int]]] | None = None,
) -> DataFrame:
    """Streaming ``source_file, xml``: one row per record of the chunks that are added to the files under ``path``.

    Stores that pyarrow does not know need ``read_range(path, start, size)`` and ``files(paths)``, which gives
    (path, length) of each file.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if read_range is None or files is None:
        check_readable(paths)
    how = (paths, path_glob_filter, decode, header_bytes, chunk_bytes, chunks_per_split, tasks, read_range or _read_range, files or _list_files)
    how += (spark.sparkContext.defaultParallelism, split_size(spark))
    source = f"eventloom_chunks_{uuid.uuid4().hex[:12]}"

    class EventFileSource(DataSource):
        @classmethod
        def name(cls):
            return source

        def schema(self):
            return OUT_SCHEMA

        def streamReader(self, schema):
            return EventFileStreamReader(*how)

    spark.dataSource.register(EventFileSource)
    return spark.readStream.format(source).load()
