"""Helpers shared by the operators: scratch tables, fresh column names, bounded text batches."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from types import ModuleType

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# The ASCII blanks of the word and line rules, and the letters that are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

BATCH_BYTES = 2 << 20  # of an Arrow batch in small_batches
_BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


class Scratch:
    """The tables that :func:`written` makes inside a ``with Scratch() as tables``; at its end they are removed.

    ``keep`` leaves one to the scope around (or, without one, in the scratch folder): what is read later, by the
    frame that an operator gives back.  ``drop`` removes one at once.
    """

    _open: ContextVar[Scratch | None] = ContextVar("eventloom-scratch", default=None)

    def __enter__(self) -> Scratch:
        self._around, self._paths = Scratch._open.get(), {}
        Scratch._open.set(self)
        return self

    def __exit__(self, *_) -> None:
        Scratch._open.set(self._around)
        for df in [df for df, _ in self._paths.values()]:
            self.drop(df)

    def _add(self, df: DataFrame, path: str) -> None:
        self._paths[id(df)] = (df, path)

    def keep(self, df: DataFrame) -> DataFrame:
        entry = self._paths.pop(id(df), None)
        if entry is not None and self._around is not None:
            self._around._add(*entry)
        return df

    def drop(self, df: DataFrame) -> None:
        entry = self._paths.pop(id(df), None)
        if entry is not None:
            spark = df.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(entry[1])  # the file systems that Spark itself writes to
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared scratch folder and read again; the open :class:`Scratch` removes it.

    Cuts the lineage: a lost executor costs a re-read of the files, never the work before them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if (tables := Scratch._open.get()) is not None:
        tables._add(out, path)
    return out


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands rows to Python tasks in Arrow batches of about ``BATCH_BYTES``, or less if the session asks for less.

    Spark's own batches have 10,000 rows, with whole texts tens of MB: an executor allocates each outside its heap, where
    much of it stays as free memory of the C library, and its Python worker holds it once more.  Rows and results are the
    same; the session's setting comes back at the end.
    """
    before = spark.conf.get(_BATCH_BYTES_KEY, None)
    if before is None or before.startswith("-") or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before) > BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES_KEY, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_BYTES_KEY)
        else:
            spark.conf.set(_BATCH_BYTES_KEY, before)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that no column of ``df`` has (compared without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def column(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_slices(batch: pa.RecordBatch, text: str, max_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``max_bytes`` of text (one longer text makes a run of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > max_bytes:
            yield batch.slice(lo, i - lo)
            lo, total = i, 0
        total += n
    if len(sizes) > lo:
        yield batch.slice(lo)


def release_memory() -> None:
    """Give free memory of this Python worker back to the system: what earlier stages used stays with it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library, which has no such call


def worker_store() -> dict:
    """What this Python worker keeps from task to task; functions shipped with a task start anew each time."""
    return sys.modules.setdefault("_eventloom_worker", ModuleType("_eventloom_worker")).__dict__
