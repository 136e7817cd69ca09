"""Token-ID output: Parquet files of token ids in the order of the documents' ids.

Layout: one row per document, ``doc`` | ``part`` | ``start`` | ``n_tokens`` | ``ids list<int>``.  ``part`` is
the number of the file's task and ``start`` counts the ids before the document in that part, both in
ascending order of the ids; the ids are dictionary-encoded, the other columns delta-encoded (format v2).
Row groups and pages are kept small, and the files carry page indexes, so a reader that asks for a range
of ids, or for the metadata columns alone, reads those pages only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, text_slices, written
from .tokens import END_ID, forget_encoders, worker_encoder

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000


def token_rows(docs: DataFrame, id_col: str, text_col: str, vocabulary: str | None, end_id: int) -> DataFrame:
    """Documents in ascending order of their ids as rows of the file format.

    The texts are dealt out in ranges of (id, hash of the place in the scan), so that rows without an
    id, or with the same one, don't all meet in one task, and the sample of the ranges reads no text.
    The ids are made after the shuffle, which moves texts.
    """
    id_type = docs.schema[id_col].dataType
    ordered = docs.select(column(id_col).alias("doc"), column(text_col).alias("text"))
    ordered = ordered.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    ordered = ordered.repartitionByRange("doc", "tie").sortWithinPartitions("doc", "tie").drop("tie")
    schema = T.StructType([
        T.StructField("doc", id_type), T.StructField("part", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, before = worker_encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            for rows in text_slices(batch, "text"):
                ids, ends = encoder.encode(rows.column(1).fill_null("").to_pylist())
                n = np.diff(ends, prepend=0) + 1
                after = np.cumsum(n)
                full = np.full(after[-1], end_id, np.int32)
                inner = np.ones(after[-1], bool)
                inner[after - 1] = False
                full[inner] = ids
                offsets = pa.array(np.concatenate([[0], after]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(before + after - n),
                     pa.array(n), pa.ListArray.from_arrays(offsets, pa.array(full))],
                    names=["doc", "part", "start", "n_tokens", "ids"],
                )
                before += int(after[-1])

    return ordered.mapInArrow(encode, schema)


def write_token_files(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
    vocabulary: str | None = None, end_id: int = END_ID,
) -> None:
    """Write the token files of ``docs`` to the folder ``path``.

    A null or empty text is ``end_id`` alone.  Rows without an id come first, rows with the same id
    stand together, each row on its own.  A table without rows gives a folder without rows; other
    columns are not looked at.
    """
    rows = token_rows(docs, id_col, text_col, vocabulary, end_id)
    writer = rows.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", 1)
    writer = writer.option("parquet.writer.version", "v2")
    writer = writer.option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
    writer = writer.option("parquet.page.row.count.limit", PAGE_ROWS).option("parquet.dictionary.page.size", 4 << 20)
    for name in ("doc", "part", "start", "n_tokens"):
        writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    writer.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc``, ``start`` (ids of all documents before it), ``n_tokens``, ``ids``, pruned and filtered like any table.

    The place of a part among all ids comes from the metadata columns alone: one number per part.
    """
    files = spark.read.parquet(path)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Written, so that Spark knows its size and, while small, brings it to the ids instead of moving them.
    parts = written(sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "part-starts")
    return files.join(parts, "part").select("doc", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")


def id_checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces ``ids`` by their CRC-32 as little-endian unsigned 32-bit numbers."""
    forget_encoders()
    for batch in batches:
        lists = batch.column(batch.schema.get_field_index("ids"))
        values = memoryview(lists.flatten().to_numpy(zero_copy_only=False)).cast("B")
        ends = np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)).tolist()
        crc = [zlib.crc32(values[4 * lo : 4 * hi]) for lo, hi in zip([0, *ends], ends)]
        keep = [i for i, n in enumerate(batch.schema.names) if n != "ids"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in keep], pa.array(crc, pa.int64())], names=[*[batch.schema.names[i] for i in keep], "ids_crc32"]
        )
