"""Exact dedup as a stateful stream.

A stream over the document files keeps keyed state on disk (RocksDB state store) and never drops a
key: digest and byte length of the text -> how many rows had it, and the largest (id, file, row in the
file) among them, that is the stable identifier of the row that stays and the locator of its content.
Partial sums run before the shuffle, so a text that a third of all rows share is one row per task there.
The state is then read as a table (``statestore`` source) and met with the rows.  Rows whose key was hit
more than once are checked byte for byte against the text at the locator; should two different texts
ever share a key, the rows that differ are grouped anew by their full text.

Files that arrive later continue the same state when the same ``checkpoint`` is given again.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import column, written

_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Many small stores: no megabytes set aside for each one's logs.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def text_digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes, null as the empty text."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _rows(files: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = F.coalesce(column(text_col), F.lit(""))
    return files.select(
        column(id_col).alias("doc"), text.alias("text"), digest(column(text_col)).alias("digest"),
        F.octet_length(text).alias("bytes"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
    )


def update_state(
    spark: SparkSession, path: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text", digest=text_digest
) -> DataFrame:
    """Run the stream over all files of ``path`` that ``checkpoint`` has not seen; return its state.

    One row per key: ``digest``, ``bytes``, ``group_size``, ``last`` (doc, file, row).
    """
    session = spark.newSession()  # the store's settings stay out of the caller's session
    for k, v in _STATE.items():
        session.conf.set(k, v)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    schema = session.read.parquet(path).schema
    # A pattern that matches this path only: a plain path would have to be a folder, a single file is one too here.
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    stream = _rows(session.readStream.schema(schema).parquet(pattern), id_col, text_col, digest)
    state = stream.groupBy("digest", "bytes").agg(
        F.max(F.struct("doc", "file", "row")).alias("last"), F.count(F.lit(1)).alias("group_size")
    )
    query = (
        state.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    table = session.read.format("statestore").load(checkpoint)
    last, size = (f"value.`{f}`" for f in table.schema["value"].dataType.names)
    return table.select("key.digest", "key.bytes", F.col(last).alias("last"), F.col(size).alias("group_size"))


def stream_dedup(
    spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text",
    checkpoint: str | None = None, digest=text_digest,
) -> DataFrame:
    """One row per row of the Parquet files at ``path``: id, ``keep_id``, ``group_size``, ``kept``, ``digest``.

    Texts are equal when their bytes are; null counts as empty.  Of equal texts the row with the largest
    id stays; among rows equal in id too, the one with the largest (file, row), so exactly one row of a
    group is ``kept``.  A row without an id stays only if no row of its group has one (``keep_id`` is then
    null).  A table without rows gives an empty table; other columns are not looked at.
    """
    checkpoint = checkpoint or scratch_path(spark, "stream-dedup")
    state = update_state(spark, path, checkpoint, id_col, text_col, digest)
    rows = _rows(spark.read.parquet(path), id_col, text_col, digest)
    seen = rows.drop("text").join(state, ["digest", "bytes"])

    # Full bytes on hits: the text at the locator against the text of every other row of the key.
    # Only rows of such keys are written; the texts of all others move once and are read no more.
    hits = state.where(F.col("group_size") > 1).select("digest", "bytes", "last")
    held = written(rows.join(hits, ["digest", "bytes"]), "hits")
    at = (F.col("file") == F.col("last.file")) & (F.col("row") == F.col("last.row"))
    first = held.where(at).select("digest", "bytes", F.col("text").alias("held_text"))
    differs = F.col("text") != F.col("held_text")
    other = written(held.where(~at).drop("last").join(first, ["digest", "bytes"]).where(differs).drop("held_text"), "differing")
    regrouped = other.groupBy("digest", "bytes", "text").agg(
        F.max(F.struct("doc", "file", "row")).alias("own_last"), F.count(F.lit(1)).alias("own_size")
    )
    apart = other.join(regrouped, ["digest", "bytes", "text"]).select("file", "row", "own_last", "own_size")
    lost = other.groupBy("digest", "bytes").agg(F.count(F.lit(1)).alias("lost"))

    out = seen.join(lost, ["digest", "bytes"], "left").join(apart, ["file", "row"], "left")
    last = F.coalesce("own_last", "last")
    size = F.coalesce(F.col("own_size"), F.col("group_size") - F.coalesce(F.col("lost"), F.lit(0)))
    return out.select(
        F.col("doc").alias(id_col),
        last["doc"].alias("keep_id"),
        size.cast("long").alias("group_size"),
        ((last["file"] == F.col("file")) & (last["row"] == F.col("row"))).alias("kept"),
        "digest",
    )
