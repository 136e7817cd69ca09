"""K1: bulk batches of ``batch_size`` consecutive records, and K4: their sizes.

The reference sends consecutive groups of ``threshold`` records in input order and
a short last group; a threshold <= 0 never matches, so everything goes as one group.

Two forms:

* :func:`assign_batches` numbers records *globally* in the order of ``order_by``
  (or the input's partition order) without a single-partition window: the data
  is computed once, range-sorted, cut from its lineage with a reliable ``checkpoint()`` into the
  session's shared checkpoint folder (so the positions computed from it cannot
  change on a re-run after a lost executor), counted per partition, and each row
  gets ``partition offset + position in partition``; the offsets are one number per
  partition.
* The sinks batch per task instead (``maxRecordsPerFile`` / chunks of the send
  hook): no global order, no extra pass.  That is the form to use at scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def row_index(df: DataFrame, order_by: list[str] | str | None = None, name: str = "row_index") -> DataFrame:
    """Add a dense 0-based global ``row_index`` in ``order_by`` order (input order when None)."""
    ensure_checkpoint_dir(df.sparkSession)
    if order_by:
        keys = [order_by] if isinstance(order_by, str) else list(order_by)
        # A hash of the place in the input ends the key: a value that many records hold spans many ranges.
        # Kept before it is sorted: finding the ranges looks at all rows once more, which must not load them again.
        tied = df.withColumn("_tail", F.xxhash64(F.monotonically_increasing_id())).checkpoint(eager=True)
        df = tied.repartitionByRange(*keys, "_tail").sortWithinPartitions(*keys, "_tail").drop("_tail")
    place = F.monotonically_increasing_id()
    frozen = df.withColumn("_pid", F.shiftright(place, 33)).withColumn("_pos", place.bitwiseAND((1 << 33) - 1))
    frozen = frozen.checkpoint(eager=True)
    # One row per partition, however many records there are.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = frozen.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return frozen.join(starts, "_pid").withColumn(name, F.col("_start") + F.col("_pos")).drop("_pid", "_pos", "_start")


def assign_batches(
    df: DataFrame, batch_size: int, order_by: list[str] | str | None = None, name: str = "batch"
) -> DataFrame:
    """K1: add ``batch`` = position div ``batch_size`` (everything in batch 0 when ``batch_size`` <= 0)."""
    indexed = row_index(df, order_by, "_row_index")
    batch = F.lit(0).cast("long") if batch_size <= 0 else F.expr(f"_row_index div {int(batch_size)}")
    return indexed.withColumn(name, batch).drop("_row_index")


def load_report(batched: DataFrame, name: str = "batch") -> DataFrame:
    """K4: records per batch (the reference prints the size of every bulk request)."""
    return batched.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
