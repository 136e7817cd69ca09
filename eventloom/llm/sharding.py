"""Sharding by a Feistel permutation of global row numbers.

The rows are numbered 0..N-1 in the order of (id, size, checksum); a keyed permutation of 0..N-1 sends
row number n to position p, and ``shard = p mod shards``, ``slot = p div shards``.  Shard sizes differ
by one row at most, slots have no gaps, and any process that knows N, the key and n can compute both.

The permutation works on Z_a x Z_b with a*b just over N: each round adds a keyed hash of one half to the
other.  A position beyond N-1 is sent through again (cycle walking); fewer than a of the a*b values lie
beyond, so a second pass is rare.  Everything is built from DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, written

SHARDS = 40
SEED = 20240607
ROUNDS = 4
# Walks allowed; a longer walk raises an error.  For N < 4096 none can be longer, beyond that one is
# as likely as 64 draws in a row among the under 1/64 of the values that lie beyond N-1.
WALKS = 64


def number_rows(keys: DataFrame, order: list[str], name: str) -> DataFrame:
    """``keys`` with a dense 0-based number in the order of ``order``; no task holds more than a range.

    Rows equal in all of ``order`` are interchangeable: a hash of their place in the scan breaks ties,
    so that a value held by a third of all rows is still spread over many ranges.  The ranges are
    written to the scratch folder first, so the numbers can't change when a task runs again.
    """
    tied = keys.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    ranged = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    place = F.monotonically_increasing_id()
    ranged = ranged.withColumn("_range", F.shiftright(place, 33)).withColumn("_at", place.bitwiseAND((1 << 33) - 1))
    frozen = written(ranged, "numbered")
    # One row per range: the running sum is as small as the number of partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = frozen.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return frozen.join(starts, "_range").withColumn(name, F.col("_start") + F.col("_at")).drop("_range", "_at", "_start")


def feistel(x: Column, n: int, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """One pass of the keyed permutation of 0..a*b-1, with a = ceil(sqrt(n)) and b = ceil(n / a)."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))
    left, right = F.pmod(x, F.lit(a)), F.call_function("div", x, F.lit(a))
    for i in range(rounds):
        key = F.lit(seed * 1000 + i)
        if i % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(key, right), F.lit(a)), F.lit(a))
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(key, left), F.lit(b)), F.lit(b))
    return (right * a + left).cast("long")


def permuted(x: Column, n: int, seed: int = SEED) -> Column:
    """The keyed permutation of 0..n-1: passes of :func:`feistel` until the value is below ``n``."""
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), feistel(x, n, seed),
        lambda at, _: F.when(at < n, at).otherwise(feistel(at, n, seed)),
    )
    return F.when(walk < n, walk).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``size`` (UTF-8 bytes of the text + 16), ``text_crc32``, ``row_number``, ``shard``, ``slot``.

    Shard row counts are at most one apart.  A null text has no bytes and, in ``text_crc32``, the
    checksum of the empty text.  Rows without an id come first in the numbering; rows equal in id, size
    and checksum get adjacent numbers.  The result depends on the rows alone, not on files, partitions
    or order.  An empty table gives an empty table; other columns are not looked at.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    keys = docs.select(
        column(id_col).alias("_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
    )
    numbered = number_rows(keys, ["_id", "size", "text_crc32"], "row_number")
    n = numbered.count()
    at = numbered.withColumn("_p", permuted(F.col("row_number"), n, seed))
    return at.select(
        F.col("_id").alias(id_col), "size", "text_crc32", "row_number",
        F.pmod("_p", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"_p div {int(shards)}").alias("slot"),
    )
