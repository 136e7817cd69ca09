"""Packing token sequences into fixed windows by best-fit decreasing.

Documents are tokenised and cut into full windows and one rest; the pieces are packed longest first, each
into the open window with the least room that still holds it.  All pieces of one length are alike to
that rule, so it runs on the number of pieces of each length: at most ``window`` numbers, whatever the
corpus.  A segment tree over the remaining capacities finds the tightest open windows, and a step fills a
whole run of them at once, exactly as piece after piece would.  The plan that comes out is bounded by the
window, not by the data (an interval of windows takes at most about sqrt(2*window) steps, and there are
at most 3*window intervals: under 140,000 rows for 1024), and is broadcast; each piece finds its window
by its length and its rank among the pieces of that length.  Ranks are counted inside each task and
shifted by the counts of the tasks before, so no length is ever sorted or gathered in one place.  These
shifts are a row for each task and length, which grows with the tasks: they meet the pieces by a
merge join, never by a broadcast.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, small_batches, text_slices, written
from .tokens import END_ID, worker_encoder

WINDOW = 1024
REMEMBERED = 600_000  # pieces of text an encoder remembers, in workers that did other work before
PLAN = ["length", "rank_from", "rank_to", "first", "per", "at"]


class CapacityTree:
    """Which capacities 0..n have open windows; ``tightest(need)`` is the least such capacity >= need."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.open = bytearray(2 * self.size)

    def mark(self, capacity: int, is_open: bool) -> None:
        i = self.size + capacity
        self.open[i] = is_open
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] | self.open[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        i = self.size + need
        if self.open[i]:
            return need
        while i > 1:  # up to the first open right neighbour, then down its left edge
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return None


def best_fit_plan(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces go: rows (length, rank from, rank to, first window, pieces per window, offset).

    The pieces of ``length`` with ranks from <= rank < to go to window ``first + (rank - from) // per``, at
    ``offset + (rank - from) % per * length``.
    """
    plan, tree, runs, windows = [], CapacityTree(window), defaultdict(list), 0

    def put(capacity: int, first: int, n: int) -> None:
        if capacity and n:
            runs[capacity].append((first, n))
            tree.mark(capacity, True)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:  # open as many new windows as the rest needs
                room, first, n = window, windows, -(-left // (window // length))
                windows += n
            else:
                first, n = runs[room].pop()
                if not runs[room]:
                    tree.mark(room, False)
            per = min(room // length, left)
            used = min(n, left // per)
            plan.append((length, rank, rank + used * per, first, per, window - room))
            put(room - per * length, first, used)
            if room < window:
                put(room, first + used, n - used)
            elif n > used:
                windows -= n - used
            left -= used * per
            rank += used * per
    return plan


def cut_pieces(docs: DataFrame, id_col: str, text_col: str, window: int, vocabulary: str | None, end_id: int, with_ids: bool) -> DataFrame:
    """Every document's ids, ``end_id`` last, cut into full windows and a rest: one row per piece."""
    fields = [
        T.StructField("doc", docs.schema[id_col].dataType), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()),
    ] + [T.StructField("ids", T.BinaryType())] * with_ids
    schema = T.StructType(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part, seen = worker_encoder(vocabulary, REMEMBERED), TaskContext.get().partitionId(), [0] * (window + 1)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for rows in text_slices(batch, "text"):
                ids, ends = encoder.encode(rows.column(1).fill_null("").to_pylist())
                raw, lo, out = ids.astype("<u4").tobytes(), 0, []
                row_of = []
                for i, hi in enumerate((4 * ends).tolist()):
                    doc, lo = raw[lo:hi] + end, hi
                    total = len(doc) // 4
                    for start in range(0, total, window):
                        piece = doc[4 * start : 4 * (start + window)]
                        n = len(piece) // 4
                        row_of.append(i)
                        out.append((start, n, zlib.crc32(piece), total, part, seen[n], piece)[: len(fields) - 1])
                        seen[n] += 1
                cols = [pa.array(c, f.type) for c, f in zip(zip(*out), list(arrow)[1:])]
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(row_of)), *cols], names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return docs.select(column(id_col).alias("doc"), column(text_col).alias("text")).mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    vocabulary: str | None = None, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``start`` counts the document's ids before the piece, ``offset`` the window's ids before it; what a
    window lacks at its end is padding.  With ``with_ids`` the piece's ids follow as little-endian
    unsigned 32-bit numbers in ``ids``.  A null or empty text is ``end_id`` alone.  Equal rows, and rows
    without an id, are packed one by one; a table without rows gives no pieces.  Other columns are not
    looked at.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        pieces = written(cut_pieces(docs, id_col, text_col, window, vocabulary, end_id, with_ids), "pieces")
    per_task = written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # At most `window` numbers reach the driver.
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # As an Arrow table: from a list of rows Spark makes an RDD, for which executors keep Python workers of another kind.
    moves = np.array(best_fit_plan(counts, window), np.int64).reshape(-1, len(PLAN))
    plan = spark.createDataFrame(pa.table([pa.array(c) for c in moves.T.copy()], names=PLAN))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases.hint("merge"), ["part", "length"]).withColumn("rank", F.col("base") + F.col("place"))
    steps = F.broadcast(plan.withColumnRenamed("length", "plan_length"))
    here = (F.col("length") == F.col("plan_length")) & (F.col("rank") >= F.col("rank_from")) & (F.col("rank") < F.col("rank_to"))
    nth = F.col("rank") - F.col("rank_from")
    return ranked.join(steps, here).select(
        F.col("doc").alias(id_col), "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.call_function("div", nth, F.col("per"))).alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("per")) * F.col("length")).alias("offset"),
        *["ids"] * with_ids,
    )


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = END_ID) -> DataFrame:
    """The windows themselves, from pieces with ids: ``sequence_id``, ``n_tokens``, ``ids`` padded to ``window``."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = pieces.groupBy("sequence_id").agg(ordered.alias("parts"), F.sum("length").alias("n_tokens"))
    raw = F.hex(F.aggregate("parts", F.lit("").cast("binary"), lambda a, x: F.concat(a, x["ids"])))
    pad = F.hex(F.lit(pad_id.to_bytes(4, "little")))
    return rows.select("sequence_id", "n_tokens", F.unhex(F.rpad(raw, 8 * window, pad)).alias("ids"))
