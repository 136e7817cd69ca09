"""Importance resampling towards a target distribution, on hashed word n-grams.

1. Each task counts the n-grams of its texts into an array of buckets (crc32 of the n-gram); only the arrays
   are shuffled and added up, for the corpus and for the target.
2. A bucket's gain is the log ratio of the target's and the corpus's smoothed shares.  The gains are one
   small array; a text's weight is the mean gain of its n-grams, read out of the array.
3. Weight plus a Gumbel number made from the id is the score: the highest scores are a sample without
   replacement in proportion to exp(weight).  Ids and scores are written.
4. The cut between drawn and undrawn rows is found by bisection with exact count jobs over the written
   scores: first the score, then the id among rows of that score, then a row's number among rows of that id.
   Each job counts above the inner points of ``HALVINGS`` halvings at once.
5. Only the drawn rows are shuffled: by ranges of score and id (and number, so that no run of ties is one
   task), sorted inside a range, and numbered by the counts of the ranges before.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, written

BUCKETS = 10_000
LENGTH = 2  # n-grams of one word up to this many
LEAST_WORDS = 20
DRAW = (25, 100)
SEED = 7
HALVINGS = 4
_SEGMENT = 1 << 20
# A word is a run of ASCII digits and letters and of bytes beyond ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_CUT = re.compile(rb"[^0-9a-z\x80-\xff]")
_LAST = (1 << 63) - 1


def _segments(text: bytes) -> Iterator[bytes]:
    """Runs of about a million bytes that end between words."""
    lo = 0
    while lo < len(text):
        m = _CUT.search(text, lo + _SEGMENT)
        hi = m.end() if m else len(text)
        yield text[lo:hi]
        lo = hi


def features(text: str | None, buckets: int, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """By segments of the text: the number of its words, and the bucket of each n-gram that ends in it."""
    # Checksums of the runs that end at the last words: of one word, of two, ...
    ends: list[list[int]] = [[] for _ in range(length - 1)]
    for part in _segments((text or "").encode("utf-8", "replace").lower()):
        words = _WORD.findall(part)
        found, runs = [], list(map(crc32, words))
        found.append(runs)
        for n in range(length - 1):
            # A run of n + 2 words continues the checksum of the n + 1 words before its last one.
            before = ends[n] + runs
            ends[n] = before[-1:]
            blank = list(map(crc32, repeat(b" "), before[:-1]))
            runs = list(map(crc32, words[len(words) - len(blank) :], blank))
            found.append(runs)
        yield len(words), np.concatenate([np.array(f, np.int64) for f in found]) % buckets


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, length: int = LENGTH) -> np.ndarray:
    """How many n-grams of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, at in features(text.as_py(), buckets, length):
                    seen += np.bincount(at, minlength=buckets)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["bucket", "n"])

    sums = docs.select(column(text_col).cast("string")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():  # a row for each bucket
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of the ratio of add-one shares, target to corpus, for each bucket."""
    n, total, aim = len(corpus), int(corpus.sum()), int(target.sum())
    ratios = ((t + 1.0) * (total + n) / ((s + 1.0) * (aim + n)) for s, t in zip(corpus.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, id_col: str, text_col: str, length: int) -> DataFrame:
    """``doc``, ``n_words``, ``n_features``, ``weight`` of every row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, sums = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i, text in enumerate(batch.column(1)):
                for n, at in features(text.as_py(), len(gains), length):
                    n_words[i] += n
                    n_features[i] += len(at)
                    sums[i] += gains[at].sum()
            weight = sums // np.maximum(n_features, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_words, n_features, weight))], names=["doc", "n_words", "n_features", "weight"])

    rows = docs.select(column(id_col).cast("long").alias("doc"), column(text_col).cast("string").alias("text"))
    return rows.mapInArrow(weigh, "doc long, n_words long, n_features long, weight long")


def gumbel(doc: Column, seed: int) -> Column:
    """floor(1000 times a Gumbel number) made from the id; a null id counts as the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def cut_value(rows: DataFrame, value: str, wanted: int, low: int, high: int) -> tuple[int, int]:
    """The largest number in low..high such that ``wanted`` rows or more have ``value`` not below it, and how many lie above it.

    There have to be as many rows from ``low`` on.
    """
    above = 0
    while low < high:
        # Inner points of the halvings still to be made; the answer is `low` or a point that enough rows reach.
        parts = min(1 << HALVINGS, high - low + 1)
        points = [low + (high - low + 1) * i // parts for i in range(1, parts)]
        counts = rows.agg(*[F.count(F.when(F.col(value) >= p, 1)).alias(f"c{i}") for i, p in enumerate(points)]).first()
        reached = sum(c >= wanted for c in counts)
        if reached < len(points):
            high, above = points[reached] - 1, counts[reached]
        if reached:
            low = points[reached - 1]
    return low, above


def drawn_ranks(scored: DataFrame, wanted: int) -> DataFrame:
    """The ``wanted`` first rows by score (downwards), id and number, with their ``rank`` from 1."""
    spark = scored.sparkSession
    # The later a row comes, the smaller `first`: cuts are lower ends throughout.
    keyed = scored.withColumn("tie", -1 - F.coalesce("doc", F.lit(_LAST))).withColumn("late", -1 - F.col("at"))
    chosen, left, rest = F.lit(False), wanted, keyed
    for value in ("score", "tie", "late"):
        low, high = rest.agg(F.min(value), F.max(value)).first()
        cut, above = cut_value(rest, value, left, low, high)
        same = F.col(value) == cut
        # Rows beyond the cut are drawn; those on it are told apart by the next value.
        chosen = chosen | ((F.col(value) > cut) if value == "score" else (tied & (F.col(value) > cut)))
        tied = same if value == "score" else tied & same
        left, rest = left - above, rest.where(same)
    picked = keyed.where(chosen | tied).drop("tie", "late")
    order = [F.desc("score"), F.asc_nulls_last("doc"), F.asc("at")]
    tasks = max(1, -(-wanted // 200_000), int(spark.conf.get("spark.sql.shuffle.partitions")))
    place = F.monotonically_increasing_id()
    dealt = picked.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    dealt = written(dealt.withColumn("range", F.shiftright(place, 33)).withColumn("pos", place.bitwiseAND((1 << 33) - 1)), "importance-drawn")
    # One row for each range, however many rows there are.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return dealt.join(starts, "range").withColumn("rank", F.col("start") + F.col("pos") + 1).drop("range", "pos", "start"), ~(chosen | tied)


def importance_resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
    draw: tuple[int, int] = DRAW, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, length: int = LENGTH, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_features``, ``weight``, ``score``, ``rank``.

    Of the N rows with ``least_words`` words or more, floor(draw[0] * N / draw[1]) are drawn: the highest scores, ties
    to the smaller id.  ``rank`` counts them from 1 and is null for the others.  Words are runs of digits, letters (A-Z
    lower-cased) and characters beyond ASCII.  A null text is empty: no features, weight 0, never drawn.  A null id
    counts as the empty text in the score and comes after all ids of its score.  Rows of the same id have the same
    Gumbel number; among equal score and id, any may be drawn, each with a rank of its own.  Without target texts all
    gains come from the smoothing; an empty table gives an empty table; other columns are not looked at.  Ids come back
    as 64-bit integers.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, buckets, length), bucket_counts(target, target_col, buckets, length))
    rows = weighed(docs, gains, id_col, text_col, length)
    score = F.col("weight") + gumbel(F.col("doc"), seed)
    # `at` numbers the rows as written: the last resort among rows equal in score and id.
    scored = written(rows.withColumn("score", score).withColumn("at", F.monotonically_increasing_id()), "importance-scores")
    enough = F.col("n_words") >= least_words
    eligible = scored.where(enough)
    wanted = draw[0] * eligible.count() // draw[1]
    nobody = F.lit(None).cast("long")
    if wanted:
        ranked, undrawn = drawn_ranks(eligible, wanted)
        keyed = scored.withColumn("tie", -1 - F.coalesce("doc", F.lit(_LAST))).withColumn("late", -1 - F.col("at"))
        others = keyed.where(~enough | undrawn).drop("tie", "late").withColumn("rank", nobody)
        out = ranked.select(*others.columns).unionAll(others)
    else:
        out = scored.withColumn("rank", nobody)
    return out.drop("at").withColumnRenamed("doc", id_col)
