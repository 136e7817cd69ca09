"""Mixing sources to target weights by temperature.

Source shares of tokens p become weights proportional to p**alpha.  The exponent is bisected to the
largest one whose weights reach a target entropy, or the smallest one that repeats no source more than
a limit.  The weights times a token budget are the sources' quotas, which are realised as block
permutations: pass after pass over a source's documents, each pass a keyed permutation, until the quota
is used; the stream is then cut into blocks of a token budget, in each of which every source has its
weight, and each block is permuted.

A document's place in a pass is the rank of a hash.  Token counts before it come from sums over ranges
of the hash and a running sum inside one range, so no source is gathered in one task; whether the last,
partial pass still takes a document is then a comparison of its hash with one number per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, column, fresh, written

REPEAT_LIMIT = 1.5
BLOCK_TOKENS = 1 << 20
SEED = 17
_RANGE_ROWS = 4096
PRECISION = 60  # halvings of the exponent's interval
HALVINGS = 4  # of these in one job


def token_count(text: Column) -> Column:
    """Words between ASCII blanks, and one for the document's end."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", 1).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+")) + 1).cast("long")


def temperature(sources: DataFrame, budget: int | None = None, entropy: float | None = None, repeat_limit: float | None = None) -> float:
    """The exponent in 0..1 for a table of ``tokens`` by source, by bisection.

    ``entropy``: the largest exponent whose weights have this share of the largest entropy possible.
    ``repeat_limit``: the smallest exponent at which no source is passed over more often than this.
    Without a target the shares stay as they are (1.0).  A target beyond 0..1 gives the nearer end.

    What a step asks for is a sum over the sources; one job has the sums of ``HALVINGS`` steps.  Without a budget
    the largest and the smallest source tell how often one is passed over.
    """
    least, top, n = sources.agg(F.min("tokens"), F.max("tokens"), F.count(F.lit(1))).first()
    if n < 2 or entropy is None and repeat_limit is None:
        return 1.0
    x = F.log(F.col("tokens") / F.lit(float(top)))

    def meets(alphas: list[float]) -> list[bool]:  # true from 0 up to the answer
        if entropy is None and not budget:
            return [(top / least) ** (1 - a) > repeat_limit for a in alphas]
        raw = [F.exp(F.lit(a) * x) for a in alphas]
        sums = sources.agg(*[F.sum(c) for e in raw for c in (e, x * e)]).first()
        totals = list(zip(alphas, sums[::2], sums[1::2]))
        if entropy is not None:
            return [math.log(z) - a * xz / z >= entropy * math.log(n) - 1e-12 for a, z, xz in totals]
        return [budget * (least / top) ** a / z / least > repeat_limit for a, z, _ in totals]

    low, high = 0.0, 1.0
    at_low, at_high = meets([low, high])
    if at_high:
        return 1.0
    if not at_low:
        return 0.0
    for _ in range(-(-PRECISION // HALVINGS)):
        points = [low + (high - low) * i / (1 << HALVINGS) for i in range(1 << HALVINGS)] + [high]
        last = sum(meets(points[1:-1]))
        low, high = points[last], points[last + 1]
    return low if entropy is not None else high


def quotas(sums: DataFrame, budget: int | None, **target) -> DataFrame:
    """``s``, ``of``, ``tokens``, ``weight``, ``quota``, ``full`` for a table of ``source`` and ``tokens``.

    Without a budget it is the least one that passes over every source once.  ``full`` is the number of full passes.
    """
    alpha = temperature(sums, budget, **target)
    top = sums.agg(F.max("tokens")).first()[0] or 1
    x = F.log(F.col("tokens") / F.lit(float(top)))
    total = sums.agg(F.sum(F.exp(F.lit(alpha) * x))).first()[0] or 1.0
    weight = F.exp(F.lit(alpha) * x) / F.lit(total)
    if budget:
        quota = F.rint(weight * F.lit(float(budget))).cast("long")
    else:  # rounding must not take a document from the source that is passed over exactly once
        quota = F.greatest(F.rint(F.exp(F.lit(alpha - 1) * x) * F.col("tokens")).cast("long"), F.col("tokens"))
    table = sums.select(F.monotonically_increasing_id().alias("s"), F.col("source").alias("of"), "tokens", "n_docs", weight.alias("weight"), quota.alias("quota"))
    return table.withColumn("full", F.call_function("div", F.col("quota"), F.col("tokens")))


def _plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, budget: int | None, seed: int, **target):
    """(rows of ids with pass keys, one row per source with its quota)"""
    doc, text = column(id_col), column(text_col)
    same = F.xxhash64(F.lit(seed), doc, text)
    rows = docs.select(doc.alias("doc"), column(source_col).alias("source"), token_count(text).alias("n_tokens"), same.alias("same"))
    rows = written(rows, "mix-rows")
    by_source = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))
    # However many sources there are, they stay in this table; it is brought to the rows only while it is small.
    sources = written(quotas(written(by_source, "mix-sums"), budget, **target), "mix-sources")
    n_docs = sources.agg(F.sum("n_docs")).first()[0] or 0
    sources = sources.drop("n_docs")
    ranges = max(1, -(-n_docs // _RANGE_ROWS))
    shift = 64 - min(40, (ranges - 1).bit_length())

    # Passes as rows: the full ones and, where the quota asks for it, one more in part.
    met = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    last = F.col("full") - F.when(F.col("quota") % F.col("tokens") == 0, 1).otherwise(0)
    turns = met.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0).cast("long")))))
    turns = turns.withColumn("key", pass_key(F.col("same"), F.col("turn")))
    turns = turns.withColumn("range", F.shiftright("key", shift) if shift < 64 else F.lit(0).cast("long"))
    by_range = turns.groupBy("s", "turn", "range").agg(F.sum("n_tokens").alias("sum"))
    ahead = Window.partitionBy("s", "turn").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(by_range.select("s", "turn", "range", F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("start")), "mix-ranges")
    inside = Window.partitionBy("s", "turn", "range").orderBy("key", "doc").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.join(starts, ["s", "turn", "range"]).withColumn(
        "at", F.col("turn") * F.col("tokens") + F.col("start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    )
    placed = written(placed.where(F.col("at") + F.col("n_tokens") <= F.col("quota")).drop("range", "start"), "mix-placed")
    return placed, sources


def pass_key(same: Column, turn: Column) -> Column:
    """Where a document stands in a pass: passes go through the keys in ascending order."""
    return F.xxhash64(same, turn)


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    budget: int | None = None, entropy: float | None = None, repeat_limit: float | None = REPEAT_LIMIT,
    block_tokens: int = BLOCK_TOKENS, seed: int = SEED,
) -> DataFrame:
    """One row per document and pass: id, source, ``turn`` (from 0), ``n_tokens``, ``weight``, ``block``, ``slot``.

    ``block`` and ``slot`` (gapless from 0 in a block) are the order to read in.  Without a budget every
    document comes at least once.  A full pass takes every document of its source; the last pass stops
    before the first document that would exceed the quota.  A null source is a source of its own; a null
    or empty text counts one token; a row without an id is a row like others.  Equal rows come as often
    as they are given.  An empty table gives an empty table; other columns are not looked at.
    """
    if entropy is not None:
        repeat_limit = None
    placed, sources = _plan(docs, id_col, text_col, source_col, budget, seed, entropy=entropy, repeat_limit=repeat_limit)
    total = sources.agg(F.sum("quota")).first()[0] or 0
    n_blocks = max(1, round(total / block_tokens))
    share = F.floor(F.col("at") / F.col("quota") * n_blocks).cast("long")
    rows = placed.withColumn("block", F.least(share, F.lit(n_blocks - 1).cast("long")))
    rows = rows.withColumn("order", F.xxhash64(F.lit(seed), "block", "turn", "same"))
    slot = F.row_number().over(Window.partitionBy("block").orderBy("order", "doc", "s", "at")) - 1
    return rows.select(
        F.col("doc").alias(id_col), F.col("source").alias(source_col), "turn", "n_tokens", "weight", "block", slot.cast("long").alias("slot")
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    budget: int | None = None, entropy: float | None = None, repeat_limit: float | None = REPEAT_LIMIT, seed: int = SEED,
) -> DataFrame:
    """``docs``, all columns as they are, each row as often as :func:`mix_sources` takes it.

    The texts are not moved: a row counts its source's full passes and compares its key with the last
    key of the partial one.  Rows equal in id and text are taken alike.
    """
    if entropy is not None:
        repeat_limit = None
    placed, sources = _plan(docs, id_col, text_col, source_col, budget, seed, entropy=entropy, repeat_limit=repeat_limit)
    cuts = placed.where(F.col("turn") == F.col("full")).groupBy("s").agg(F.max("key").alias("cut"))
    small = written(sources.join(cuts, "s", "left").select("of", "full", "cut"), "mix-cuts")
    of, full, cut, copy = fresh(docs, "of", "full", "cut", "copy")
    small = small.toDF(of, full, cut)
    rows = docs.join(small, column(source_col).eqNullSafe(F.col(of)))
    same = F.xxhash64(F.lit(seed), column(id_col), column(text_col))
    partial = F.coalesce(pass_key(same, F.col(full)) <= F.col(cut), F.lit(False)).cast("int")
    times = F.col(full).cast("int") + partial
    rows = rows.withColumn(copy, F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))))
    return rows.select(*[column(c) for c in docs.columns])
