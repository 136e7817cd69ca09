"""Line dedup: drop lines that many documents share.

Lines are exploded, normalised and hashed (128 bits in two 64-bit hashes); documents are counted per
hash with ``count(DISTINCT)``, whose first shuffle is by (hash, document), so a line that a third of
all documents hold is spread before it meets in one sum.  Only hashes and positions are shuffled for
the counts; the texts move once, when they meet the list of positions to drop, and are put together
again by position.  The join of lines with frequent hashes is an inner sort-merge join, whose hot
partitions adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, LOWER, UPPER, column, fresh, written

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """The line without ASCII blanks at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _row_key(doc: Column, text: Column) -> list[Column]:
    # A row's identity is its id and text: rows equal in both lose the same lines.
    return [F.xxhash64(doc, text).alias("r1"), F.xxhash64(F.lit("row"), text, doc).alias("r2")]


def frequent_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(one row per long line with its hash, position and document; the hashes in ``min_docs`` documents)."""
    doc, text = column(id_col), column(text_col)
    cells = docs.select(*_row_key(doc, text), doc.alias("doc"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    keyed = cells.where(F.length("line") >= min_chars).select("r1", "r2", "doc", "pos", line_key(F.col("line")).alias("key"))
    lines = keyed.where(F.length("key") >= min_chars).select(
        "r1", "r2", "doc", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), F.col("key")).alias("h2")
    )
    counts = lines.groupBy("h1", "h2").agg(F.countDistinct("doc").alias("n_docs"), F.max("doc").alias("keeper"))
    # Written, so that the join with it can be split where a line is hot, or broadcast while Spark finds it small.
    return lines, written(counts.where(F.col("n_docs") >= min_docs), "frequent-lines")


def _reassembled(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int):
    lines, frequent = frequent_lines(docs, id_col, text_col, min_chars, min_docs)
    drops = (
        lines.join(frequent, ["h1", "h2"])
        .where(F.col("doc").isNull() | (F.col("doc") != F.col("keeper")))
        .groupBy("r1", "r2")
        .agg(F.collect_set("pos").alias("gone"))
    )
    r1, r2, gone, cut = fresh(docs, "r1", "r2", "gone", "cut")
    k1, k2 = _row_key(column(id_col), column(text_col))
    drops = drops.select(F.col("r1").alias(r1), F.col("r2").alias(r2), F.col("gone").alias(gone))
    rows = docs.select("*", k1.alias(r1), k2.alias(r2)).join(drops, [r1, r2], "left")
    rows = rows.select("*", F.split(F.coalesce(column(text_col), F.lit("")), "\n").alias(cut))
    lines_, gone_ = F.col(cut), F.col(gone)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines_) - 1), gone_)
    text = F.when(gone_.isNull(), F.coalesce(column(text_col), F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines_, i)), "\n")
    )
    return rows, text, F.size(lines_).cast("long"), F.coalesce(F.size(gone_), F.lit(0)).cast("long")


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """One row per document: id, text without the dropped lines, ``n_lines`` (before), ``n_dropped``.

    A line whose key has ``min_chars`` code points or more and stands in ``min_docs`` documents or more
    goes from every document but the one of the largest id that holds it.  A null or empty text is one
    empty line and comes back empty; a text that loses all lines comes back empty.  A row without an id
    counts as no document and loses its frequent lines; rows with the same id are one document in the
    counts.  Equal rows come back as often as they came.  An empty table gives an empty table; other
    columns are not looked at.
    """
    docs = docs.select(column(id_col), column(text_col))
    rows, text, n_lines, n_dropped = _reassembled(docs, id_col, text_col, min_chars, min_docs)
    return rows.select(column(id_col), text.alias(text_col), n_lines.alias("n_lines"), n_dropped.alias("n_dropped"))


def without_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs``, all columns as they are but for the text, from which the dropped lines are gone (see :func:`line_dedup`)."""
    how = {"min_chars": MIN_CHARS, "min_docs": MIN_DOCS} | how
    rows, text, _, _ = _reassembled(docs, id_col, text_col, **how)
    return rows.select(*[text.alias(c) if c == text_col else column(c) for c in docs.columns])
