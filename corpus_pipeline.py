"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Language ID rejects texts without letters, and texts that share much less with the language nearest to them than
that language's labelled texts of their length; line dedup takes lines that many documents share out of the texts; near-dedup keeps one document of
each group; mixing repeats documents so that small sources weigh more (none is left out); packing cuts and
packs the token ids of what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import Scratch, small_batches, written
from eventloom.llm.langid import UNKNOWN, language_column, learn_profiles, least_scores, length_class
from eventloom.llm.lines import without_shared_lines
from eventloom.llm.minhash import one_of_each
from eventloom.llm.mixing import mixed_documents
from eventloom.llm.packing import pack_documents

# A text below this score has hardly an n-gram in common with the language nearest to it; it is asked of texts whose
# language has too few labelled texts of their length to tell.
MIN_LANGUAGE_SCORE = 0.1

# Near-duplicates for a corpus: similarity 0.8 or more.  With 30 bands of 4, a pair at 0.8 shares no band with a
# probability of 1.4e-7, and less above it.
SIMILARITY, BANDS, ROWS = 80, 30, 4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones are written in.

    A null text, and one without letters, is in none.  Without any labelled text nothing is learned, and all documents
    stay.  Equal texts are kept or rejected together, whatever their ids (null ones too), labels and other columns; an
    empty table stays empty.
    """
    with small_batches(spark):
        profiles = written(learn_profiles(docs), "pipeline-profiles")
    if profiles.isEmpty():
        return docs
    found = language_column(profiles, F.col("text"))
    # Written: the limits come from all scores, and then every row meets its limit; texts are looked at once.
    rows = docs.select(F.struct("*").alias("row"), F.col("lang").alias("lang"), found.alias("found"), length_class(F.col("text")).alias("class"))
    with small_batches(spark):
        rows = written(rows.select("row", "lang", "found.*", "class"), "pipeline-languages")
    least = F.lit(MIN_LANGUAGE_SCORE)
    if limits := least_scores(rows, floor=MIN_LANGUAGE_SCORE):
        by_class = F.create_map(*[F.lit(x) for (lang, class_), limit in limits.items() for x in (f"{class_} {lang}", limit)])
        least = F.coalesce(by_class[F.concat_ws(" ", "class", "lang_pred")], least)
    return rows.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that five or more share; the one of the largest id keeps them.

    All rows stay, with a null text as an empty one and ``n_chars`` counted anew; repeated rows are one document to a
    line and lose it alike; rows without an id count as no document and lose the lines that five others share.  An
    empty table stays empty; other columns stay as they are, whatever their names.
    """
    return without_shared_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id.

    Texts without words and rows without an id are linked with nothing and stay; repeated rows of the id that stays
    all stay.  An empty table stays empty; other columns stay as they are, whatever their names.
    """
    return one_of_each(docs, similarity=SIMILARITY, bands=BANDS, rows=ROWS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for, once at least.

    A null source is a source of its own, a null text a short one, a row without an id or a repeated one a row like
    others; rows equal in id and text come equally often.  An empty table stays empty.
    """
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the packed sequences.

    A null or empty text is an end alone; null and repeated ids are documents of their own; no documents, no pieces.
    """
    return pack_documents(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

# Profiles, signatures and token ids are beyond SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with Scratch() as tables:  # what a stage wrote on its way goes when its rows are written
            docs = tables.keep(written(stage(spark, docs, sf_dir), f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
