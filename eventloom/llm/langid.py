"""Language ID by rank-order n-gram profiles.

A profile is the list of the most frequent letter n-grams (one to three letters, word ends marked) of all
training texts of a language, most frequent first; a document's profile is made alike from its whole text.
The out-of-place distance adds up, over the document's n-grams, how many ranks apart the two lists have
them, and the full list length for those that the language lacks.  The nearest language is the answer.

N-grams are counted inside each task and only the sums are shuffled; the ranking keeps the first ranks of
each partition before it shuffles.  The profiles are bounded: ``PROFILE`` rows for each language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, worker_store
from .tokens import forget_encoders, segments

PROFILE = 300
# A label set larger than this is no set of languages: an error, as its profiles would not be a small table.
MAX_LANGUAGES = 2000
UNKNOWN = "und"
LEAST_TEXTS = 30  # labelled texts of a language and length whose scores tell what is too low
_EDGE = 1  # stands for a word's end; no letter has this number
_FLUSH = 1 << 20


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    store = worker_store()
    if "letters" not in store:
        store["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return store["letters"]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The letter n-grams of the whole text as numbers (21 bits a letter), ascending, and how often each stands in it."""
    letters, found = _letters(), []
    for part in segments(text):
        at = np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        x = np.full(len(at) + 2, _EDGE, np.int64)
        x[1:-1] = np.where(letters[at], at, _EDGE)
        x = x[np.concatenate([[True], (x[1:] != _EDGE) | (x[:-1] != _EDGE)])]
        two = (x[:-1] << 21) | x[1:]
        three = (two[:-1] << 21) | x[2:]
        found += [x[x != _EDGE], two, three[x[1:-1] != _EDGE]]
    grams = np.concatenate(found) if found else np.zeros(0, np.int64)
    return np.unique(grams[grams != _EDGE], return_counts=True) if len(grams) else (grams, grams)


def top_grams(text: str, size: int) -> np.ndarray:
    """The text's ``size`` most frequent n-grams, ties in ascending order."""
    grams, n = gram_counts(text)
    return grams[np.lexsort((grams, -n))[:size]]


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """Profiles of the languages of ``docs``: ``lang``, ``gram``, ``rank`` (from 0), ``size`` rows for each at most.

    Rows whose text or language is null are not learned from.
    """
    rows = docs.select(column(lang_col).cast("string").alias("lang"), column(text_col).alias("text")).dropna()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = {}, 0
        forget_encoders()

        def flush():
            for lang, parts in held.items():
                grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(where, np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], names=["lang", "gram", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                grams, n = gram_counts(text.as_py())
                held.setdefault(lang, []).append((grams, n))
                n_held += len(grams)
                if n_held > _FLUSH:
                    yield from flush()
                    held, n_held = {}, 0
        yield from flush()

    sums = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return sums.withColumn("rank", rank - 1).where(F.col("rank") < size).select("lang", "gram", "rank")


def _profile_tables(profiles: DataFrame, size: int) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
    rows = profiles.limit(MAX_LANGUAGES * size + 1).toPandas()
    if len(rows) > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    tables, langs = [], sorted(rows["lang"].unique())
    for lang in langs:
        own = rows[rows["lang"] == lang].sort_values("gram")
        tables.append((own["gram"].to_numpy(np.int64), own["rank"].to_numpy(np.int64)))
    return langs, tables


def nearest(grams: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]], size: int) -> tuple[int, float]:
    """Which profile has the least out-of-place distance, and that distance as a share of the largest possible."""
    own = np.arange(len(grams))
    best, least = 0, None
    for k, (known, ranks) in enumerate(tables):
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        apart = np.where(known[at] == grams, np.abs(ranks[at] - own), size).sum()
        if least is None or apart < least:
            best, least = k, apart
    return best, least / (size * len(grams))


def language_column(profiles: DataFrame, text: Column, size: int = PROFILE) -> Column:
    """A column with ``lang_pred`` and ``score`` for a column of texts.

    The score is one minus the distance as a share of the largest possible: 0 for a text that shares no
    n-gram with the language.  A text that is null or has no letters, and any text when nothing was
    learned, gets ``und`` and 0; a tie goes to the first language in order.
    """
    langs, tables = _profile_tables(profiles, size)

    @F.pandas_udf("lang_pred string, score double")
    def identify(texts: pd.Series) -> pd.DataFrame:
        out = []
        forget_encoders()
        for t in texts:
            grams = top_grams(t, size) if t and tables else ()
            if len(grams):
                k, apart = nearest(grams, tables, size)
                out.append((langs[k], 1.0 - float(apart)))
            else:
                out.append((UNKNOWN, 0.0))
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    return identify(text)


def length_class(text: Column) -> Column:
    """The binary digits of a text's length in characters."""
    return F.length(F.bin(F.length(text)))


def least_scores(found: DataFrame, floor: float = 0.1, spread: float = 4.0) -> dict[tuple[str, int], float]:
    """Least scores by (language, length class), as the labelled texts' own scores ask for them.

    ``found`` has ``lang``, ``lang_pred``, ``score`` and ``class`` of every text.  Over all texts whose label the profiles
    find: the median less ``spread`` times its distance to the score that one text in twenty stays below, so that odd
    texts among the labelled ones don't lower it; not below ``floor``.  A class with fewer than ``LEAST_TEXTS`` such texts
    takes the limit of the next shorter one, as longer texts score higher; it is left out if there is none.
    """
    right = found.where(F.col("lang") == F.col("lang_pred"))
    middle, low = (F.percentile_approx("score", p, 1000) for p in (0.5, 0.05))
    sums = right.groupBy("lang", "class").agg(F.count(F.lit(1)).alias("n"), middle.alias("middle"), low.alias("low")).where(F.col("n") >= LEAST_TEXTS)
    # A few dozen length classes for each language.
    limits = {(r["lang"], r["class"]): max(floor, r["middle"] - spread * (r["middle"] - r["low"])) for r in sums.collect()}
    for lang in {lang for lang, _ in limits}:
        for longer in range(1, 33):
            if (lang, longer - 1) in limits:
                limits.setdefault((lang, longer), limits[lang, longer - 1])
    return limits


def held_out(doc: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the id as text falls into the held-out fold (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc.cast("string"), F.lit(""))) % folds == fold


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """One row per row: id, ``held_out``, ``lang_pred``, ``score``.

    Learns from the rows that are not held out.  See :func:`language_column` for texts without letters;
    equal texts get equal answers; an empty table gives an empty table; other columns are not looked at.
    """
    docs = docs.select(column(id_col), column(text_col), column(lang_col))
    out = held_out(column(id_col))
    found = language_column(learn_profiles(docs.where(~out), text_col, lang_col, size), column(text_col), size)
    rows = docs.select(column(id_col), out.alias("held_out"), found.alias("found"))
    return rows.select(column(id_col), "held_out", "found.lang_pred", "found.score")
