"""Quality scores by a generalised additive model with pairwise interactions.

1. Every text is described by a few dozen numbers about its form, whatever its language (``FEATURES``), in one
   pass over the whole text; the numbers are written.
2. A sample of labelled rows, ``fit_rows`` of them at most but for chance, is brought to the driver: the numbers
   and the label, no texts.  Values become bins at the sample's quantiles.
3. Cyclic boosting: feature after feature, round after round, a shallow tree of up to three cuts is fitted to
   the gradients summed by bin, and added to the feature's lookup table.  The pairs whose cuts explain most of
   what is left then get tables by two features, boosted alike.  A part of the sample, told by a hash, decides how
   many rounds are kept.
4. A score adds up the table cells of a text's bins: array look-ups over whole batches in the tasks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, written
from .langid import held_out

FIT_ROWS = 50_000
BINS = 32
PAIR_BINS = 8
PAIRS = 12
ROUNDS = 300
RATE = 0.1
PATIENCE = 20
RIDGE = 1.0
LEAST_WEIGHT = 2.0  # sum of second derivatives on either side of a cut
THRESHOLD = 0.3
_SEGMENT = 1 << 20
_BLANKS = b" \t\n\x0b\x0c\r"

# Kinds of bytes; a byte beyond ASCII counts as part of a letter.
_KINDS = ["lower", "upper", "beyond", "digit", "stop", "comma", "quote", "shout", "bar", "other", "blank", "line"]
_OF = np.full(256, _KINDS.index("other"), np.uint8)
for _kind, _bytes in {
    "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "beyond": bytes(range(128, 256)), "digit": b"0123456789", "stop": b".?",
    "comma": b",;:", "quote": b"'\"()-", "shout": b"!", "bar": b"|", "blank": b" \t\x0b\x0c\r", "line": b"\n",
}.items():
    _OF[list(_bytes)] = _KINDS.index(_kind)
_IS_BLANK = np.isin(np.arange(256), list(_BLANKS))
_IS_WORD = np.isin(_OF, [_KINDS.index(k) for k in ("lower", "upper", "beyond", "digit")])
_IS_LETTER = np.isin(_OF, [_KINDS.index(k) for k in ("lower", "upper", "beyond")])

FEATURES = [
    "log_bytes", "log_words", *[f"share_{k}" for k in _KINDS], "upper_of_letters", "vowels_of_letters",
    "word_mean", "word_deviation", "short_words", "long_words", "capital_words", "marked_words", "bare_words",
    "words_per_stop", "words_per_line", "log_repeats", "top_word", "top_ten_words", "same_as_before", "repeated_lines", "longest_run",
]


def _segments(data: bytes) -> Iterator[bytes]:
    """Runs of about a million bytes that end after a blank."""
    lo = 0
    while lo < len(data):
        hi = lo + _SEGMENT
        while hi < len(data) and data[hi - 1] not in _BLANKS:
            at = min((i for i in (data.find(b" ", hi), data.find(b"\n", hi)) if i >= 0), default=len(data) - 1)
            hi = at + 1
        yield data[lo:hi]
        lo = hi


def _longest_run(at: np.ndarray) -> int:
    """The length of the longest run of one byte that is no blank."""
    edges = np.flatnonzero(np.diff(at)) + 1
    lengths = np.diff(np.concatenate([[0], edges, [len(at)]]))
    firsts = at[np.concatenate([[0], edges])]
    return int(lengths[~_IS_BLANK[firsts]].max(initial=0))


def describe(text: str | None) -> list[float]:
    """The numbers of FEATURES; an empty or null text has zeros only."""
    data = (text or "").encode("utf-8", "replace")
    if not data:
        return [0.0] * len(FEATURES)
    kinds, words, lines = np.zeros(len(_KINDS)), Counter(), Counter()
    n = length = squares = short = long = capital = marked = bare = same = vowels = run = 0
    last, line = None, []  # the word before, and the parts of a line that goes on
    for part in _segments(data):
        at = np.frombuffer(part, np.uint8)
        seen = np.bincount(at, minlength=256)
        kinds += np.bincount(_OF, seen, len(_KINDS))
        vowels += int(seen[list(b"aeiouAEIOU")].sum())
        full = np.concatenate([[False], ~_IS_BLANK[at], [False]])
        starts, ends = np.flatnonzero(full[1:] & ~full[:-1]), np.flatnonzero(full[:-1] & ~full[1:])
        if len(starts):
            size = ends - starts
            n += len(size)
            length += int(size.sum())
            squares += int((size * size).sum())
            short += int((size <= 3).sum())
            long += int((size > 12).sum())
            capital += int((_OF[at[starts]] == _KINDS.index("upper")).sum())
            marked += int((~_IS_WORD[at[ends - 1]]).sum())
            letters = np.concatenate([[0], np.cumsum(_IS_LETTER[at])])
            bare += int((letters[ends] == letters[starts]).sum())
        own = part.lower().split()
        words.update(own)
        if own:
            same += sum(map(eq, own, own[1:])) + (own[0] == last)
            last = own[-1]
        ended = part.split(b"\n")
        line.append(ended[0])
        if len(ended) > 1:
            lines.update([b"".join(line).strip(), *[x.strip() for x in ended[1:-1]]])
            line = ended[-1:]
        run = max(run, _longest_run(at))
    lines.update([b"".join(line).strip()])
    del lines[b""]
    bytes_, words_, total = len(data), max(n, 1), sum(lines.values())
    mean = length / words_
    top = sorted(words.values(), reverse=True)[:10] or [0]
    letters = kinds[[_KINDS.index(k) for k in ("lower", "upper")]].sum()
    out = [
        np.log2(1 + bytes_), np.log2(1 + n), *(kinds / bytes_), kinds[_KINDS.index("upper")] / max(letters, 1), vowels / max(letters, 1),
        mean, max(squares / words_ - mean * mean, 0.0) ** 0.5, short / words_, long / words_, capital / words_, marked / words_, bare / words_,
        np.log2(1 + n / (1 + kinds[_KINDS.index("stop")])), np.log2(1 + n / max(total, 1)), np.log2(words_ / max(len(words), 1)),
        top[0] / words_, sum(top) / words_, same / words_, 1 - len(lines) / max(total, 1), np.log2(1 + run),
    ]
    return [float(x) for x in out]


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc``, ``held_out``, ``features`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([describe(t.as_py()) for t in batch.column(2)], np.float32).reshape(batch.num_rows, len(FEATURES))
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES))
            lists = pa.ListArray.from_arrays(ends, pa.array(rows.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["doc", "held_out", "features"])

    doc = column(id_col)
    rows = docs.select(doc.cast("long").alias("doc"), held_out(doc, 5, 0).alias("held_out"), column(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc long, held_out boolean, features array<float>")


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best cut of a row of bins into two sides: what it gains, and where the right side starts (0: none)."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    all_g, all_h = g.sum(), h.sum()
    gain = left_g**2 / (left_h + RIDGE) + (all_g - left_g) ** 2 / (all_h - left_h + RIDGE) - all_g**2 / (all_h + RIDGE)
    gain[(left_h < LEAST_WEIGHT) | (all_h - left_h < LEAST_WEIGHT)] = 0
    if not len(gain) or gain.max() <= 1e-12:
        return 0.0, 0
    return float(gain.max()), int(gain.argmax()) + 1


def _value(g: np.ndarray, h: np.ndarray) -> float:
    return -float(g.sum()) / (float(h.sum()) + RIDGE)


def shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """What a tree of one cut, and one more on each side, adds to each bin; ``g`` and ``h`` are sums of derivatives by bin."""
    out = np.zeros(len(g))
    _, at = _cut(g, h)
    for lo, hi in ((0, at), (at, len(g))) if at else ((0, len(g)),):
        _, inner = _cut(g[lo:hi], h[lo:hi]) if at else (0, 0)
        for a, b in ((lo, lo + inner), (lo + inner, hi)) if inner else ((lo, hi),):
            out[a:b] = _value(g[a:b], h[a:b])
    return out


def _cut_table(g: np.ndarray, h: np.ndarray) -> tuple[float, int, int]:
    """The best cut of a table along one of its two axes: gain, axis, place."""
    cuts = [(*_cut(g.sum(1 - axis), h.sum(1 - axis)), axis) for axis in (0, 1)]
    gain, at, axis = max(cuts, key=lambda c: c[0])
    return gain, axis, at


def shallow_pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Like :func:`shallow_tree` over a table of two features, each cut along either; and what its cuts gain."""
    out = np.zeros(g.shape)
    total, axis, at = _cut_table(g, h)
    halves = [(slice(None),) * 2]
    if at:
        halves = [(slice(0, at), slice(None)), (slice(at, None), slice(None))]
        halves = [half if axis == 0 else half[::-1] for half in halves]
    for half in halves:
        own_g, own_h, own = g[half], h[half], out[half]
        gain, inner_axis, inner = _cut_table(own_g, own_h) if at else (0.0, 0, 0)
        total += gain
        quarters = [(slice(None),) * 2]
        if inner:
            quarters = [(slice(0, inner), slice(None)), (slice(inner, None), slice(None))]
            quarters = [q if inner_axis == 0 else q[::-1] for q in quarters]
        for q in quarters:
            own[q] = _value(own_g[q], own_h[q])
    return total, out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Lookup tables: by feature over its bins, and by pair of features over their coarser bins."""

    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def scores(self, features: np.ndarray) -> np.ndarray:
        """Probabilities of label 1, one for each row of features."""
        total = np.full(len(features), self.start)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], features[:, f], "right")]
        used = sorted({f for pair in self.pairs for f in pair})
        coarse = {f: np.searchsorted(self.pair_edges[f], features[:, f], "right") for f in used}
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[coarse[a], coarse[b]]
        return _sigmoid(total)


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between the bins: quantiles, each once."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="lower")) if len(values) else np.zeros(0, np.float32)


def _loss(y: np.ndarray, total: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, total) - y * total)) if len(y) else 0.0


def _boost(terms: list[tuple], y: np.ndarray, total: np.ndarray, held: np.ndarray) -> list[np.ndarray]:
    """Cyclic boosting of one table for each term (cell of each row, shape of the table), onto ``total``, in place.

    Rounds go on until the held rows' loss has not fallen for ``PATIENCE`` rounds; the best round's tables are kept.
    """
    learn = ~held
    tables = [np.zeros(shape) for _, shape in terms]
    best, least, since = [t.copy() for t in tables], _loss(y[held], total[held]), 0
    for _ in range(ROUNDS):
        for (cells, shape), table in zip(terms, tables):
            p = _sigmoid(total)
            own = cells[learn]
            g = np.bincount(own, (p - y)[learn], table.size).reshape(shape)
            h = np.bincount(own, (p * (1 - p))[learn], table.size).reshape(shape)
            step = RATE * (shallow_tree(g, h) if len(shape) == 1 else shallow_pair_tree(g, h)[1])
            table += step
            total += step.reshape(-1)[cells]
        loss = _loss(y[held], total[held])
        if loss < least - 1e-7:
            best, least, since = [t.copy() for t in tables], loss, 0
        else:
            since += 1
            if since >= PATIENCE:
                break
    for (cells, _), table, kept in zip(terms, tables, best):
        total += (kept - table).reshape(-1)[cells]
    return best


def fit(features: np.ndarray, y: np.ndarray, held: np.ndarray) -> Model:
    """The model of labels ``y`` (0 to 1); rows of ``held`` only tell when to stop.  Without rows every score is 0.5."""
    n = features.shape[1]
    rate = (y.sum() + 0.5) / (len(y) + 1.0)
    start = float(np.log(rate / (1 - rate)))
    total = np.full(len(y), start)
    edges = [_edges(features[:, f], BINS) for f in range(n)]
    bins = [np.searchsorted(e, features[:, f], "right") for f, e in enumerate(edges)]
    tables = _boost([(b, (len(e) + 1,)) for b, e in zip(bins, edges)], y, total, held) if len(y) else [np.zeros(1)] * n
    coarse_edges = [_edges(features[:, f], PAIR_BINS) for f in range(n)]
    coarse = [np.searchsorted(e, features[:, f], "right") for f, e in enumerate(coarse_edges)]
    sizes = [len(e) + 1 for e in coarse_edges]
    p = _sigmoid(total)
    gains = []
    for a, b in combinations(range(n), 2) if len(y) else ():
        cells = (coarse[a] * sizes[b] + coarse[b])[~held]
        g = np.bincount(cells, (p - y)[~held], sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])
        h = np.bincount(cells, (p * (1 - p))[~held], sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])
        gain, _ = shallow_pair_tree(g, h)
        gains.append((-gain, a, b))
    pairs = [(a, b) for gain, a, b in sorted(gains)[:PAIRS] if gain < 0]
    terms = [(coarse[a] * sizes[b] + coarse[b], (sizes[a], sizes[b])) for a, b in pairs]
    pair_tables = _boost(terms, y, total, held) if pairs else []
    return Model(start, edges, tables, coarse_edges, pairs, pair_tables)


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality",
    fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row: id, ``held_out``, ``score`` (0 to 1, higher: label 1 is likelier), ``predicted``.

    Learns from rows that are not held out (crc32 of the id as text mod 5 is not 0; a null id counts as the empty text)
    and have a label; about ``fit_rows`` of them, chosen by a hash, if there are more.  A label is 1 or not; several labels of
    an id count by their mean, null ones not at all, nor do labels without a row.  Only the text's own numbers enter a
    score, so equal texts get equal ones.  A null text is scored as an empty one.  Without labelled rows every score is 0.5;
    an empty table gives an empty table; other columns are not looked at.  Ids come back as 64-bit integers.
    """
    rows = written(described(docs, id_col, text_col).withColumn("at", F.monotonically_increasing_id()), "quality-features")
    mark = F.when(column(label_col) == 1, 1.0).when(column(label_col).isNotNull(), 0.0)
    known = labels.select(column(label_id).cast("long").alias("of"), mark.alias("y")).dropna().groupBy("of").agg(F.avg("y").alias("y"))
    met = rows.where(~F.col("held_out")).join(known, F.col("doc") == F.col("of")).select("doc", "at", "features", "y")
    n = met.count()
    place = F.pmod(F.xxhash64(F.lit(11), "doc", "at"), F.lit(1 << 32))
    sample = met.where(place < min(1 << 32, (fit_rows << 32) // max(n, 1))).orderBy("doc", "at")
    got = sample.select("features", "y", (F.pmod(F.xxhash64(F.lit(13), "doc"), F.lit(5)) == 0).alias("held")).toArrow()
    features = got["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(got), len(FEATURES))
    model = fit(features, got["y"].to_numpy(), got["held"].to_numpy())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            scores = model.scores(numbers)
            predicted = (scores >= threshold).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array(predicted)], names=["doc", "held_out", "score", "predicted"])

    out = rows.select("doc", "held_out", "features").mapInArrow(score, "doc long, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("doc", id_col)
