"""Language-model scores by a Brown class bigram model.

P(text) is the product over its words and its end of P(class | class before) * P(word | class).

1. The corpus is dictionary-encoded where it lies: each task cuts its documents into chunks of a bounded
   number of tokens, numbers a chunk's distinct words, and writes the numbers and the chunk's word counts.
   Texts are not shuffled.
2. Word counts are summed over all chunks, and joined back to the chunks' own dictionaries: what is
   shuffled is one row per chunk and distinct word, not one per token.  A chunk then meets its dictionary,
   and every token becomes a symbol: one of the ``CLUSTERED`` most frequent words, the text's end, a
   frequency band of the other words (by powers of two), or the unknown word.
3. Symbol bigrams of all training texts are counted (a bounded table: symbols squared).  The frequent
   words start in ``CLASSES`` classes and are exchanged, each in turn to the class that raises the
   likelihood of the class bigrams most, until none moves.  Bands, end and unknown are classes of their own.
4. Every other word of count ``LEAST_COUNT`` or more then leaves its band for the class with the same gain.
   Its neighbours' classes are counted chunk by chunk and summed by word (one row per chunk and word is
   shuffled; words of count ``HOT_COUNT`` or more are summed in parts first, so that no task holds a row for
   each chunk); tasks score the sums against the class table, one answer a word.  Up to ``SENT_WORDS``
   answers are sent to all tasks; more of them are joined back to the chunks by word.  All
   these words choose at once, against the classes before; ``WORD_SWEEPS`` times, then it stops.  How many
   words choose follows the corpus; rarer words keep their bands.
5. Transitions are smoothed towards the class frequencies.  They are counted as if each rare occurrence
   were left out of the corpus: a word of count c counts for the band of c-1, one of count 1 as unknown.
   That is where unseen words get their probability from.  A known word's emission is its share of its class.

The driver holds the bounded bigram table, the class matrix and at most ``SENT_WORDS`` answers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column, written
from .langid import held_out
from .tokens import Numbered, segments

CLUSTERED = 1024  # the words that are exchanged one after the other and make the classes
CLASSES = 64
LEAST_COUNT = 8  # of a word that chooses its class, a power of two; rarer ones are classed by frequency band
SMOOTHING = 50.0
CHUNK_TOKENS = 1 << 21
WORD_SWEEPS = 2
HOT_COUNT = 1 << 18  # from here on a word's counts meet in two steps; below, they are few enough for a task's memory
HOT_PARTS = 256
SENT_WORDS = 1 << 22  # ten bytes each
_UNKNOWN, _END, _WORDS = 0, 1, 2  # symbols; the bands follow the words, two each: counts that are a power of two, and others
_BANDS = 48
_SUMS, _SUM_NAMES = "word long, own int, codes binary, counts binary", ["word", "own", "codes", "counts"]
_CHUNK = "chunk long, docs array<long>, held array<boolean>, lengths array<long>, ids binary, words array<binary>, counts array<long>"
_CODED = "chunk long, docs array<long>, held array<boolean>, lengths array<long>, places binary, words binary, named binary, base array<double>, known array<long>, emit array<double>"


def _packed(x: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def chunks(docs: DataFrame, id_col: str, text_col: str, chunk_tokens: int) -> DataFrame:
    """The documents as chunks of word numbers; number 0 is the end of a text, its word is empty."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, n_chunks = Numbered({b"": 0}), 0
        ids, held, names, lengths, held_tokens = [], [], [], [], 0

        def chunk():
            flat, n = np.concatenate(ids), np.array(lengths, np.int64)
            trained = np.repeat(~np.array(held, bool), n)
            counts = np.bincount(flat[trained], minlength=len(number)).astype(np.int64)
            row = [[TaskContext.get().partitionId() << 33 | n_chunks], [names], [held], [n], [_packed(flat)], [list(number)], [counts]]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=[f.split()[0] for f in _CHUNK.split(", ")])

        for batch in batches:
            for doc, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                n = 1
                for part in segments(text.as_py() or ""):
                    words = part.encode().lower().split()
                    ids.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                    n += len(words)
                ids.append(np.zeros(1, np.uint32))
                names.append(doc)
                held.append(out)
                lengths.append(n)
                held_tokens += n
                if held_tokens >= chunk_tokens:
                    yield chunk()
                    number, n_chunks = Numbered({b"": 0}), n_chunks + 1
                    ids, held, names, lengths, held_tokens = [], [], [], [], 0
        if names:
            yield chunk()

    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
    doc = column(id_col)
    rows = docs.select(doc.cast("long").alias("doc"), held_out(doc, 7, 2).alias("held"), column(text_col).alias("text"))
    return rows.mapInArrow(encode, _CHUNK)


def dictionaries(rows: DataFrame, n_tasks: int, **kinds: type) -> DataFrame:
    """Rows (chunk, place, ...) as one row per chunk: the named columns, each packed in the order of places.

    Chunks are dealt out one after the other; ``n_tasks`` is the number of tasks that made them.
    """

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = None, []

        def row():
            cells = [[_packed(np.concatenate([x[i] for x in held]).astype(kind))] for i, kind in enumerate(kinds.values())]
            arrays = [pa.array([chunk], pa.int64()), *[pa.array(c, pa.binary()) for c in cells]]
            return pa.RecordBatch.from_arrays(arrays, names=["chunk", *kinds])

        for batch in batches:
            own, *columns = (c.to_numpy() for c in batch.columns)
            cuts = (np.flatnonzero(np.diff(own)) + 1).tolist()
            for lo, hi in zip([0, *cuts], [*cuts, len(own)]):
                if held and own[lo] != chunk:
                    yield row()
                    held = []
                chunk = own[lo]
                held.append([c[lo:hi] for c in columns])
        if held:
            yield row()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.shiftright("chunk", 33) + F.col("chunk").bitwiseAND((1 << 33) - 1) * n_tasks
    dealt = rows.repartitionById(n, F.pmod(place, F.lit(n)).cast("int")).sortWithinPartitions("chunk", "place").select("chunk", *kinds)
    return dealt.mapInArrow(gather, ", ".join(["chunk long", *[f"{name} binary" for name in kinds]]))


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def coded(chunked: DataFrame, dictionary: DataFrame, n_tokens: int, n_words: int, n_base: int) -> DataFrame:
    """Chunks of symbols, with each document's base score, known tokens and log count of its known tokens.

    ``places`` has a symbol below ``n_base`` for each token, or ``n_base`` and more for the chunk's words that
    choose a class: ``words`` has their numbers, ``named`` the symbols that they stand for so far.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            ids, counts, symbols = _unpacked(row["ids"], np.uint32), _unpacked(row["counts"], np.int64), _unpacked(row["symbols"], np.uint16)
            words = _unpacked(row["words"], np.int64)
            chooses = words >= 0
            places = symbols.astype(np.uint32)
            places[chooses] = n_base + np.arange(int(chooses.sum()))
            lengths = np.array(row["lengths"], np.int64)
            starts = np.cumsum(lengths) - lengths
            sums = lambda x: np.add.reduceat(x[ids], starts)
            base = sums(np.log10(counts + 1.0)) - lengths * np.log10(n_tokens + n_words + 1.0)
            cells = [
                row["chunk"], row["docs"], row["held"], lengths, _packed(places[ids]), _packed(words[chooses]), _packed(symbols[chooses]),
                base, sums((counts > 0).astype(np.int64)), sums(np.log10(np.maximum(counts, 1))),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=[f.split()[0] for f in _CODED.split(", ")])

    floats, longs = pa.list_(pa.float64()), pa.list_(pa.int64())
    kinds = [pa.int64(), longs, pa.list_(pa.bool_()), longs, pa.binary(), pa.binary(), pa.binary(), floats, longs, floats]
    return chunked.select("chunk", "docs", "held", "lengths", "ids").join(dictionary, "chunk").mapInArrow(encode, _CODED)


class Naming:
    """The symbols that a chunk's choosing words stand for: their class where they have chosen one, else their band."""

    def __init__(self, n_base: int, least_symbol: int, classes: int, sent: Broadcast | None = None):
        self.n_base, self._least, self._classes, self._sent = n_base, least_symbol, classes, sent

    def of_class(self, old: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """The symbols of words by their classes; those of the least count are apart."""
        least = (old == self._least) | (old >= self.n_base + self._classes)
        return (self.n_base + chosen + self._classes * least).astype(np.uint16)

    def named(self, row: dict) -> np.ndarray:
        """The symbol of each choosing word of a coded chunk."""
        old = _unpacked(row["named"], np.uint16)
        if self._sent is None:
            return old
        words, classes = self._sent.value
        return self.of_class(old, classes[np.searchsorted(words, _unpacked(row["words"], np.int64))])

    def symbols(self, row: dict) -> np.ndarray:
        """The symbol of each token."""
        names = np.concatenate([np.arange(self.n_base), self.named(row)])
        return names[_unpacked(row["places"], np.uint32)]


def _before(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The symbol before each; a text starts after an end."""
    prev = np.empty_like(symbols)
    prev[1:] = symbols[:-1]
    prev[np.cumsum(lengths) - lengths] = _END
    return prev


def symbol_bigrams(texts: DataFrame, naming: Naming, n_symbols: int) -> DataFrame:
    """``pair`` (before * n_symbols + symbol), ``n`` over the training texts: n_symbols**2 rows at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(n_symbols * n_symbols, np.int64)
        for row in _rows_of(batches):
            symbols, lengths = naming.symbols(row), np.array(row["lengths"])
            pairs = _before(symbols, lengths) * n_symbols + symbols
            seen += np.bincount(pairs[np.repeat(~np.array(row["held"], bool), lengths)], minlength=len(seen))
        at = np.flatnonzero(seen)
        for lo in range(0, len(at), 100_000):
            part = at[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[part])], names=["pair", "n"])

    rows = texts.select("held", "lengths", "places", "words", "named").mapInArrow(count, "pair long, n long")
    return rows.groupBy("pair").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, first: np.ndarray, movable: np.ndarray, classes: int, sweeps: int | None = None) -> np.ndarray:
    """Exchange clustering: the class of each symbol.

    ``bigrams`` counts symbol pairs, ``first`` is where the symbols start, ``movable`` those that may move
    among the classes 0..classes-1.  Each in turn goes to the class with the largest likelihood of the
    class bigrams (ties to the smallest class), until a sweep moves none, or for ``sweeps`` sweeps if given.
    Each move raises the likelihood by more than rounding can, so it ends.
    """
    own, n = first.copy(), int(first.max()) + 1
    table = np.zeros((n, n))
    np.add.at(table, (own[:, None], own[None, :]), bigrams)
    some = np.arange(classes)
    least = 1e-7 + 1e-13 * float(_xlogx(table.sum()))
    for _ in count() if sweeps is None else range(sweeps):
        moved = False
        for w in movable:
            a, twice = own[w], bigrams[w, w]
            after = np.bincount(own, bigrams[w], n)  # classes that follow the word, without the word itself
            before = np.bincount(own, bigrams[:, w], n)
            after[a] -= twice
            before[a] -= twice
            table[a] -= after
            table[:, a] -= before
            table[a, a] -= twice
            rows, cols = table[:classes], table[:, :classes].T
            gain = (_xlogx(rows + after) - _xlogx(rows)).sum(1) + (_xlogx(cols + before) - _xlogx(cols)).sum(1)
            cell = table[some, some]
            to, fro = after[:classes], before[:classes]
            gain += _xlogx(cell + to + fro + twice) + _xlogx(cell) - _xlogx(cell + to) - _xlogx(cell + fro)
            # A word before it counts for its row, and one after it for its column, wherever the word goes.
            for sums, more in ((rows.sum(1) + fro, after.sum() + twice), (cols.sum(1) + to, before.sum() + twice)):
                gain -= _xlogx(sums + more) - _xlogx(sums)
            b = int(np.argmax(gain)) if gain.max() > gain[a] + least else a
            table[b] += after
            table[:, b] += before
            table[b, b] += twice
            own[w], moved = b, moved or b != a
        if not moved:
            break
    return own


def _binaries(lists: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    """Binary columns from (values, cuts between the rows)."""
    out = []
    for values, cuts in lists:
        offsets = ((cuts - cuts[0]) * values.itemsize).astype(np.int32)
        out.append(pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values[cuts[0] : cuts[-1]].tobytes())]))
    return out


def _flat(cells: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's values in a row, and how many of them each of its rows has."""
    cells = cells.combine_chunks()
    cells = cells if isinstance(cells, pa.Array) else pa.concat_arrays(cells.chunks)
    offsets = np.frombuffer(cells.buffers()[1], np.int32)[cells.offset : cells.offset + len(cells) + 1]
    raw = np.frombuffer(cells.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return raw.view(kind), np.diff(offsets) // np.dtype(kind).itemsize


def neighbours(texts: DataFrame, naming: Naming, classes_of: np.ndarray, hot: bool) -> DataFrame:
    """One row per chunk and word that chooses: its class so far, and how often each class stands beside it.

    Over the training texts; of the hot words (odd numbers) or the others.  Codes: the class that follows, the class
    before plus the number of classes, and twice that number for the word after itself.
    """
    n = int(classes_of.max()) + 1
    width, n_base = 2 * n + 1, naming.n_base

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            words, lengths = _unpacked(row["words"], np.int64), np.array(row["lengths"], np.int64)
            wanted = (words & 1).astype(bool) == hot
            if not wanted.any():
                continue
            places, own = _unpacked(row["places"], np.uint32).astype(np.int64), classes_of[naming.named(row)]
            of_place = np.concatenate([classes_of[:n_base], own])
            at = np.flatnonzero((places >= n_base) & np.repeat(~np.array(row["held"], bool), lengths))
            at = at[wanted[places[at] - n_base]]
            before = _before(places, lengths)[at]
            w, after = places[at], places[at + 1]  # a text's last token is its end
            to = np.where(after == w, 2 * n, of_place[after])
            fro = np.flatnonzero(before != w)
            keys = np.concatenate([(w - n_base) * width + to, (w[fro] - n_base) * width + n + of_place[before[fro]]])
            keys, counts = np.unique(keys, return_counts=True)
            codes, found = (keys % width).astype(np.uint16), keys // width
            firsts = np.flatnonzero(np.diff(found, prepend=-1))
            ends = np.append(firsts, len(keys))
            for lo in range(0, len(firsts), 50_000):
                cut = ends[lo : lo + 50_001]
                mine = found[cut[:-1]]
                cells = [pa.array(words[mine]), pa.array(own[mine].astype(np.int32)), *_binaries([(codes, cut), (counts.astype(np.int64), cut)])]
                yield pa.RecordBatch.from_arrays(cells, names=_SUM_NAMES)

    return texts.select("held", "lengths", "places", "words", "named").mapInArrow(count, _SUMS)


def _whole_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by word as tables that hold all rows of their words."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        word = batch.column(0).to_numpy()
        cut = int(np.searchsorted(word, word[-1]))  # the last word may go on
        if cut or last != word[0]:
            done = [*held, batch.slice(0, cut)]
            if sum(b.num_rows for b in done):
                yield pa.Table.from_batches(done)
            held, batch = [], batch.slice(cut)
        held.append(batch)
        last = word[-1]
    if held:
        yield pa.Table.from_batches(held)


def _dense(table: pa.Table, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words, their classes so far, their counts by code) of rows that are sorted by word, 256 words at a time."""
    word = table["word"].to_numpy()
    first = np.flatnonzero(np.diff(word, prepend=word[0] - 1))
    (codes, sizes), (counts, _) = _flat(table["codes"], np.uint16), _flat(table["counts"], np.int64)
    which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(word))))
    of = np.repeat(which, sizes)
    own = table["own"].to_numpy()[first]
    cuts = np.searchsorted(of, np.arange(0, len(first) + 256, 256))
    for i, lo in enumerate(range(0, len(first), 256)):
        hi, part = min(lo + 256, len(first)), slice(cuts[i], cuts[i + 1])
        beside = np.bincount((of[part] - lo) * width + codes[part], counts[part], (hi - lo) * width)
        yield word[first[lo:hi]], own[lo:hi], beside.reshape(hi - lo, width)


def in_parts(rows: DataFrame, width: int) -> DataFrame:
    """The rows of :func:`neighbours` summed by word in ``HOT_PARTS`` parts: so many rows a word are left at most."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_words(batches):
            for words, own, beside in _dense(table, width):
                at, codes = np.nonzero(beside)
                cut = np.searchsorted(at, np.arange(len(words) + 1))
                lists = _binaries([(codes.astype(np.uint16), cut), (beside[at, codes].astype(np.int64), cut)])
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(own), *lists], names=_SUM_NAMES)

    part = F.pmod(F.spark_partition_id(), F.lit(HOT_PARTS))
    dealt = rows.withColumn("part", part).repartition("word", "part").sortWithinPartitions("word").drop("part")
    return dealt.mapInArrow(add, _SUMS)


def best_classes(beside: np.ndarray, own: np.ndarray, table: np.ndarray, classes: int) -> np.ndarray:
    """For each word alone, the class out of 0..classes-1 with the largest likelihood of the class bigrams.

    ``beside`` has a row of counts by code for each word (see :func:`neighbours`), ``own`` the words' classes in
    the ``table`` of class bigrams.  A word stays where no other class is better; ties go to the smallest class.
    """
    n, k = len(table), classes
    words = np.arange(len(own))
    after, before, twice = beside[:, :n], beside[:, n : 2 * n], beside[:, 2 * n]
    inside = own < k
    movers, at = words[inside], own[inside]  # words whose own class is one of those to choose from
    gain = np.zeros((len(own), k))

    def sides(to: np.ndarray, fro: np.ndarray, square: np.ndarray) -> None:
        # Cells square[b, c] without the word, where c follows the word `to[c]` times.
        logs = _xlogx(square[:k])
        w, c = np.nonzero(to)
        more = to[w, c]
        cells = square[:k, c].T
        plain = _xlogx(cells + more[:, None]) - logs[:, c].T
        same = np.flatnonzero(c == own[w])
        fixed = cells[same] - fro[w[same], :k]
        mine = inside[w[same]]
        fixed[mine, c[same][mine]] -= more[same][mine] + twice[w[same]][mine]
        plain[same] = _xlogx(fixed + more[same, None]) - _xlogx(fixed)
        other = np.flatnonzero((c != own[w]) & inside[w])
        cell = cells[other, own[w[other]]]
        plain[other, own[w[other]]] = _xlogx(cell) - _xlogx(cell - more[other])
        some = np.flatnonzero(np.diff(w, prepend=-1))
        if len(w):
            gain[w[some]] += np.add.reduceat(plain, some)
        total = np.repeat(square[:k].sum(1)[None], len(own), 0)  # a word before it counts for its row wherever the word goes
        total[movers, at] -= to.sum(1)[inside] + twice[inside]
        gain[:] -= _xlogx(total + (to.sum(1) + twice)[:, None]) - _xlogx(total)

    sides(after, before, table)
    sides(before, after, table.T)
    to, fro = after[:, :k], before[:, :k]
    cell = np.repeat(np.diagonal(table)[None, :k], len(own), 0)
    cell[movers, at] -= to[movers, at] + fro[movers, at] + twice[inside]
    gain += _xlogx(cell + to + fro + twice[:, None]) + _xlogx(cell) - _xlogx(cell + to) - _xlogx(cell + fro)
    best = gain.argmax(1)
    best[movers] = np.where(gain[movers, best[movers]] > gain[movers, at] + 1e-7, best[movers], at)
    return best


def chosen(rows: DataFrame, table: np.ndarray, classes: int) -> DataFrame:
    """``word``, ``class``: the class that each word chooses, from the rows of :func:`neighbours`."""
    width = 2 * len(table) + 1

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _whole_words(batches):
            for words, own, beside in _dense(held, width):
                best = best_classes(beside, own, table, classes).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(best)], names=["word", "class"])

    return rows.repartition("word").sortWithinPartitions("word").mapInArrow(choose, "word long, class int")


def renamed(texts: DataFrame, choice: DataFrame, naming: Naming, n_tasks: int) -> DataFrame:
    """The coded chunks with the chosen classes as their words' symbols, joined by word and then by chunk."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            words = _unpacked(row["words"], np.int64)
            for lo in range(0, len(words), 50_000):
                part = words[lo : lo + 50_000]
                cells = [np.full(len(part), row["chunk"], np.int64), np.arange(lo, lo + len(part), dtype=np.int32), part]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["chunk", "place", "word"])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = zip(batch.column("named").to_pylist(), batch.column("classes").to_pylist())
            named = [_packed(naming.of_class(_unpacked(old, np.uint16), _unpacked(new, np.uint16))) if new is not None else old for old, new in cells]
            at = batch.schema.get_field_index("named")
            yield batch.set_column(at, "named", pa.array(named, pa.binary())).drop_columns("classes")

    columns = [f.split()[0] for f in _CODED.split(", ")]
    met = texts.select("chunk", "words").mapInArrow(places, "chunk long, place int, word long").join(choice, "word")
    found = dictionaries(met.select("chunk", "place", F.col("class").alias("classes")), n_tasks, classes=np.uint16)
    return texts.join(found, "chunk", "left").select(*columns, "classes").mapInArrow(name, _CODED)


def symbol_classes(bigrams: np.ndarray, totals: np.ndarray, clustered: int, classes: int) -> np.ndarray:
    """The class of each symbol: those of the frequent words are exchanged, then come unknown, end and the bands.

    After the bands a symbol may follow for each class, then another one for each class.
    """
    words = np.arange(_WORDS, _WORDS + clustered)
    bands = np.arange(_WORDS + clustered, _WORDS + clustered + 2 * _BANDS)
    unknown, end = classes, classes + 1
    first = np.empty(len(bigrams), np.int64)
    first[[_UNKNOWN, _END]] = unknown, end
    first[words] = (words - _WORDS) % classes
    first[bands] = end + 1 + (bands - bands[0]) // 2
    first[bands[-1] + 1 :] = np.arange(len(first) - bands[-1] - 1) % classes
    return exchange(bigrams, first, words[: int((totals[words] > 0).sum())], classes)


class Model:
    """``classes`` of the symbols, ``transition`` log10 probabilities, ``emission``: log10 of each symbol's class total."""

    def __init__(self, bigrams: np.ndarray, totals: np.ndarray, clustered: int, classes: int, own: np.ndarray | None = None):
        bands = np.arange(_WORDS + clustered, _WORDS + clustered + 2 * _BANDS)
        unknown, end = classes, classes + 1
        self.classes = symbol_classes(bigrams, totals, clustered, classes) if own is None else own
        self.n = end + 1 + _BANDS
        # Left out of the corpus, the first count of a band falls to the band below, and a single one to unknown.
        left_out = self.classes.copy()
        for symbol in bands[::2].tolist():
            left_out[symbol] = unknown if symbol == bands[0] else self.classes[symbol] - 1
        left_out[bands[-1] + 1 + classes :] = end + 1 + (LEAST_COUNT - 1).bit_length() - 1
        moves = np.zeros((self.n, self.n))
        np.add.at(moves, (left_out[:, None], left_out[None, :]), bigrams)
        share = (moves.sum(0) + 1) / (moves.sum() + self.n)
        self.transition = np.log10((moves + SMOOTHING * share) / (moves.sum(1, keepdims=True) + SMOOTHING))
        sums = np.bincount(self.classes, totals, self.n)
        self.emission = np.log10(np.maximum(sums, 1))[self.classes]
        self.emission[_UNKNOWN] = 0.0

    def scores(self, symbols: np.ndarray, lengths: np.ndarray, emit: np.ndarray) -> np.ndarray:
        """log10 probabilities of texts; ``emit`` are their sums of log10 counts of known tokens."""
        own = self.classes[symbols]
        steps = self.transition[self.classes[_before(symbols, lengths)], own] - self.emission[symbols]
        return np.add.reduceat(steps, np.cumsum(lengths) - lengths) + emit


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    clustered: int = CLUSTERED, classes: int = CLASSES, chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """One row per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Words are lower-cased (A-Z) and stand between ASCII blanks; every text has one end, a token like
    others.  Learns from the rows that are not held out (crc32 of the id as text mod 7 is not 2; a null id
    counts as the empty text).  ``base_score`` is the add-one unigram's log10 probability, ``score`` the
    class model's.  A null text is empty: its end alone.  Equal texts get equal scores; without training
    text every word is unknown; an empty table gives an empty table; other columns are not looked at.
    Ids come back as 64-bit integers.
    """
    with Scratch() as tables:
        spark = docs.sparkSession
        chunked = written(chunks(docs, id_col, text_col, chunk_tokens), "lm-chunks")
        pairs = F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry")
        vocabulary = chunked.select("chunk", pairs).select("chunk", "place", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"))
        totals = written(vocabulary.where("n > 0").groupBy("word").agg(F.sum("n").alias("count")), "lm-totals")
        sums = totals.agg(F.sum("count"), F.count(F.lit(1))).first()
        n_tokens, n_words = sums[0] or 0, sums[1]

        # The frequent words, `clustered` at most, become a small table of their own.
        common = totals.where((F.col("count") >= LEAST_COUNT) & (F.octet_length("word") > 0)).orderBy(F.desc("count"), "word").limit(clustered)
        common = [(r["word"], _WORDS + i) for i, r in enumerate(common.select("word").collect())]
        common = F.broadcast(spark.createDataFrame(common, "word binary, symbol int"))
        band = F.length(F.bin("count")) - 1
        power = F.col("count").bitwiseAND(F.col("count") - 1) == 0
        other = F.lit(_WORDS + clustered) + 2 * band + F.when(power, 0).otherwise(1)
        symbol = F.when(F.octet_length("word") == 0, _END).when(F.col("symbol").isNotNull(), F.col("symbol")).otherwise(other)
        chooses = F.col("symbol").isNull() & (F.octet_length("word") > 0) & (F.col("count") >= LEAST_COUNT)
        # Numbers of hot words are odd.
        is_hot = F.when(F.col("count") >= HOT_COUNT, 1).otherwise(0)
        number = F.when(chooses, 2 * F.monotonically_increasing_id() + is_hot).otherwise(F.lit(-1).cast("long"))
        named = totals.join(common, "word", "left").select("word", "count", symbol.cast("int").alias("symbol"), number.alias("number"))
        named = written(named, "lm-symbols")

        # An end is an end also where no training text has one.
        unseen = F.when(F.octet_length("word") == 0, _END).otherwise(_UNKNOWN)
        met = vocabulary.drop("n").join(named, "word", "left").select(
            "chunk", "place", F.coalesce("count", F.lit(0)).alias("counts"), F.coalesce("symbol", unseen).alias("symbols"),
            F.coalesce("number", F.lit(-1).cast("long")).alias("words"),
        )
        # Symbols: unknown, end, frequent words and bands; then the classes of other words, and those of words of the least count.
        n_base = _WORDS + clustered + 2 * _BANDS
        n_symbols, least_symbol = n_base + 2 * classes, _WORDS + clustered + 2 * (LEAST_COUNT.bit_length() - 1)
        n_tasks = (chunked.agg(F.max(F.shiftright("chunk", 33))).first()[0] or 0) + 1
        any_hot = not named.where(F.col("number") % 2 == 1).isEmpty()
        dictionary = dictionaries(met, n_tasks, counts=np.int64, symbols=np.uint16, words=np.int64)
        texts = written(coded(chunked, dictionary, n_tokens, n_words, n_base), "lm-coded")
        for table in (chunked, totals, named):
            tables.drop(table)

        naming = Naming(n_base, least_symbol, classes)

        def bigrams() -> np.ndarray:
            out = np.zeros(n_symbols * n_symbols)
            counted = symbol_bigrams(texts, naming, n_symbols).toArrow()
            out[counted["pair"].to_numpy()] = counted["n"].to_numpy()
            return out.reshape(n_symbols, n_symbols)

        pairs = bigrams()
        own = symbol_classes(pairs, pairs.sum(0), clustered, classes)
        n = classes + 2 + _BANDS
        for _ in range(WORD_SWEEPS):
            table = np.zeros((n, n))
            np.add.at(table, (own[:, None], own[None, :]), pairs)
            sums = neighbours(texts, naming, own, hot=False)
            if any_hot:
                sums = sums.union(in_parts(neighbours(texts, naming, own, hot=True), 2 * n + 1))
            choice = written(chosen(sums, table, classes), "lm-choice")
            if choice.count() <= SENT_WORDS:
                answers = choice.toArrow()
                if len(answers):
                    words, chosen_ = answers["word"].to_numpy(), answers["class"].to_numpy().astype(np.uint16)
                    order = np.argsort(words)
                    sent = words[order], chosen_[order]
                    naming = Naming(n_base, least_symbol, classes, spark.sparkContext.broadcast(sent))
            else:
                naming = Naming(n_base, least_symbol, classes)
                before, texts = texts, written(renamed(texts, choice, naming, n_tasks), "lm-coded")
                tables.drop(before)
            pairs = bigrams()
        tables.keep(texts)
        model = Model(pairs, pairs.sum(0), clustered, classes, own)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row in _rows_of(batches):
                symbols, lengths = naming.symbols(row), np.array(row["lengths"])
                scores = model.scores(symbols, lengths, np.array(row["emit"]))
                cells = [row["docs"], row["held"], row["lengths"], row["known"], [n_tokens] * len(scores), row["base"], scores]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=names)

        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        names = ["doc", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        schema = "doc long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        return texts.mapInArrow(score, schema).withColumnRenamed("doc", id_col)
