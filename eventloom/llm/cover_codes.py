"""Vector codes by a product quantiser whose Lloyd rounds run over cover trees.

Vectors of integers are cut into equal parts; each part position has a codebook of its own.

1. Each task takes its vectors block by block and builds one cover tree for each part position of a block: a
   node's vectors lie within its radius of its centre, its children's centres within half of that, and no two of them
   closer than half of it.  Vectors are kept in tree order, so that a subtree is a run of them and its sum the
   difference of two cumulative sums.  The trees are written once; every round reads them.
2. In a round a node compares its centre with all entries.  Where the nearest is nearer than any other by more
   than twice the radius, no vector below can have another one: the whole subtree's count and sum go to it.
   Other nodes descend to their children, and leaves to exact comparisons of their vectors.
3. Tasks give one sum for each part, entry and component; Spark adds them up, and the new codebooks (a table
   whose size is fixed by the number of parts, entries and components) go out with the next round.

All numbers are integers within 53 bits, so distances are exact, ties included; only the comparison with a radius
is rounded, with a margin on the side of descending.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK = 2048  # vectors whose trees are built together
_LEAF = 16
_MARGIN = 1e-6
_EXACT = float(1 << 53)
_FIELDS = ["ids", "labels", "points", "orders", "starts", "ends", "centres", "radii", "kids", "n_kids"]


def cover_tree(points: np.ndarray, leaf: int = _LEAF) -> tuple[np.ndarray, ...]:
    """The cover tree of the rows of ``points``: their order, and by node start, end, centre, radius, first child, number of children.

    Node 0 is the root, the children of a node stand in a row, a leaf has none.  ``centre`` is a row of ``points``.
    """
    order = np.arange(len(points))
    starts, ends, centres, radii, kids, n_kids = [0], [len(points)], [0], [0.0], [0], [0]
    node = 0
    while node < len(starts):
        lo, hi = starts[node], ends[node]
        own = order[lo:hi]
        inside = points[own]
        off = inside - points[centres[node]]
        apart = np.einsum("ij,ij->i", off, off)
        reach = float(apart.max())
        radii[node] = np.sqrt(reach)
        if hi - lo > leaf and reach > 0:
            # The own centre comes first, then the first vector that no child so far covers.
            kids[node] = len(starts)
            rest, done = np.arange(hi - lo), lo
            near, at = apart, int(np.flatnonzero(own == centres[node])[0])
            order_now = own.copy()
            while True:
                covered = near <= reach / 4
                group = rest[covered]
                starts.append(done)
                ends.append(done + len(group))
                centres.append(int(order_now[at]))
                radii.append(0.0)
                kids.append(0)
                n_kids.append(0)
                order[done : done + len(group)] = order_now[group]
                done += len(group)
                rest = rest[~covered]
                if not len(rest):
                    break
                at = int(rest[0])
                off = inside[rest] - inside[at]
                near = np.einsum("ij,ij->i", off, off)
            n_kids[node] = len(starts) - kids[node]
        node += 1
    return tuple(np.array(x) for x in (order, starts, ends, centres, radii, kids, n_kids))


def _squared(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances, points by entries; exact for integers within 53 bits."""
    return (points * points).sum(1)[:, None] - 2 * (points @ book.T) + (book * book).sum(1)


def assigned(points: np.ndarray, tree: tuple[np.ndarray, ...], book: np.ndarray) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """Runs (start, end, entry) of the tree order that go to an entry as whole subtrees, and the other places with their entries."""
    order, starts, ends, centres, radii, kids, n_kids = tree
    runs, places, entries = [], [], []
    nodes = np.zeros(1, np.int64)
    while len(nodes):
        squared = _squared(points[centres[nodes]], book)
        nearest = squared.argmin(1)
        settled = radii[nodes] == 0  # copies of one vector
        if len(book) > 1:
            two = np.sqrt(np.partition(squared, 1, 1)[:, :2])
            settled |= two[:, 1] - two[:, 0] > 2 * radii[nodes] * (1 + _MARGIN) + _MARGIN
        else:
            settled[:] = True
        done = nodes[settled]
        runs += zip(starts[done].tolist(), ends[done].tolist(), nearest[settled].tolist())
        rest = nodes[~settled]
        leaves = rest[n_kids[rest] == 0]
        if len(leaves):
            at = np.concatenate([np.arange(a, b) for a, b in zip(starts[leaves].tolist(), ends[leaves].tolist())])
            places.append(at)
            entries.append(_squared(points[order[at]], book).argmin(1))
        inner = rest[n_kids[rest] > 0]
        n = n_kids[inner]
        nodes = np.repeat(kids[inner] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    none = [np.zeros(0, np.int64)]
    return runs, np.concatenate(places or none), np.concatenate(entries or none)


def _raw(x: np.ndarray, kind: type) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def trees(rows: DataFrame, width: int, parts: int, block: int) -> DataFrame:
    """One row per block of ``rows`` (doc, label, vector): its vectors and their cover trees.

    A shorter vector is filled up with zeros to ``width``, a multiple of ``parts``.
    """
    part = width // parts

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(cells: pa.Table) -> pa.RecordBatch:
            vectors = cells["vector"].combine_chunks()
            n = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            points = np.zeros((len(n), width))
            points[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
            if 4 * width * float(np.abs(points).max(initial=0)) ** 2 >= _EXACT:
                raise ValueError("components so large that squared distances are not exact")
            built = [cover_tree(points[:, p * part : (p + 1) * part]) for p in range(parts)]
            kinds = [np.int32, np.int32, np.int32, np.int32, np.float64, np.int32, np.int32]
            packed = [[_raw(tree[i], kind) for tree in built] for i, kind in enumerate(kinds)]
            values = [cells["doc"].to_pylist(), cells["label"].to_pylist(), _raw(points, np.int32), *packed]
            arrays = [pa.array([v], f.type) for v, f in zip(values, kinds_of)]
            return pa.RecordBatch.from_arrays(arrays, names=_FIELDS)

        held, n_held = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                cut = batch.slice(lo, block)
                held.append(cut)
                n_held += cut.num_rows
                if n_held >= block:
                    yield row(pa.Table.from_batches(held))
                    held, n_held = [], 0
        if held:
            yield row(pa.Table.from_batches(held))

    blobs = pa.list_(pa.binary())
    kinds_of = [pa.field(f, k) for f, k in zip(_FIELDS, [pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), *[blobs] * 7])]
    schema = "ids array<long>, labels array<string>, points binary, " + ", ".join(f"{f} array<binary>" for f in _FIELDS[3:])
    return rows.select("doc", "label", "vector").mapInArrow(build, schema)


def _blocks(batches: Iterator[pa.RecordBatch], width: int, parts: int) -> Iterator[tuple[dict, np.ndarray, list[tuple]]]:
    kinds = [np.int32, np.int32, np.int32, np.int32, np.float64, np.int32, np.int32]
    for batch in batches:
        for i in range(batch.num_rows):
            row = {f: batch.column(j)[i].as_py() for j, f in enumerate(batch.schema.names)}
            points = np.frombuffer(row["points"], np.int32).reshape(-1, width).astype(np.float64)
            yield row, points, [tuple(np.frombuffer(row[f][p], k) for f, k in zip(_FIELDS[3:], kinds)) for p in range(parts)]


def entry_sums(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``cell``, ``n``: sums of components and counts over the vectors of each part and entry.

    A cell is (part * entries + entry) * (components + 1) + component; the last one of an entry is its count.
    """
    parts, entries, part = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, part + 1), np.int64)
        for _, points, built in _blocks(batches, parts * part, parts):
            for p, tree in enumerate(built):
                own = points[:, p * part : (p + 1) * part]
                runs, places, which = assigned(own, tree, books[p])
                in_order = own[tree[0]].astype(np.int64)
                upto = np.zeros((len(own) + 1, part + 1), np.int64)  # cumulative sums in tree order, and counts
                np.cumsum(in_order, 0, out=upto[1:, :part])
                upto[:, part] = np.arange(len(own) + 1)
                if runs:
                    lo, hi, entry = np.array(runs).T
                    np.add.at(total[p], entry, upto[hi] - upto[lo])
                np.add.at(total[p], which, upto[places + 1] - upto[places])
        flat = total.reshape(-1)
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(flat[at])], names=["cell", "n"])

    return blocks.mapInArrow(add, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def codes_of(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``doc``, ``label``, ``code`` (two hex digits a part), ``error`` of every vector."""
    parts, entries, part = books.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, points, built in _blocks(batches, parts * part, parts):
            codes, error = np.empty((len(points), parts), np.uint8), np.zeros(len(points))
            for p, tree in enumerate(built):
                own = points[:, p * part : (p + 1) * part]
                runs, places, which = assigned(own, tree, books[p])
                entry = np.empty(len(own), np.int64)
                for lo, hi, e in runs:
                    entry[lo:hi] = e
                entry[places] = which
                codes[tree[0], p] = entry
                off = own - books[p][codes[:, p]]
                error += (off * off).sum(1)
            cells = [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cells, names=["doc", "label", "code", "error"])

    return blocks.mapInArrow(code, "doc long, label string, code string, error long")


def learn_codebooks(kept: DataFrame, parts: int, entries: int, rounds: int, block: int) -> tuple[DataFrame, np.ndarray]:
    """The blocks of trees of ``kept`` (doc, label, vector), written, and the codebooks: parts by entries by components."""
    longest = kept.agg(F.max(F.size("vector"))).first()[0] or 0
    part = max(1, -(-longest // parts))
    first = kept.orderBy(F.asc_nulls_last("doc"), "vector").limit(entries).select("vector").collect()
    head = np.zeros((max(1, len(first)), parts * part))
    for i, r in enumerate(first):
        head[i, : len(r[0])] = np.floor(SCALE * np.array(r[0]))
    books = head.reshape(len(head), parts, part).transpose(1, 0, 2).copy()
    blocks = written(trees(kept, parts * part, parts, block), "cover-trees")
    for _ in range(rounds):
        sums = np.zeros(parts * len(head) * (part + 1), object)
        for cell, n in entry_sums(blocks, books).collect():  # a row for each part, entry and component
            sums[cell] = n
        sums = sums.reshape(parts, len(head), part + 1)
        used = sums[:, :, part] > 0
        books[used] = (sums[used][:, :part] // sums[used][:, part:]).astype(np.float64)
    return blocks, books


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK,
) -> DataFrame:
    """One row per vector: id, ``code``, ``error``, ``label_error``, ``codebooks_sha256``.

    Rows whose vector is null or holds a null or a component that is not finite are left out.  Components become
    floor(4096 * x).  Codebooks start as the parts of the ``entries`` (256 at most) vectors of the smallest ids (a null
    id comes last; of equal ids, the smaller vector first); with fewer vectors they are shorter.  Vectors shorter than
    the longest, and lengths that the parts do not divide, are filled up with zeros; components so large that squared
    distances leave 53 bits are an error.  Repeated rows are rows of their own; equal vectors get equal codes.
    ``label_error`` is the error over all rows of the same label, null being one.  ``codebooks_sha256`` is that of all
    components by part, entry and place, as decimal numbers between commas.  An empty table gives an empty table; other
    columns are not looked at.  Ids come back as 64-bit integers.
    """
    vector = column(vector_col)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    names = column(id_col).cast("long").alias("doc"), column(label_col).cast("string").alias("label")
    kept = vectors.where(vector.isNotNull() & ~bad).select(*names, vector.cast("array<double>").alias("vector"))
    blocks, books = learn_codebooks(kept, parts, entries, rounds, block)
    coded = written(codes_of(blocks, books), "cover-codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    rows = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    digest = hashlib.sha256(",".join(str(int(x)) for x in books.reshape(-1)).encode()).hexdigest()
    return rows.select(F.col("doc").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
