"""Near-duplicate detection: MinHash, banding, signature verification, connected components.

1. A document's set is its distinct word shingles, as 64-bit hashes.  Documents with the same set are one
   node, the smallest id standing for them (a sum and a skew-splittable join; copies are never paired).
2. Many universal hash minima (a*x + b mod 2**64, upper half) make the signature; bands of it are keys.
   Nodes that share a band meet in a bucket.
3. Buckets are cut into blocks of bounded size, so that no bucket has to fit one task.  Inside a block, and
   then between the blocks of a bucket whose nodes are not yet one component, every pair that is not yet
   connected is compared.  Sizes and signatures come first and leave the nodes that have a possible
   partner; only those fetch their full sets, which decide.  A pair that shares several bands is compared
   in the first only.  What leaves a block are nodes, and links that join parts of it (fewer than nodes),
   never the pairs.
4. Links become components by alternating large-star and small-star steps until nothing changes.

Only components are computed, so a link between nodes that are connected already is not looked for;
every other pair that shares a band is decided on its full sets, unless sizes or signatures rule it out.
Sizes never do so wrongly; signatures only where a pair's agree 6.5 standard deviations less than is
usual at the threshold, whatever that is.  With 25 bands of 5, a pair at the threshold of 0.85 shares no
band with a probability of 4e-7, and less above it; a caller with a lower threshold gives bands to match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, column, release_memory, small_batches, written

WORDS = 5
SIMILARITY = 85  # hundredths
BANDS, ROWS = 25, 5
SEED = 11
DEVIATIONS = 6.5  # below the least similarity that counts, where signatures rule a pair out
BLOCK_BYTES = 8 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed values of a well-known 64-bit mixer


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes.  Words: lower-cased A-Z, between ASCII blanks."""

    def __init__(self, words: int = WORDS):
        import xxhash

        self.words, self._hash, self._known = words, xxhash.xxh3_64_intdigest, {}

    def _codes(self, tokens: list[bytes]) -> np.ndarray:
        known = self._known
        if len(known) > 400_000:
            known.clear()
        for t in set(tokens).difference(known):
            known[t] = self._hash(t)
        return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))

    def shingles(self, text: str | None) -> np.ndarray:
        """The whole text's set, ascending; with fewer words the sequence of all is the one shingle."""
        codes = self._codes((text or "").encode().lower().split())
        n = min(self.words, len(codes))
        if not n:
            return codes
        out = np.full(len(codes) - n + 1, n, np.uint64)
        for i in range(n):
            out = _mixed(out + codes[i : len(codes) - n + 1 + i])
        return np.unique(out)


def hash_family(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The minima of all hash functions over the whole set, a bounded piece of it at a time."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 512):
        np.minimum(least, (shingles[lo : lo + 512, None] * a + b).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def document_sets(docs: DataFrame, id_col: str, text_col: str, words: int, hashes: int, seed: int) -> DataFrame:
    """``doc``, ``n_shingles``, ``d1``/``d2`` (128-bit digest of the set), ``sig`` (minima; null for empty sets)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        import xxhash

        shingler, (a, b) = Shingler(words), hash_family(hashes, seed)
        for batch in batches:
            n, digests, sigs = [], [], []
            for text in batch.column(1):
                s = shingler.shingles(text.as_py())
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                sigs.append(signature(s, a, b).tobytes() if len(s) else None)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(sigs, pa.binary())],
                names=["doc", "n_shingles", "d1", "d2", "sig"],
            )
        shingler = n = digests = sigs = None
        release_memory()

    rows = docs.select(column(id_col).cast("long").alias("doc"), column(text_col).alias("text"))
    return rows.mapInArrow(sets, "doc long, n_shingles long, d1 long, d2 long, sig binary")


def _full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, words: int, hashes: int, seed: int) -> DataFrame:
    """``node``, ``sig``, ``set`` for the nodes that share a bucket with another."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, (a, b) = Shingler(words), hash_family(hashes, seed)
        for batch in batches:
            found = [shingler.shingles(t.as_py()) for t in batch.column(1)]
            sigs = [signature(s, a, b).tobytes() for s in found]
            cells = [batch.column(0), pa.array(sigs, pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(cells, names=["node", "sig", "set"])
        shingler = found = sigs = cells = None
        release_memory()

    rows = docs.select(column(id_col).cast("long").alias("node"), column(text_col).alias("text"))
    found = rows.join(wanted, "node", "left_semi").mapInArrow(sets, "node long, sig binary, set binary")
    return found.where(F.octet_length("set") > 0).distinct()  # equal rows are one


def band_keys(nodes: DataFrame, bands: int, rows: int) -> DataFrame:
    """``node``, ``n_shingles``, ``b1``/``b2``: one row per node and band, the band's number and minima hashed to 128 bits."""
    piece = lambda i: F.substring(F.col("sig"), i * 4 * rows + 1, 4 * rows)
    keys = [F.struct(F.xxhash64(F.lit(i), piece(i)).alias("b1"), F.xxhash64(piece(i), F.lit(-1 - i)).alias("b2"), F.lit(i).alias("band")) for i in range(bands)]
    return nodes.select("node", "n_shingles", F.explode(F.array(*keys)).alias("k")).select("node", "n_shingles", "k.*")


def least_agreement(similarity: int, minima: int) -> float:
    """Pairs whose signatures agree in a smaller share of the minima than this are not compared further."""
    s = similarity / 100
    return max(0.0, s - DEVIATIONS * (s * (1 - s) / minima) ** 0.5)


class _Parts:
    """Union-find over the nodes of one unit."""

    def __init__(self, labels: np.ndarray):
        _, self.part = np.unique(labels, return_inverse=True)

    def join(self, i: int, j: int) -> None:
        a, b = self.part[i], self.part[j]
        self.part[self.part == b] = a


class Unit:
    """The nodes of one block of a bucket, or of two blocks: which pairs are left to compare.

    ``sigs`` is (nodes, minima).  With two blocks, pairs of one block are left out.  A pair that shares an
    earlier band is compared there.
    """

    def __init__(self, sizes, labels, sides, sigs, band: int, rows: int, similarity: int):
        self.sizes, self.sides, self.sigs, self.band, self.rows, self.similarity = sizes, sides, sigs, band, rows, similarity
        self.parts, self.two = _Parts(labels), len(np.unique(sides)) > 1
        self.enough = least_agreement(similarity, sigs.shape[1]) * sigs.shape[1]

    def partners(self, i: int) -> np.ndarray:
        """Later nodes, not connected with node ``i`` so far, whose sizes and signatures allow a link."""
        j = np.arange(i + 1, len(self.sizes))
        keep = self.parts.part[j] != self.parts.part[i]
        if self.two:
            keep &= self.sides[j] != self.sides[i]
        # An intersection is at most the smaller set, a union at least the larger.
        keep &= 100 * np.minimum(self.sizes[j], self.sizes[i]) >= self.similarity * np.maximum(self.sizes[j], self.sizes[i])
        j = j[keep]
        agree = self.sigs[j] == self.sigs[i]
        enough = agree.sum(1) >= self.enough
        if self.band:
            enough &= ~agree[:, : self.band * self.rows].reshape(len(j), self.band, self.rows).all(2).any(1)
        return j[enough]


def unit_candidates(unit: Unit) -> np.ndarray:
    """Which nodes have a partner."""
    has = np.zeros(len(unit.sizes), bool)
    for i in range(len(has) - 1):
        j = unit.partners(i)
        if len(j):
            has[i] = has[j] = True
    return has


def unit_links(unit: Unit, nodes: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that join parts of the unit, every pair that is not connected yet decided on its full sets."""
    found, ends = [], np.cumsum(unit.sizes)
    distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.zeros(len(distinct), bool)
    for i in range(len(nodes) - 1):
        partners = unit.partners(i)
        if not len(partners):
            continue
        member[:] = False
        member[codes[ends[i] - unit.sizes[i] : ends[i]]] = True
        for j in partners.tolist():
            if unit.parts.part[i] == unit.parts.part[j]:
                continue
            both = int(np.count_nonzero(member[codes[ends[j] - unit.sizes[j] : ends[j]]]))
            if 100 * both >= unit.similarity * int(unit.sizes[i] + unit.sizes[j] - both):
                unit.parts.join(i, j)
                found.append((nodes[i], nodes[j]))
    return found


KEY = ["b1", "b2", "lo", "hi", "band"]


def _by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[tuple]]]:
    """(key, rows of columns) of each unit with two nodes or more; rows come sorted by unit and one is held at a time."""
    unit, held = None, []
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for row in zip(*cols):
            if list(row[:5]) != unit:
                if len(held) > 1:
                    yield unit, list(zip(*held))
                unit, held = list(row[:5]), []
            held.append(row[5:])
    if len(held) > 1:
        yield unit, list(zip(*held))


def _signatures(raw: tuple) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.uint32).reshape(len(raw), -1)


def _dealt(rows: DataFrame, *cols: str) -> DataFrame:
    return rows.select(*KEY, "node", "label", "side", *cols).repartition(*KEY[:4]).sortWithinPartitions(*KEY[:4])


def unit_members(cells: DataFrame, nodes: DataFrame, rows: int, similarity: int) -> DataFrame:
    """Signature verification: the cells whose node has, in its unit, a partner that may be linked with it."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, (node, label, side, sig, n) in _by_unit(batches):
            unit = Unit(np.array(n), np.array(label), np.array(side), _signatures(sig), key[4], rows, similarity)
            at = np.flatnonzero(unit_candidates(unit)).tolist()
            if at:
                cells = [*[[k] * len(at) for k in key], *[[c[i] for i in at] for c in (node, label, side)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=[*KEY, "node", "label", "side"])

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    schema = "b1 long, b2 long, lo int, hi int, band int, node long, label long, side int"
    full = cells.join(nodes.select("node", "sig", "n_shingles"), "node")
    return _dealt(full, "sig", "n_shingles").mapInArrow(verify, schema)


def links_of_units(cells: DataFrame, sets: DataFrame, rows: int, similarity: int) -> DataFrame:
    """``u``, ``v``: links that join parts of a unit, confirmed on full sets."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, (node, label, side, sig, raw) in _by_unit(batches):
            found = [np.frombuffer(s, np.uint64) for s in raw]
            sizes = np.array([len(s) for s in found])
            unit = Unit(sizes, np.array(label), np.array(side), _signatures(sig), key[4], rows, similarity)
            out = unit_links(unit, list(node), found)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["u", "v"])

    return _dealt(cells.join(sets, "node"), "sig", "set").mapInArrow(compare, "u long, v long")


def _mark(edges: DataFrame):
    """Two numbers that tell one set of edges from another."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` (the smallest node reachable) for every node with a link, by large-star and small-star steps.

    Every step is sums and joins by node, written to the shared folder; it ends when a round changes nothing.
    """
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "links")
    mark = _mark(edges)
    while True:
        # Large-star: every neighbour above a node is linked to the least node of its neighbourhood.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "star")
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "large-star")
        # Small-star: every node and its lower neighbours are linked to the least of them.
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "star")
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = _mark(edges)
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v").distinct())
        mark = now


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: int = SIMILARITY,
    bands: int = BANDS, rows: int = ROWS, seed: int = SEED,
) -> DataFrame:
    """One row per row: id, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked when 100 * |A and B| >= ``similarity`` * |A or B| for their sets; the component
    is named after its smallest id, whose document stays.  A document without words has an empty set and
    is linked with nothing; one with fewer than ``words`` words has one shingle, the whole sequence.  A row
    without an id takes no part: its component is null and it stays.  Rows with the same id are one
    document with all of their links, and are kept alike.  An empty table gives an empty table; other
    columns are not looked at.  Ids are compared as 64-bit integers.
    """
    with Scratch() as tables, small_batches(docs.sparkSession):
        found = tables.keep(written(document_sets(docs, id_col, text_col, words, bands * rows, seed), "sets"))
        named = found.where(F.col("doc").isNotNull() & (F.col("n_shingles") > 0))
        alike = named.groupBy("d1", "d2").agg(F.min("doc").alias("node"), F.count(F.lit(1)).alias("n"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
        alike = written(alike, "nodes")
        copies = named.join(alike.where(F.col("n") > 1).select("d1", "d2", "node"), ["d1", "d2"]).where(F.col("doc") != F.col("node"))
        copies = copies.select(F.col("doc").alias("u"), F.col("node").alias("v"))

        keys = band_keys(alike, bands, rows)
        size = F.sum(8 * F.col("n_shingles") + 4 * bands * rows)
        shared = keys.groupBy("b1", "b2").agg(F.count(F.lit(1)).alias("n"), size.alias("bytes")).where(F.col("n") > 1)
        shared = written(shared.select("b1", "b2", F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int").alias("n_blocks")), "buckets")
        members = written(keys.join(shared, ["b1", "b2"]).select("b1", "b2", "band", "node", "n_blocks"), "members")
        members = members.withColumn("side", F.pmod(F.xxhash64("node", "b1"), F.col("n_blocks")).cast("int"))

        def links(cells: DataFrame, name: str) -> DataFrame:
            cells = written(unit_members(cells, alike, rows, similarity), f"cells-{name}")
            # A node is the smallest id of its set; should that id have rows with other texts, it has their sets too.
            sets = written(_full_sets(docs, cells.select("node").distinct(), id_col, text_col, words, bands * rows, seed), f"sets-{name}")
            return written(links_of_units(cells, sets, rows, similarity), f"links-{name}")

        cell = ["b1", "b2", "band", "node", "side"]
        inside = members.select(*cell, F.col("side").alias("lo"), F.col("side").alias("hi"), F.col("node").alias("label"))
        found_links = links(inside, "inside")
        labels = written(connected_components(found_links.union(copies)), "labels")

        # Between the blocks of a bucket, as long as its nodes are not one component.
        large = members.where(F.col("n_blocks") > 1).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        if not large.isEmpty():
            large = written(large, "large-members")
            split = large.groupBy("b1", "b2").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("b1", "b2")
            other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
            across = large.join(split, ["b1", "b2"], "left_semi").select("*", other).where("other != side")
            across = across.select(*cell, "label", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
            more = links(across, "across")
            old = labels.where("node != label").select(F.col("node").alias("u"), F.col("label").alias("v"))
            labels = written(connected_components(more.union(old)), "labels")

        moved = tables.keep(labels).where("node != label").withColumnRenamed("node", "doc")
        out = found.select("doc", "n_shingles").join(moved, "doc", "left")
        component = F.coalesce("label", "doc")
        kept = F.col("doc").isNull() | (component == F.col("doc"))
        return out.select(F.col("doc").alias(id_col), "n_shingles", component.alias("component_id"), kept.alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the documents whose component is named after another one (see :func:`near_duplicates`)."""
    gone = near_duplicates(docs, id_col, text_col, **how).where(~F.col("kept")).select(F.col(id_col).alias("gone")).distinct()
    gone = gone.withColumn("is_gone", F.lit(True))
    named = docs.select(F.struct(*[column(c) for c in docs.columns]).alias("row"), column(id_col).cast("long").alias("gone"))
    rest = named.join(gone, "gone", "left").where(F.col("is_gone").isNull())
    return rest.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
