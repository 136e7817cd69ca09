"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors become integer weights, floor(256 * x) for each component.  Candidates are cut into blocks and
each block is turned into postings: for each dimension (term) the rows with a weight there.  Queries are
sparse rows cut into blocks of their own.  Every query block meets every candidate block once: for each
term of the query block, its query weights times the posting's weights are added to the scores of the
posting's rows in a dense array.  Each query's k best of the block are selected by partition and merged
with its k best so far, and the k best of all tasks by a window that keeps k rows of each partition
before it shuffles.

Blocks have a bounded number of rows, so memory is bounded; the number of block meetings is the product
that an exhaustive search of a stated query set implies.  The meetings are a grid of query groups and
candidate groups, one task each: a task first reads its query blocks, of bounded size together, then its
candidate blocks one after the other.  Blocks go from task to task by one shuffle, never by the driver,
and are copied once for each group of the other side, not for each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, column, small_batches, written

SCALE = 256
BLOCK = 4096
TILE = 1 << 17  # scores added up at a time: few enough for a core's cache
HELD = 1 << 22  # query weights that a task holds
RUN = 32  # candidate blocks that meet one copy of the queries, at most
_CELLS = ("n", "ids", "terms", "lengths", "rows", "weights")
_BLOCK = "n int, ids binary, terms binary, lengths binary, rows binary, weights binary"  # rows: the steps from each to the next
_INT64 = np.iinfo(np.int64)
_NONE = _INT64.min  # below every score


def usable(vector: Column) -> Column:
    """Not null, and no component is null or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(finite(x.cast("double")), F.lit(False)))


def _small(numbers: np.ndarray) -> np.ndarray:
    """In the smallest signed integers that hold them."""
    return numbers.astype(np.min_scalar_type(-1 - int(np.abs(numbers).max(initial=0))))


def _read(cell: bytes, n: int) -> np.ndarray:
    return np.frombuffer(cell, f"i{len(cell) // n}") if n else np.zeros(0, np.int8)


def _postings(ids: np.ndarray, lengths: np.ndarray, values: np.ndarray, scale: int) -> pa.RecordBatch:
    row = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
    term = (np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
    weight = np.floor(values.astype(np.float64) * scale)
    if len(weight) and np.abs(weight).max() >= 2.0**62:
        raise ArithmeticError("a weight exceeds 64-bit integers")
    weight = weight.astype(np.int64)
    keep = weight != 0
    order = np.argsort(term[keep], kind="stable")
    row, term, weight = row[keep][order], term[keep][order], weight[keep][order]
    terms, counts = np.unique(term, return_counts=True)
    steps = np.diff(np.repeat(np.arange(len(terms)) * len(ids), counts) + row, prepend=-1)
    cells = [len(ids), ids.astype(np.int64), terms.astype(np.int32), counts.astype(np.int64), _small(steps), _small(weight)]
    cells = [pa.array([cells[0]], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in cells[1:]]]
    return pa.RecordBatch.from_arrays(cells, names=list(_CELLS))


def blocks(vectors: DataFrame, scale: int, size: int) -> DataFrame:
    """Rows (id, vector) packed into blocks of ``size`` rows at most, each with its postings; ids ascend in a block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(x.num_rows for x in waiting) >= size:
                rows = pa.concat_batches(waiting)
                full = rows.num_rows - rows.num_rows % size
                yield from (block(rows.slice(lo, size)) for lo in range(0, full, size))
                waiting = [rows.slice(full)]
        if sum(x.num_rows for x in waiting):
            yield block(pa.concat_batches(waiting))

    def block(part: pa.RecordBatch) -> pa.RecordBatch:
        part = part.take(pc.sort_indices(part.column(0)))
        lists = part.column(1)
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        return _postings(part.column(0).to_numpy(), lengths, lists.flatten().to_numpy(zero_copy_only=False), scale)

    return vectors.mapInArrow(pack, _BLOCK)


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Ids, terms, and for each term the rows with a weight there and the weights."""
    terms, lengths = np.frombuffer(row["terms"], np.int32), np.frombuffer(row["lengths"], np.int64)
    ends = np.cumsum(lengths)[:-1]
    steps, weights = (_read(row[name], int(lengths.sum())) for name in ("rows", "weights"))
    rows = (np.cumsum(steps, dtype=np.int64) - 1 - np.repeat(np.arange(len(terms)) * row["n"], lengths)).astype(np.int32)
    lists = list(zip(np.split(rows, ends), np.split(weights, ends))) if len(terms) else []
    return np.frombuffer(row["ids"], np.int64), terms, lists


def _most(lists: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    return np.array([float(np.abs(weights).max()) for _, weights in lists], np.float64)


def _number_type(reach: float) -> type:
    """The fastest numbers in which sums of products are exact, if their absolute values add up to ``reach`` at most."""
    if reach >= _INT64.max:
        raise ArithmeticError("a score exceeds 64-bit integers")
    return np.float32 if reach < 2.0**24 else np.float64 if reach < 2.0**52 else np.int64


class _Candidates:
    """A candidate block; the weights of a term with many rows are filled up with zeros to one for each row."""

    def __init__(self, row: dict) -> None:
        self.ids, self.terms, self._lists = _arrays(row)
        self.most, self._typed = _most(self._lists), {}

    def postings(self, kind: type) -> list[tuple[np.ndarray | None, np.ndarray]]:
        if kind not in self._typed:
            self._typed[kind] = [_filled(rows, weights, len(self.ids), kind, 4) for rows, weights in self._lists]
        return self._typed[kind]


def _filled(rows: np.ndarray, weights: np.ndarray, n: int, kind: type, share: int) -> tuple[np.ndarray | None, np.ndarray]:
    """The rows and weights of a term, or None and n weights if one row in ``share`` has one."""
    if share * len(rows) < n:
        return rows, weights.astype(kind)
    full = np.zeros(n, kind)
    full[rows] = weights
    return None, full


class _Queries:
    """Rows lo to hi of a query block, and each one's k best so far."""

    def __init__(self, block: int, ids: np.ndarray, terms: np.ndarray, lists: list, lo: int, hi: int, k: int) -> None:
        cuts = [np.searchsorted(rows, (lo, hi)) for rows, _ in lists]
        there = [i for i, (a, b) in enumerate(cuts) if b > a]
        self._lists = [(lists[i][0][slice(*cuts[i])] - lo, lists[i][1][slice(*cuts[i])]) for i in there]
        self.block, self.lo, self.k, self.ids, self.terms = block, lo, k, ids[lo:hi], terms[there]
        self.most, self._typed = _most(self._lists), {}
        self._floor = np.full(len(self.ids), _NONE + 1)  # a query's k-th best score, if it has k
        self._best = tuple(np.zeros(0, np.int64) for _ in range(3))  # row, id and score, best first in a row

    def _weights(self, kind: type) -> list[tuple[np.ndarray | None, np.ndarray]]:
        if kind not in self._typed:
            filled = (_filled(rows, weights, len(self.ids), kind, 2) for rows, weights in self._lists)
            self._typed[kind] = [(rows, weights[:, None]) for rows, weights in filled]
        return self._typed[kind]

    def _scores(self, cands: _Candidates, room: dict) -> np.ndarray:
        """scores[query, candidate], added up term by term."""
        _, at, theirs = np.intersect1d(self.terms, cands.terms, assume_unique=True, return_indices=True)
        kind = _number_type(float((self.most[at] * cands.most[theirs]).sum()))
        shape = (len(self.ids), len(cands.ids))
        if room.get(kind) is None or room[kind].shape[1] < shape[0] * shape[1]:
            room[kind] = np.empty((2, shape[0] * shape[1]), kind)
        scores, part = (x[: shape[0] * shape[1]].reshape(shape) for x in room[kind])
        scores.fill(0)
        weights, postings = self._weights(kind), cands.postings(kind)
        for i, j in zip(at.tolist(), theirs.tolist()):
            (own, q), (rows, c) = weights[i], postings[j]
            if rows is not None:
                own = np.arange(len(self.ids)) if own is None else own
                scores[np.ix_(own, rows)] += q * c
            elif own is not None:
                scores[own] += q * c
            else:
                np.multiply(q, c, out=part)
                np.add(scores, part, out=scores)
        return scores

    def meet(self, cands: _Candidates, room: dict) -> None:
        """Merges the k best of a block, ties to the smaller id (ids ascend), without the query's own rows."""
        scores, n, k = self._scores(cands, room), len(cands.ids), self.k
        lo, hi = np.searchsorted(cands.ids, self.ids, "left"), np.searchsorted(cands.ids, self.ids, "right")
        for q in np.flatnonzero(hi > lo).tolist():
            scores[q, lo[q] : hi[q]] = _NONE if scores.dtype == np.int64 else -np.inf
        floor = self._floor.astype(scores.dtype)
        hits = scores >= floor[:, None]
        if n > k and np.count_nonzero(hits) > 8 * k * len(self.ids):
            floor = np.maximum(floor, np.partition(scores, n - k, axis=1)[:, n - k])
            hits = scores >= floor[:, None]
        at = np.flatnonzero(hits)
        if not len(at):
            return
        row, place = np.divmod(at, n)
        found = scores.reshape(-1)[at]
        # Of those on the floor the k smallest ids are enough.
        level = found == floor[row]
        passed = np.concatenate([[0], np.cumsum(level)])
        nth = passed[1:] - passed[np.searchsorted(row, np.arange(len(self.ids)))][row]
        keep = ~level | (nth <= k)
        more = (row[keep], cands.ids[place[keep]], found[keep].astype(np.int64))
        row, ids, found = (np.concatenate(x) for x in zip(self._best, more))
        order = np.lexsort((ids, -found, row))
        row = row[order]
        order = order[np.arange(len(row)) - np.searchsorted(row, np.arange(len(self.ids)))[row] < k]
        self._best = row, ids, found = tuple(np.concatenate(x)[order] for x in zip(self._best, more))
        counts = np.bincount(row, minlength=len(self.ids))
        self._floor[counts == k] = found[np.cumsum(counts)[counts == k] - 1]

    def best(self) -> pa.RecordBatch:
        row, ids, found = self._best
        cells = [np.full(len(row), self.block, np.int64), self.lo + row, self.ids[row], ids, found]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cells], names=["query_block", "query_row", "query_id", "vec_id", "score"])


def _numbered(made: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Written blocks with their ``number``, 0, 1, 2, ..., from one count for each task that made them; how many there are."""
    task, mask = F.shiftright("cell", 33), (1 << 33) - 1
    counts = made.select(task.alias("made")).groupBy("made").agg(F.count(F.lit(1)).alias("own"))
    before = Window.orderBy("made").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(counts.select("made", "own", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("start")), name)
    rows = made.withColumn("made", task).join(starts.select("made", "start"), "made")
    rows = rows.withColumn("number", (F.col("start") + F.col("cell").bitwiseAND(mask)).cast("long")).drop("made", "start")
    return rows, starts.agg(F.sum("own")).first()[0] or 0


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = SCALE, block: int = BLOCK,
) -> DataFrame:
    """For every row where ``is_query``: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; k rows, or all if fewer.

    The score is the inner product of the integer weights; ties go to the smaller id.  Candidates are all
    rows but those with the query's id.  Rows with a null id, a null vector or a vector with a null or
    non-finite component take no part; a shorter vector has no weight in the dimensions it lacks.  An id
    that occurs in several rows is as many candidates; as a query, each of its rows gets its own k rows.
    Weights or scores beyond 64 bits raise an error.  An empty table gives an empty table; other columns
    are not looked at.
    """
    spark = vectors.sparkSession
    good = column(id_col).isNotNull() & usable(column(vector_col))
    rows = vectors.where(good).select(column(id_col).cast("long").alias("id"), column(vector_col).alias("v"), is_query.alias("q"))
    with Scratch() as tables:
        cell = F.monotonically_increasing_id()
        cands = written(blocks(rows.select("id", "v"), scale, block).withColumn("cell", cell), "candidates")
        asked = rows.where("q").select("id", "v")
        n_asked, n_weights = asked.agg(F.count(F.lit(1)), F.sum(F.size("v").cast("long"))).first()
        # Queries gathered into full blocks.
        asked = blocks(asked.repartition(max(1, -(-n_asked // max(1, block // 4)))), scale, block)
        asked = written(asked.withColumn("cell", cell), "queries")
        cands, n_cands = _numbered(cands, "candidate-starts")
        asked, n_blocks = _numbered(asked, "query-starts")
        # Groups of queries by what a task can hold, groups of candidates by the cores there are.
        q_groups = max(1, min(n_blocks, -(-(n_weights or 0) // HELD)))
        c_groups = max(1, min(n_cands, max(-(-n_cands // RUN), -(-3 * spark.sparkContext.defaultParallelism // q_groups))))

        def dealt(made: DataFrame, n: int, groups: int, others: int, task: str) -> DataFrame:
            """The blocks in ``groups`` runs of numbers, each copied to the tasks of ``others`` groups of the other side."""
            made = made.withColumn("own", F.expr(f"number * {groups} div {max(1, n)}"))
            made = made.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long"))))
            return made.select(F.expr(task).cast("int").alias("task"), F.col("cell").alias("block"), *_CELLS)

        asked = dealt(asked, n_blocks, q_groups, c_groups, f"own * {c_groups} + other").withColumn("is_candidate", F.lit(False))
        cands = dealt(cands, n_cands, c_groups, q_groups, f"other * {c_groups} + own").withColumn("is_candidate", F.lit(True))
        met = asked.unionByName(cands).repartitionById(q_groups * c_groups, "task")
        met = met.sortWithinPartitions("task", "is_candidate", "block")

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task, held, room = None, [], {}
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                    if row["task"] != task:
                        yield from (part.best() for part in held)
                        task, held = row["task"], []
                    if row["is_candidate"]:
                        cands = _Candidates(row)
                        for part in held:
                            part.meet(cands, room)
                    else:
                        ids, terms, lists = _arrays(row)
                        step = max(1, TILE // block)
                        held += [_Queries(row["block"], ids, terms, lists, lo, min(lo + step, len(ids)), k) for lo in range(0, len(ids), step)]
            yield from (part.best() for part in held)

        with small_batches(spark):
            found = met.mapInArrow(search, "query_block long, query_row long, query_id long, vec_id long, score long")
            found = tables.keep(written(found, "best"))
    place = Window.partitionBy("query_block", "query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
