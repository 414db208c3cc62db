"""Exact inner-product top-k search with a three-phase uniform threshold.

The score of a vector is the sum of the partial scores of ``LISTS`` lists, one per range of its dimensions.

1. Gather: every slab of rows finds, for each query and list, its highest partial scores; those entries' whole scores are
   merged to the k + 1 highest per query.  The last of them is the query's cutoff: its answer cannot score less.
2. Broadcast and collect: cutoffs lie beside the queries in files of the shared folder, which tasks map block by block.  A
   vector that reaches the cutoff c reaches c / LISTS in some list (else its sum would be smaller), so only entries at or
   above that uniform threshold are collected.  The lists in which an entry stays below count as c / LISTS; entries whose
   bound so made stays below c go.
3. Resolve: what is left gets its exact whole score; scores at or above the cutoff are ranked.

One more than k is kept because a query's own row is among its entries.  It is left out by id and score, so repeated rows of
the query count as candidates.  Queries are read in blocks of ``BLOCK`` vectors and rows in slabs of bounded size, so memory
does not grow with either; of a slab never more than k + 1 entries a query leave it, whatever ties it holds.  A file name for
each query block is all that goes through the driver.

Components become floor(1024 * x), and sums are exact: in doubles below 2^53, in integers beyond.  Scores must fit a long.

Defined cases: null vectors and those with a null or non-finite component take no part; a vector meets only vectors of its
own length; an empty vector scores 0; equal scores are ranked by ascending vec_id, null ones last; a null vec_id is a
candidate, never a query; a query row that is repeated is answered once for each row; an empty table has no rows;
columns besides the two named are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, spread
from . import arrays

SCALE = 1024
LISTS = 4
#: Queries of a block, bytes of a slab, rows of it scored at once, and slabs merged in one group.
BLOCK, SLAB_BYTES, ROWS, MERGED = 1024, 64 << 20, 4096, 256
_EXACT = float(1 << 53)


def _batch_vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, whether they are null, and scaled vectors of a batch, for each length of vectors."""
    ids, lists = batch.column(0), batch.column(1)
    nulls = np.asarray(ids.is_null())
    keys = np.asarray(ids.fill_null(0)).astype(np.int64)
    offsets = np.asarray(lists.offsets).astype(np.int64)
    values = np.floor(np.asarray(lists.values.to_numpy(zero_copy_only=False), np.float64) * SCALE)
    lengths = np.diff(offsets)
    valid = np.asarray(lists.is_valid())
    for length in np.unique(lengths[valid]):
        rows = np.flatnonzero(valid & (lengths == length))
        matrix = values[offsets[rows][:, None] + np.arange(length)]
        rows, matrix = (x[np.isfinite(matrix).all(axis=1)] for x in (rows, matrix))
        if len(rows):
            yield keys[rows], nulls[rows], matrix


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of one length each, up to ``SLAB_BYTES``."""
    held: dict[int, list] = {}
    size = 0

    def whole(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.concatenate([p[i] for p in parts]) for i in range(3))

    for batch in batches:
        for found in _batch_vectors(batch):
            held.setdefault(found[2].shape[1], []).append(found)
            size += found[2].nbytes + 16 * len(found[0])
        if size >= SLAB_BYTES:
            yield from map(whole, held.values())
            held, size = {}, 0
    yield from map(whole, held.values())


def _write_queries(folder: str) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, matrix in _slabs(batches):
            for at in range(0, len(ids), BLOCK):
                name = f"queries-{uuid.uuid4().hex}"
                part = matrix[at : at + BLOCK]
                arrays.write_arrays(folder, name, {"ids": ids[at : at + BLOCK], "vectors": part.ravel()})
                yield pa.RecordBatch.from_pydict({"name": [name], "length": pa.array([part.shape[1]], pa.int32())})

    return write


class _Queries:
    """Query blocks as the tasks see them; cutoffs stand beside them once they are known."""

    def __init__(self, folder: str, blocks: list[tuple[str, int]]):
        self.folder, self.blocks = folder, blocks

    def of_length(self, length: int, cutoffs: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
        for number, (name, own) in enumerate(self.blocks):
            if own == length:
                held = arrays.open_arrays(self.folder, name)
                cut = arrays.open_arrays(self.folder, f"cutoffs-{number}")["cutoff"] if cutoffs else None
                yield number, np.asarray(held["ids"]), np.asarray(held["vectors"]).reshape(len(held["ids"]), length), cut


def _typed(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a type in which sums of products, and those times the number of lists, are exact."""
    if rows.shape[1] == 0 or not len(rows):
        return rows, queries
    most = float(np.abs(rows).max()) * float(np.abs(queries).max()) * rows.shape[1] * LISTS
    if most < _EXACT:
        return rows, queries
    if most < float(1 << 62) and max(np.abs(rows).max(), np.abs(queries).max()) < _EXACT:
        return rows.astype(np.int64), queries.astype(np.int64)
    integers = np.vectorize(int, otypes=[object])
    return integers(rows), integers(queries)


def _partial_scores(rows: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Scores of chunks of rows (down) for all queries (across), list by list."""
    rows, queries = _typed(rows, queries)
    edges = np.linspace(0, rows.shape[1], LISTS + 1).astype(int)
    for first in range(0, len(rows), ROWS):
        chunk = rows[first : first + ROWS]
        yield first, [chunk[:, a:b] @ queries[:, a:b].T for a, b in zip(edges[:-1], edges[1:], strict=True)]


class Best:
    """The highest entries of each of ``n`` queries, ties to the smallest id."""

    def __init__(self, n: int, keep: int):
        self.n, self.keep = n, keep
        self.query, self.score = np.zeros(0, np.int64), np.zeros(0)
        self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, bool)
        self.floor = None

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score.astype(score.dtype), score])
        ids, nulls = np.concatenate([self.ids, ids]), np.concatenate([self.nulls, nulls])
        order = np.lexsort((ids, nulls, -score, query))
        rank = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order = order[rank < self.keep]
        self.query, self.score, self.ids, self.nulls = query[order], score[order], ids[order], nulls[order]

    def floors(self, least) -> np.ndarray:
        """The last kept score of each query that has as many as are kept, else ``least``."""
        out = np.full(self.n, least, self.score.dtype if self.score.dtype == object else np.float64 if self.score.dtype == np.float64 else object)
        counts = np.bincount(self.query, minlength=self.n)
        full = np.flatnonzero(counts >= self.keep)
        out[full] = self.score[np.cumsum(counts)[full] - 1]
        return out


_NONE = -(1 << 63)


def _gather(queries: _Queries, keep: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, slab = TaskContext.get().partitionId(), 0
        for ids, nulls, rows in _slabs(batches):
            slab += 1
            for number, _, vectors, _ in queries.of_length(rows.shape[1]):
                n = len(vectors)
                best, lists = Best(n, keep), [Best(n, keep) for _ in range(LISTS)]
                for first, scores in _partial_scores(rows, vectors):
                    chosen = np.zeros(scores[0].shape, bool)
                    for tops, values in zip(lists, scores, strict=True):
                        if not len(tops.query) and len(values) >= keep:
                            floor = np.partition(values, len(values) - keep, axis=0)[len(values) - keep]
                        else:
                            floor = tops.floors(-np.inf)
                        high = (values >= floor).astype(bool)
                        chosen |= high
                        row, query = np.nonzero(high)
                        tops.add(query, values[row, query], ids[first + row], nulls[first + row])
                    row, query = np.nonzero(chosen)
                    best.add(query, sum(s[row, query] for s in scores), ids[first + row], nulls[first + row])
                held = np.full((n, keep), _NONE, np.int64)
                rank = np.arange(len(best.query)) - np.searchsorted(best.query, best.query)
                held[best.query, rank] = best.score.astype(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([number], pa.int32()), "part": pa.array([part * 7919 + slab], pa.int64()), "scores": pa.array([held.tobytes()], pa.binary()),
                })

    return work


def _highest(table: pa.Table, keep: int) -> np.ndarray:
    best = None
    for block in table.column("scores"):
        held = np.frombuffer(block.as_py(), np.int64).reshape(-1, keep)
        best = held if best is None else np.sort(np.concatenate([best, held], axis=1), axis=1)[:, : -keep - 1 : -1]
    return best


def _merge(keep: int) -> Callable:
    def merge(table: pa.Table) -> pa.Table:
        return pa.table({"block": table.column("block")[:1], "scores": pa.array([_highest(table, keep).tobytes()], pa.binary())})

    return merge


def _write_cutoffs(folder: str, keep: int) -> Callable:
    def write(table: pa.Table) -> pa.Table:
        number = table.column("block")[0].as_py()
        arrays.write_arrays(folder, f"cutoffs-{number}", {"cutoff": np.ascontiguousarray(_highest(table, keep)[:, keep - 1])})
        return pa.table({"block": pa.array([number], pa.int32())})

    return write


def _collect(queries: _Queries, keep: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, nulls, rows in _slabs(batches):
            for number, names, vectors, cut in queries.of_length(rows.shape[1], cutoffs=True):
                best = Best(len(vectors), keep)
                for first, scores in _partial_scores(rows, vectors):
                    kind = scores[0].dtype
                    own = cut.astype(kind) if kind == np.float64 else cut.astype(object)
                    every = np.asarray(cut) == _NONE
                    chosen = np.broadcast_to(every, scores[0].shape).copy()
                    for values in scores:
                        chosen |= (values * LISTS >= own).astype(bool)
                    row, query = np.nonzero(chosen)
                    parts, limit = [s[row, query] for s in scores], own[query]
                    bound = sum(np.where((p * LISTS >= limit).astype(bool), p * LISTS, limit) for p in parts)
                    reach = every[query] | (bound >= limit * LISTS).astype(bool)
                    row, query = row[reach], query[reach]
                    score = sum(p[reach] for p in parts)
                    enough = every[query] | (score >= own[query]).astype(bool)
                    row, query = row[enough], query[enough]
                    best.add(query, score[enough], ids[first + row], nulls[first + row])
                if len(best.query):
                    typed = _typed(vectors, vectors)[0]
                    selfs = (typed * typed).sum(axis=1).astype(np.int64) if vectors.shape[1] else np.zeros(len(vectors), np.int64)
                    score = best.score.astype(np.int64)
                    asked = names[best.query]
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array(np.full(len(score), number, np.int32)), "number": pa.array(best.query.astype(np.int32)),
                        "query_id": pa.array(asked, pa.int64()), "vec_id": pa.array(best.ids, pa.int64(), mask=best.nulls), "score": pa.array(score, pa.int64()),
                        "own": pa.array((best.ids == asked) & ~best.nulls & (score == selfs[best.query])),
                    })

    return work


def search(vectors: DataFrame, wanted: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` rows of highest inner product with each row for which ``wanted`` holds: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    keep = k + 1
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    asked = vectors.where(wanted & F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/topk-{uuid.uuid4().hex}"
    n_rows, n_asked = vectors.count(), asked.select("id").count()
    blocks = asked.repartition(max(1, -(-n_asked // BLOCK))).mapInArrow(_write_queries(folder), "name string, length int").collect()
    queries = _Queries(folder, sorted((r["name"], r["length"]) for r in blocks))
    rows = spread(rows)
    salts = max(1, n_rows * 8 * max([8, *(b[1] for b in queries.blocks)]) // (SLAB_BYTES * MERGED))
    gathered = rows.mapInArrow(_gather(queries, keep), "block int, part bigint, scores binary")
    merged = gathered.groupBy("block", F.pmod(F.xxhash64("part"), F.lit(salts)).alias("salt")).applyInArrow(_merge(keep), "block int, scores binary")
    merged.groupBy("block").applyInArrow(_write_cutoffs(folder, keep), "block int").count()
    found = rows.mapInArrow(_collect(queries, keep), "block int, number int, query_id bigint, vec_id bigint, score bigint, own boolean")
    query = Window.partitionBy("block", "number")
    place = F.row_number().over(query.orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    ranked = found.withColumn("place", place).where(F.col("place") <= keep)
    ranked = ranked.withColumn("self", F.min(F.when(F.col("own"), F.col("place"))).over(query)).where("self is null or place <> self")
    rank = (F.col("place") - F.when(F.col("place") > F.col("self"), 1).otherwise(0)).cast("int")
    return ranked.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
