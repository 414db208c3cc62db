"""N-gram Jaccard join in metric space: pivots, Voronoi regions, triangle-inequality windows, exact distances.

Documents are sets of word shingles under the Jaccard distance; two link when 100 |A and B| >= p |A or B|.  Equal sets are
one point, whatever their number of copies.

1. Windows.  A set of n shingles that links with another shares at least ceil(p n / 100) with it, so any
   n - ceil(p n / 100) + 1 of its shingles hit the other's.  Taking these in one global order, rare ones first, places the
   set in the regions of these shingles; linked sets meet in at least one region.
2. Pivots.  Each region takes one of its members, the smallest in a fixed random order, as pivot.  Regions of copies share
   it, so the cells of the pivots are few and each set is in few of them: its own and those whose border it touches.
3. Cell filter.  The shingle space is cut into 256 parts.  The overlaps of a set with the parts are its coordinates; by the
   triangle inequality of the symmetric difference, coordinates of linked sets differ by at most
   (100 - p) / (100 + p) of their summed sizes in all.  Members of a cell without a partner inside size window and
   coordinate window leave.
4. Regions in a cell.  With their shingles, the remaining members are joined exactly: a few members far apart become
   pivots, each member goes to the nearest and, where its distance is within twice the radius of that, to others too, and
   the regions are joined the same way until they are small or do not shrink.  Members of one component need not be
   compared with each other.
5. Links, one per member at most, go to connected components.

A cell above ``CELL`` members is cut into blocks by hash and every pair of blocks is a cell of its own, so no task holds
an unbounded group.  No step emits pairs of members; rows grow with documents.

Defined cases: a text without words, or null, has no shingles and links with nothing; a text of fewer words than a shingle
is one shingle; repeated rows each give a row; rows of null doc_id take part but name no component.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import arrays, components, fixed, words

SHINGLE, PERCENT = 4, 85
#: Parts of the shingle space that give a set's coordinates.
PARTS = 256
#: Hash buckets of the rarity order, and bits of the bitmap of sets still in play.
RARITY, BITMAP = 1 << 20, 1 << 24
#: Fixed value: bits of a map of Spark's bitmap aggregate.
_MAP = 32768
#: Members of a cell handled as one group.
CELL = 3000
_SET_BYTES = 6


def _sets(texts: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, distinct shingles and row bounds."""
    for block in words.word_blocks(texts):
        yield block.first, *words.distinct_per_row(*words.shingle_hashes(block.words, block.bounds, shingle))


def _set_ids(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set, order-free; 0 for an empty set."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words.mix(values ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)])
    n = np.diff(bounds).astype(np.uint64)
    out = words.mix(sums[bounds[1:]] - sums[bounds[:-1]] + n * np.uint64(0xE7037ED1A0B428DB))
    out[n == 0] = 0
    return out


def _coordinates(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Overlaps with the parts of the space, up to 255 each (a bound that keeps differences from growing)."""
    rows = len(bounds) - 1
    row = np.repeat(np.arange(rows), np.diff(bounds))
    part = (words.mix(values) >> np.uint64(56)).astype(np.int64) % PARTS
    return np.minimum(np.bincount(row * PARTS + part, minlength=rows * PARTS), 255).astype(np.uint8).reshape(rows, PARTS)


def _signed(ids: np.ndarray) -> np.ndarray:
    return ids.view(np.int64)


def _rarity(texts: DataFrame, shingle: int) -> np.ndarray:
    """A byte per hash bucket that grows with the bucket's share of all shingles above the mean."""

    def count(batch: pa.RecordBatch, held: np.ndarray) -> None:
        for _, values, _ in _sets(batch.column(0), shingle):
            held += np.bincount((values >> np.uint64(44)).astype(np.int64), minlength=len(held))[: len(held)]

    totals = fixed.summed(texts, RARITY, count)
    mean = totals.mean() + 1
    return np.clip(np.floor(2 * np.log2((totals + 1) / mean)), 0, 255).astype(np.uint8)


def _windows(shards: int, shingle: int, percent: int, rarity: np.ndarray):
    """Blocks of (shingle, set) for each shard of shingles."""
    schema = pa.schema([("shard", pa.int32()), ("block", pa.binary())])

    def emit(shingles: list, sets: list) -> Iterator[pa.RecordBatch]:
        key, own = np.concatenate(shingles), np.concatenate(sets)
        place = arrays.shard_of(words.mix(key), shards)
        order = np.argsort(place, kind="stable")
        edges = np.searchsorted(place[order], np.arange(shards + 1))
        for s in range(shards):
            pick = order[edges[s] : edges[s + 1]]
            if len(pick):
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([key[pick].tobytes() + own[pick].tobytes()], pa.binary())], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, sets, held, seen = [], [], 0, set()
        for batch in batches:
            for _, values, bounds in _sets(batch.column(0), shingle):
                ids = _set_ids(values, bounds)
                level = rarity[(values >> np.uint64(44)).astype(np.int64)]
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    n = b - a
                    if not n or ids[i] in seen:
                        continue
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(ids[i])
                    take = n - (-(-percent * n // 100)) + 1
                    # rarest first, then by hash: values are ascending already
                    first = values[a:b][np.argsort(level[a:b], kind="stable")[:take]]
                    shingles.append(first)
                    sets.append(np.full(len(first), ids[i]))
                    held += len(first)
                if held > 1_000_000:
                    yield from emit(shingles, sets)
                    shingles, sets, held = [], [], 0
        if held:
            yield from emit(shingles, sets)

    return work


def _cells(table: pa.Table) -> pa.Table:
    """Distinct (pivot, set) of the regions of a shard that have more than one member."""
    keys, sets = [], []
    for block in table.column("block"):
        raw = np.frombuffer(block.as_py(), np.uint64)
        keys.append(raw[: len(raw) // 2])
        sets.append(raw[len(raw) // 2 :])
    key, own = np.concatenate(keys), np.concatenate(sets)
    # members of a region in the fixed random order, the pivot first
    order = np.lexsort((words.mix(own), key))
    key, own = key[order], own[order]
    same = np.concatenate([[False], (key[1:] == key[:-1]) & (own[1:] == own[:-1])])
    key, own = key[~same], own[~same]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(starts, len(key)))
    pivot = np.repeat(own[starts], size)
    many = np.repeat(size > 1, size)
    pivot, own = pivot[many], own[many]
    order = np.lexsort((own, pivot))
    pivot, own = pivot[order], own[order]
    new = np.concatenate([[True], (pivot[1:] != pivot[:-1]) | (own[1:] != own[:-1])]) if len(own) else np.zeros(0, bool)
    return pa.table({"pivot": pa.array(_signed(pivot[new]), pa.int64()), "set_id": pa.array(_signed(own[new]), pa.int64())})


def _partners(percent: int):
    """Members of a cell that have a partner inside the size and coordinate windows."""

    def work(table: pa.Table) -> pa.Table:
        size = table.column("n").to_numpy()
        order = np.argsort(size, kind="stable")
        size = size[order].astype(np.int64)
        at = np.frombuffer(b"".join(table.column("coordinates").to_pylist()), np.uint8).reshape(-1, PARTS)[order].astype(np.int16)
        keep = np.zeros(len(size), bool)
        reach = np.searchsorted(size * percent, size * 100, "right")
        for i in range(len(size) - 1):
            for lo in range(i + 1, int(reach[i]), 2048):
                hi = min(lo + 2048, int(reach[i]))
                apart = np.abs(at[lo:hi] - at[i]).sum(1)
                near = apart * (100 + percent) <= (100 - percent) * (size[lo:hi] + size[i])
                if near.any():
                    keep[i] = True
                    keep[lo:hi] |= near
        chosen = np.sort(order[keep])
        return table.select(["cell", "set_id"]).take(pa.array(chosen))

    return work


class _Join:
    """Exact join of the members of a cell: components under the link relation."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent, self.radius = percent, (100 - percent) / 100
        self.size = np.fromiter(map(len, sets), np.int64, len(sets))
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        names, local = np.unique(flat, return_inverse=True)
        self.local, self.names = local, len(names)
        self.starts = np.concatenate([[0], np.cumsum(self.size)])
        self.parent = np.arange(len(sets))
        self.mark = np.zeros(self.names, bool)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = int(self.parent[i])
        return i

    def overlaps(self, i: int, others: np.ndarray) -> np.ndarray:
        """Shared shingles of one member with others."""
        own = self.local[self.starts[i] : self.starts[i + 1]]
        self.mark[own] = True
        size = self.size[others]
        at = np.repeat(self.starts[others], size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        sums = np.concatenate([[0], np.cumsum(self.mark[self.local[at]])])
        ends = np.cumsum(size)
        self.mark[own] = False
        return sums[ends] - sums[ends - size]

    def link(self, i: int, others: np.ndarray) -> np.ndarray:
        """Distances of one member to others, after joining those that link."""
        shared = self.overlaps(i, others)
        union = self.size[i] + self.size[others] - shared
        for j in others[100 * shared >= self.percent * union]:
            a, b = self.root(i), self.root(int(j))
            self.parent[max(a, b)] = min(a, b)
        return 1 - shared / union

    def region(self, members: np.ndarray, depth: int = 0) -> None:
        """Join a region: by pivots while it is large, else each member with those of other components."""
        if len(members) > 96 and depth < 12:
            pivots, apart = [int(members[0])], []
            while len(pivots) < 8:
                apart.append(self.link(pivots[-1], members))
                nearest = np.min(apart, axis=0)
                far = int(np.argmax(nearest))
                if nearest[far] <= self.radius:
                    break
                pivots.append(int(members[far]))
            if len(apart) < len(pivots):
                apart.append(self.link(pivots[-1], members))
            apart = np.array(apart)
            home = apart.argmin(0)
            window = apart <= apart.min(0) + 2 * self.radius + 1e-9
            parts = [members[window[k]] for k in range(len(pivots)) if (home == k).any()]
            if max(map(len, parts)) <= 0.8 * len(members):
                for part in parts:
                    self.region(part, depth + 1)
                return
        members = members[np.argsort(self.size[members], kind="stable")]
        size = self.size[members]
        for i, m in enumerate(members[:-1]):
            stop = int(np.searchsorted(size * self.percent, size[i] * 100, "right"))
            rest = members[i + 1 : stop]
            if len(rest):
                top = self.root(int(m))
                rest = rest[np.fromiter((self.root(int(j)) != top for j in rest), bool, len(rest))]
            if len(rest):
                self.link(int(m), rest)


def _links(percent: int):
    """A link from each member of a cell to the first member of its component."""

    def work(table: pa.Table) -> pa.Table:
        ids = table.column("set_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        raw = table.column("shingles")
        sets = []
        for i in order:
            narrow = np.frombuffer(raw[int(i)].as_py(), np.uint8).reshape(-1, _SET_BYTES)
            wide = np.zeros((len(narrow), 8), np.uint8)
            wide[:, :_SET_BYTES] = narrow
            sets.append(wide.view(np.uint64).reshape(-1))
        join = _Join(sets, percent)
        join.region(np.arange(len(ids)))
        roots = np.fromiter((join.root(i) for i in range(len(ids))), np.int64, len(ids))
        linked = roots != np.arange(len(ids))
        return pa.table({"a": pa.array(ids[linked], pa.int64()), "b": pa.array(ids[roots[linked]], pa.int64())})

    return work


def _describe(shingle: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, values, bounds in _sets(batch.column(1), shingle):
                n = np.diff(bounds)
                ids = _signed(_set_ids(values, bounds))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(n)), pa.array(n, pa.int64()), pa.array(ids, pa.int64(), mask=n == 0)], ["doc_id", "n_shingles", "set_id"])

    return work


def _once_per_set(shingle: int, bitmap: np.ndarray, what: str):
    """Coordinates or shingles of the sets that the bitmap has, each once per task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for _, values, bounds in _sets(batch.column(0), shingle):
                ids, n = _set_ids(values, bounds), np.diff(bounds)
                at = (ids % np.uint64(BITMAP)).astype(np.int64)
                wanted = np.flatnonzero((n > 0) & ((bitmap[at >> 3] >> (at & 7)) & 1 == 1))
                wanted = np.array([i for i in wanted if not (ids[i] in seen or seen.add(ids[i]))], np.int64)
                if len(seen) > 500_000:
                    seen.clear()
                if not len(wanted):
                    continue
                if what == "coordinates":
                    every = _coordinates(values, bounds)
                    data = [every[i].tobytes() for i in wanted]
                else:
                    data = [np.ascontiguousarray(values[bounds[i] : bounds[i + 1]] >> np.uint64(64 - 8 * _SET_BYTES)).view(np.uint8).reshape(-1, 8)[:, :_SET_BYTES].tobytes() for i in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(_signed(ids[wanted]), pa.int64()), pa.array(n[wanted], pa.int64()), pa.array(data, pa.binary())], ["set_id", "n", what])

    return work


def _bitmap(rows: DataFrame) -> np.ndarray:
    """Bits of the sets' ids, eight to a byte, put together by Spark's own aggregate: 2 MiB whatever the number of sets."""
    number = F.pmod(F.col("set_id"), F.lit(BITMAP))
    maps = rows.groupBy((number / _MAP).cast("int").alias("map")).agg(F.bitmap_construct_agg(number % _MAP).alias("bits"))
    out = np.zeros(BITMAP // 8, np.uint8)
    for row in maps.collect():
        out[row["map"] * _MAP // 8 : (row["map"] + 1) * _MAP // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Key, n_shingles, set_id, component_id (smallest key reachable by links) and n_links_class, the size of its component."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/jaccard-{uuid.uuid4().hex}"
    shards = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def save(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    described = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    described = save(described.mapInArrow(_describe(shingle), f"doc_id {kind}, n_shingles bigint, set_id bigint"), "documents")

    rarity = _rarity(texts, shingle)
    blocks = texts.mapInArrow(_windows(shards, shingle, percent, rarity), "shard int, block binary")
    met = blocks.groupBy("shard").applyInArrow(_cells, "pivot bigint, set_id bigint")
    met = save(met.distinct(), "cells")

    once = texts.mapInArrow(_once_per_set(shingle, _bitmap(met), "coordinates"), "set_id bigint, n bigint, coordinates binary")
    once = once.groupBy("set_id").agg(F.first("n").alias("n"), F.first("coordinates").alias("coordinates"))
    # a cell above the limit becomes all pairs of its blocks
    counts = met.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    placed = met.join(counts, "pivot").withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select("set_id", F.col("pivot"), "block", other.alias("other"))
    placed = placed.select("set_id", F.concat_ws(":", "pivot", F.least("block", "other"), F.greatest("block", "other")).alias("cell"))
    members = placed.join(once, "set_id").select("cell", "set_id", "n", "coordinates")
    left = save(members.groupBy("cell").applyInArrow(_partners(percent), "cell string, set_id bigint"), "partners")

    sets = texts.mapInArrow(_once_per_set(shingle, _bitmap(left), "shingles"), "set_id bigint, n bigint, shingles binary")
    sets = sets.groupBy("set_id").agg(F.first("shingles").alias("shingles"))
    links = left.join(sets, "set_id").select("cell", "set_id", "shingles").groupBy("cell").applyInArrow(_links(percent), "a bigint, b bigint")
    roots = components.components(save(links, "links"))

    named = described.join(roots, F.col("set_id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "set_id"))
    first = named.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("component_size")).withColumnRenamed("root", "r")
    out = named.join(first, F.col("root") == F.col("r"), "left")
    return out.select(F.col("doc_id").alias(key), "n_shingles", "set_id", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("component_size", F.lit(1)).cast("bigint").alias("component_size"))
