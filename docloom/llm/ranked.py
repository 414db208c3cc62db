"""Ranked lexical search with deduplicated bags of words.

Every document is reduced to its bag over the items' vocabulary: the terms it shares with any item and how often it holds
them.  Documents with the same bag and the same length factor m have the same score for every item, so they form a class:
equal ones are brought together by a hash of both, verified by comparing both, and each class is scored once.  Its members
are expanded by ascending doc_id; of a class no more than the wanted number can be in an answer, so that many smallest
doc_ids are carried, before the shuffle already, whatever the size of the class.

Texts are read once: the bags are written below the shared folder, and counts, document frequencies and classes come from
them.  Vocabulary, weights and the items' postings are files of the shared folder that tasks map; items are scored in blocks
of ``BLOCK``, classes in slabs of bounded size.  A file name for each block, the sizes of the vocabulary's shards and the
totals N and L are all that goes through the driver.

A word is found by a 64-bit hash and then compared byte by byte with the vocabulary's term.  Sums are exact: in doubles
below 2^53, in integers beyond.

Defined cases: null and empty texts hold no terms and are never an answer; an item without terms, or with none that any
document holds, has no rows; items are told apart by row, so repeated ones (and null item_ids) each get an answer of
their own; equal scores are ranked by ascending doc_id, null ones last; repeated documents are ranked one by one; texts of
any length are read whole; empty tables give no rows; columns besides those named are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, spread
from . import arrays, words
from .topk import Best

#: Items of a block, bytes of bags held at once, classes scored at once, and terms of a vocabulary shard (about).
BLOCK, SLAB_BYTES, CLASSES, SHARD = 1024, 32 << 20, 2048, 1 << 20
_EXACT = 1 << 53


# --- bags as bytes ---------------------------------------------------------------------------------------------------


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, low ones first, the high bit set on all but a value's last byte; and the bytes of each value."""
    values = values.astype(np.uint64)
    sizes = 1 + sum((values >= np.uint64(1 << (7 * j))).astype(np.int64) for j in range(1, 9))
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for j in range(int(sizes.max(initial=0))):
        own = np.flatnonzero(sizes > j)
        more = np.where(sizes[own] > j + 1, 128, 0)
        out[starts[own] + j] = ((values[own] >> np.uint64(7 * j)) & np.uint64(127)).astype(np.uint8) | more.astype(np.uint8)
    return out, sizes


def unpack(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    sizes = ends - starts + 1
    out = np.zeros(len(ends), np.uint64)
    for j in range(int(sizes.max(initial=0))):
        own = np.flatnonzero(sizes > j)
        out[own] |= (data[starts[own] + j] & 127).astype(np.uint64) << np.uint64(7 * j)
    return out.astype(np.int64)


def pack_bags(row: np.ndarray, term: np.ndarray, tf: np.ndarray, rows: int) -> pa.Array:
    """A binary value for each row: its ascending terms, as distances, each with its count."""
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    step = term.copy()
    step[1:] -= np.where(first[1:], 0, term[:-1])
    data, sizes = pack(np.stack([step, tf], axis=1).ravel())
    per_row = np.bincount(row, weights=sizes.reshape(-1, 2).sum(axis=1), minlength=rows).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def unpack_bags(bags: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every entry."""
    offsets, data = words._buffers(bags)
    data = data[offsets[0] : offsets[-1]]
    pairs = unpack(data).reshape(-1, 2)
    done = np.concatenate([[0], np.cumsum(data < 128)])[offsets - offsets[0]] // 2
    sizes = np.diff(done)
    sums = np.concatenate([[0], np.cumsum(pairs[:, 0])])
    row = np.repeat(np.arange(len(bags)), sizes)
    return row, sums[1:] - np.repeat(sums[done[:-1]], sizes), pairs[:, 1]


# --- vocabulary ------------------------------------------------------------------------------------------------------


def _lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct terms of every item with their hashes."""
    for batch in batches:
        items = np.asarray(batch.column("item"))
        for block in words.word_blocks(batch.column("text"), parted=True):
            row = np.repeat(np.arange(len(block.bounds) - 1), np.diff(block.bounds))
            text = _lowered(block.data)
            terms = [text[a:b].tobytes() for a, b in zip(block.starts, block.ends, strict=True)]
            seen = sorted(set(zip(row.tolist(), terms, block.words.astype(np.int64).tolist(), strict=True)))
            yield pa.RecordBatch.from_pydict({
                "item": pa.array([int(items[block.first + r]) for r, _, _ in seen], pa.int64()),
                "term": pa.array([t for _, t, _ in seen], pa.binary()), "hash": pa.array([h for _, _, h in seen], pa.int64()),
            })


def _write_vocabulary(folder: str, shards: int) -> Callable[[pa.Table], pa.Table]:
    def write(table: pa.Table) -> pa.Table:
        hashes = np.asarray(table.column("hash")).view(np.uint64)
        order = np.argsort(hashes)
        hashes = hashes[order]
        if (hashes[1:] == hashes[:-1]).any():
            raise ValueError("two terms of the items share a hash")
        offsets, data = words._buffers(table.column("term").combine_chunks().take(pa.array(order)))
        shard = table.column("shard")[0].as_py()
        arrays.write_arrays(folder, f"terms-{shard:06d}", {"hash": hashes, "offsets": offsets - offsets[0], "data": data[offsets[0] : offsets[-1]]})
        return pa.table({"shard": pa.array([shard], pa.int32()), "size": pa.array([len(hashes)], pa.int64())})

    return write


class Vocabulary:
    """The items' terms, numbered by hash, in files of hash ranges."""

    def __init__(self, folder: str, sizes: list[int]):
        self.folder, self.sizes = folder, sizes
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.held = words.Local()

    def _shard(self, number: int) -> dict[str, np.ndarray]:
        if number not in self.held:
            self.held[number] = arrays.open_arrays(self.folder, f"terms-{number:06d}")
        return self.held[number]

    def numbers(self, block: words.Block) -> np.ndarray:
        """Number of every word of a block, -1 for words that are no term."""
        out = np.full(len(block.words), -1, np.int64)
        parts = arrays.shard_of(block.words, len(self.sizes)) if len(self.sizes) > 1 else np.zeros(len(out), np.int64)
        text = _lowered(block.data)
        for number in np.unique(parts):
            if not self.sizes[number]:
                continue
            held = self._shard(int(number))
            mine = np.flatnonzero(parts == number) if len(self.sizes) > 1 else np.arange(len(out))
            at = np.minimum(np.searchsorted(held["hash"], block.words[mine]), len(held["hash"]) - 1)
            hit = held["hash"][at] == block.words[mine]
            mine, at = mine[hit], at[hit]
            size = held["offsets"][at + 1] - held["offsets"][at]
            same = size == block.ends[mine] - block.starts[mine]
            mine, at, size = mine[same], at[same], size[same]
            # byte by byte
            step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            equal = text[np.repeat(block.starts[mine], size) + step] == held["data"][np.repeat(held["offsets"][at], size) + step]
            if not equal.all():
                bad = np.unique(np.repeat(np.arange(len(mine)), size)[~equal])
                mine, at = np.delete(mine, bad), np.delete(at, bad)
            out[mine] = at + self.starts[number]
        return out


def _bags(vocabulary: Vocabulary) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in words.word_blocks(batch.column("text"), parted=True):
                rows = len(block.bounds) - 1
                number = vocabulary.numbers(block)
                row = np.repeat(np.arange(rows), np.diff(block.bounds))
                known = np.flatnonzero(number >= 0)
                order = np.lexsort((number[known], row[known]))
                own, term = row[known][order], number[known][order]
                new = np.ones(len(own), bool)
                new[1:] = (own[1:] != own[:-1]) | (term[1:] != term[:-1])
                at = np.flatnonzero(new)
                tf = np.diff(np.append(at, len(own)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(block.first, rows), pa.array(np.diff(block.bounds), pa.int64()), pack_bags(own[at], term[at], tf, rows)],
                    ["doc_id", "n", "bag"],
                )

    return work


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms, counts = np.unique(unpack_bags(batch.column("bag"))[1], return_counts=True)
        yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.int64()), "df": pa.array(counts, pa.int64())})


def _write_weights(folder: str, vocabulary: Vocabulary, n_docs: int) -> Callable[[pa.Table], pa.Table]:
    def write(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        df = np.zeros(vocabulary.sizes[shard], np.int64)
        df[np.asarray(table.column("term")) - vocabulary.starts[shard]] = np.asarray(table.column("df"))
        weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        # a term of no document is in no bag
        arrays.write_arrays(folder, f"weights-{shard:06d}", {"weight": weight})
        return pa.table({"shard": pa.array([shard], pa.int32())})

    return write


class Weights:
    def __init__(self, folder: str, vocabulary: Vocabulary):
        self.folder, self.starts = folder, vocabulary.starts
        self.held = words.Local()

    def of(self, terms: np.ndarray) -> np.ndarray:
        out = np.zeros(len(terms), np.int64)
        shard = np.searchsorted(self.starts, terms, "right") - 1
        for number in np.unique(shard):
            if number not in self.held:
                self.held[number] = arrays.open_arrays(self.folder, f"weights-{number:06d}")["weight"]
            own = shard == number
            out[own] = self.held[number][terms[own] - self.starts[number]]
        return out


# --- items -----------------------------------------------------------------------------------------------------------


def _write_postings(folder: str, vocabulary: Vocabulary) -> Callable:
    """Blocks of items as postings: for each ascending term the places of the items that hold it."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            name = f"items-{uuid.uuid4().hex}"
            term = np.concatenate([t for _, t in held])
            place = np.repeat(np.arange(len(held)), [len(t) for _, t in held])
            order = np.lexsort((place, term))
            terms, starts = np.unique(term[order], return_index=True)
            most = max(len(t) for _, t in held)
            arrays.write_arrays(folder, name, {
                "item": np.array([i for i, _ in held], np.int64), "terms": terms, "starts": np.append(starts, len(term)).astype(np.int64), "places": place[order].astype(np.int32),
            })
            held.clear()
            return pa.RecordBatch.from_pydict({"name": [name], "most": pa.array([most], pa.int64())})

        for batch in batches:
            items = np.asarray(batch.column("item"))
            for block in words.word_blocks(batch.column("text"), parted=True):
                number = vocabulary.numbers(block)
                for row, (a, b) in enumerate(zip(block.bounds[:-1], block.bounds[1:], strict=True)):
                    if b > a:
                        held.append((int(items[block.first + row]), np.unique(number[a:b])))
                    if len(held) == BLOCK:
                        yield flush()
        if held:
            yield flush()

    return write


# --- classes ---------------------------------------------------------------------------------------------------------


def _smallest(group: np.ndarray, ids: pa.Array, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` smallest ids of every group, nulls last: groups ascending, ids, whether null."""
    nulls = np.asarray(ids.is_null())
    keys = np.asarray(ids.fill_null(0)).astype(np.int64)
    order = np.lexsort((keys, nulls, group))
    rank = np.arange(len(order)) - np.searchsorted(group[order], group[order])
    order = order[rank < keep]
    return group[order], keys[order], nulls[order]


def _lists(group: np.ndarray, keys: np.ndarray, nulls: np.ndarray, groups: int) -> pa.Array:
    offsets = np.searchsorted(group, np.arange(groups + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys, pa.int64(), mask=nulls))


def _local_classes(keep: int) -> Callable:
    """Classes of the documents of each batch, so that a class costs a shuffled row for each batch, not each document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.asarray(batch.column("bag").dictionary_encode().indices).astype(np.int64)
            m = np.asarray(batch.column("m")).astype(np.int64)
            pairs, first, group = np.unique(np.stack([code, m], axis=1), axis=0, return_index=True, return_inverse=True)
            found = _smallest(group.ravel(), batch.column("doc_id"), keep)
            yield pa.RecordBatch.from_arrays([batch.column("bag").take(pa.array(first)), pa.array(pairs[:, 1], pa.int64()), _lists(*found, len(pairs))], ["bag", "m", "doc_ids"])

    return work


_CLASS = pa.schema([("bag", pa.binary()), ("m", pa.int64()), ("doc_ids", pa.list_(pa.int64()))])


def _merged(table: pa.Table, keep: int) -> pa.Table:
    """One row per class of sorted rows; equal hashes count for nothing here, the rows themselves are compared."""
    table = table.combine_chunks()
    bag, m = table.column("bag"), table.column("m")
    new = np.ones(len(table), bool)
    if len(table) > 1:
        new[1:] = ~(np.asarray(pc.equal(bag[1:], bag[:-1])) & np.asarray(pc.equal(m[1:], m[:-1])))
    group = np.cumsum(new) - 1
    ids = table.column("doc_ids").combine_chunks()
    sizes = np.asarray(pc.list_value_length(ids)).astype(np.int64)
    found = _smallest(np.repeat(group, sizes), ids.flatten(), keep)
    first = pa.array(np.flatnonzero(new))
    return pa.Table.from_arrays([bag.take(first), m.take(first), pa.chunked_array([_lists(*found, int(new.sum()))])], schema=_CLASS)


def _class_slabs(batches: Iterator[pa.RecordBatch], keep: int) -> Iterator[pa.Table]:
    """Whole classes of sorted rows; the last class of a slab waits for its further rows."""
    held: list[pa.Table] = []
    size = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]).select(_CLASS.names).cast(_CLASS))
        size += batch.nbytes
        if size >= SLAB_BYTES:
            table = _merged(pa.concat_tables(held), keep)
            if len(table) > 1:
                yield table.slice(0, len(table) - 1)
            held, size = [table.slice(len(table) - 1)], 0
    if held:
        yield _merged(pa.concat_tables(held), keep)


def _score(folder: str, blocks: list[tuple[str, int]], weights: Weights, keep: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in _class_slabs(batches, keep):
            bags, ids = slab.column("bag").combine_chunks(), slab.column("doc_ids").combine_chunks()
            # one part of all classes' entries for each chunk of classes
            chunks = []
            for first in range(0, len(slab), CLASSES):
                own, term, tf = unpack_bags(bags.slice(first, CLASSES))
                m = np.asarray(slab.column("m").combine_chunks().slice(first, CLASSES))
                chunks.append((first, len(m), own, term, weights.of(term) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[own]))))
            offsets = np.asarray(ids.offsets).astype(np.int64)
            keys, nulls = np.asarray(ids.values.fill_null(0)).astype(np.int64), np.asarray(ids.values.is_null())
            for name, most in blocks:
                held = arrays.open_arrays(folder, name)
                n = len(held["item"])
                best = Best(n, keep)
                for first, rows, own, term, worth in chunks:
                    at = np.minimum(np.searchsorted(held["terms"], term), len(held["terms"]) - 1)
                    hit = np.flatnonzero((held["terms"][at] == term) & (worth > 0))
                    lo, size = held["starts"][at[hit]], held["starts"][at[hit] + 1] - held["starts"][at[hit]]
                    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                    cell = np.repeat(own[hit], size) * n + held["places"][np.repeat(lo, size) + step]
                    if int(worth.max(initial=0)) * most < _EXACT:
                        total = np.bincount(cell, weights=np.repeat(worth[hit], size), minlength=rows * n).astype(np.int64)
                    else:
                        total = np.zeros(rows * n, np.int64)
                        np.add.at(total, cell, np.repeat(worth[hit], size))
                    total = total.reshape(rows, n)
                    floor = np.maximum(best.floors(0).astype(np.int64), 1)
                    if rows >= keep:
                        floor = np.maximum(floor, np.partition(total, rows - keep, axis=0)[rows - keep])
                    row, item = np.nonzero(total >= floor)
                    score = total[row, item]
                    a, count = offsets[first + row], offsets[first + row + 1] - offsets[first + row]
                    member = np.repeat(a, count) + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                    best.add(np.repeat(item, count), np.repeat(score, count), keys[member], nulls[member])
                if len(best.query):
                    yield pa.RecordBatch.from_pydict({
                        "item": pa.array(held["item"][best.query], pa.int64()), "doc_id": pa.array(best.ids, pa.int64(), mask=best.nulls),
                        "score": pa.array(best.score.astype(np.int64), pa.int64()),
                    })

    return work


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` highest-scoring documents of every item: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ranked-{uuid.uuid4().hex}"
    items.select("item_id", "text", F.monotonically_increasing_id().alias("item")).write.parquet(f"{folder}/items")
    items = spark.read.parquet(f"{folder}/items")
    names = items.select("item", "item_id")
    nothing = names.where("false").selectExpr("item_id", "1 AS rank", "item AS doc_id", "item AS score")

    # vocabulary and postings
    terms = items.select("item", "text").mapInArrow(_item_terms, "item bigint, term binary, hash bigint")
    terms.write.parquet(f"{folder}/terms")
    distinct = spark.read.parquet(f"{folder}/terms").select("term", "hash").distinct()
    n_terms = distinct.count()
    if not n_terms:
        return nothing
    shards = -(-n_terms // SHARD)

    def number_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.asarray(batch.column("hash")).view(np.uint64)
            part = arrays.shard_of(hashes, shards) if shards > 1 else np.zeros(len(hashes), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], [*batch.schema.names, "shard"])

    sharded = distinct.mapInArrow(number_shards, "term binary, hash bigint, shard int").groupBy("shard")
    sizes = {r["shard"]: r["size"] for r in sharded.applyInArrow(_write_vocabulary(folder, shards), "shard int, size bigint").collect()}
    vocabulary = Vocabulary(folder, [sizes.get(i, 0) for i in range(shards)])
    n_items = items.count()
    written = items.select("item", "text").repartition(-(-n_items // BLOCK)).mapInArrow(_write_postings(folder, vocabulary), "name string, most bigint")
    blocks = sorted((r["name"], r["most"]) for r in written.collect())

    # bags, and the counts from them
    texts = spread(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    texts.mapInArrow(_bags(vocabulary), "doc_id bigint, n bigint, bag binary").where("n > 0").write.parquet(f"{folder}/bags")
    bags = spark.read.parquet(f"{folder}/bags")
    n_docs, n_words = bags.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return nothing
    counted = bags.select("bag").mapInArrow(_frequencies, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    shard = sum((F.when(F.col("term") >= F.lit(int(s)), 1).otherwise(0) for s in vocabulary.starts[1:-1]), F.lit(0)).cast("int")
    # shards of which no document holds a term are never asked for
    counted.withColumn("shard", shard).groupBy("shard").applyInArrow(_write_weights(folder, vocabulary, n_docs), "shard int").count()

    # classes, scored once each
    factor = F.expr(f"50 + cast(cast(n as decimal(20, 0)) * cast({50 * n_docs} as decimal(18, 0)) div {n_words} as bigint)")
    local = bags.where(F.octet_length("bag") > 0).select("doc_id", "bag", factor.alias("m")).mapInArrow(_local_classes(k), "bag binary, m bigint, doc_ids array<bigint>")
    classes = local.withColumn("hash", F.xxhash64("bag", "m")).repartition("hash").sortWithinPartitions("hash", "bag", "m").drop("hash")
    scored = classes.mapInArrow(_score(folder, blocks, Weights(folder, vocabulary), k), "item bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
