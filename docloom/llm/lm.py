"""Language-model scoring: an interpolated modified Kneser-Ney bigram model, counted in Spark.

Counting: tasks count words and word pairs of their texts and send each shard of the hash space one compressed block, so
no row per pair is shuffled and no frequent word meets in one task.  Each shard merges its blocks and writes its pairs as
sorted hash arrays; the continuation and context counts that follow from the distinct pairs go, again as one block per
shard, to the shards of the words, which write theirs.  A few totals per shard give the discounts.  Scoring tasks
memory-map the files and look words and pairs up in batches.

    p(w | h) = (c(h w) - D(c(h w))) / c(h) + g(h) q(w),      g(h) = (D1 N1(h) + D2 N2(h) + D3 N3(h)) / c(h)
    q(w)     = (k(w) - E(k(w))) / K + g0 / (V + 1),          k(w): distinct words seen in front of w

with q(w) alone after an unseen h.  V + 1 is the training vocabulary and one unknown word.  Each text begins in a start
context and closes with an end token.

Defined cases: a null or empty text has one token, the end; a text of a null doc_id trains; repeated rows count each time.
With no training rows every token has probability 1 in V + 1 = 1, so scores are 0.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import arrays, bitmaps, words

_END = np.uint64(0x1F83D9ABFB41BD6B)
_START = np.uint64(0x5BE0CD19137E2179)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
#: Tokens a counting task holds before it sends its blocks.
CHUNK = 1_000_000


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return words.mix(left * _PAIR + right)


def token_runs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, token hashes and row bounds, an end token behind each row's words."""
    for block in words.word_blocks(texts):
        rows = len(block.bounds) - 1
        bounds = block.bounds + np.arange(rows + 1)
        tokens = np.empty(int(bounds[-1]), np.uint64)
        ends = bounds[1:] - 1
        own = np.ones(len(tokens), bool)
        own[ends] = False
        tokens[own], tokens[ends] = block.words, _END
        yield block.first, tokens, bounds


def contexts(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The token in front of each token, or the start."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[bounds[:-1]] = _START
    return before


def _block(*columns: np.ndarray) -> bytes:
    sizes = np.array([len(columns), *(c.nbytes for c in columns), *(ord(c.dtype.char) for c in columns)], np.int64)
    raw = sizes.tobytes() + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def _unblock(block: bytes) -> list[np.ndarray]:
    raw = pa.decompress(block[8:], int(np.frombuffer(block[:8], np.int64)[0]), "zstd", asbytes=True)
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    sizes = np.frombuffer(raw[8 : 8 + 16 * n], np.int64)
    out, at = [], 8 + 16 * n
    for i in range(n):
        out.append(np.frombuffer(raw[at : at + sizes[i]], np.dtype(chr(sizes[n + i]))))
        at += int(sizes[i])
    return out


def _sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ascending distinct keys and the sums of their values."""
    if not len(keys):
        return keys, *(v.astype(np.int64) for v in values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], *(np.add.reduceat(v[order].astype(np.int64), first) for v in values)


def _count_blocks(shards: int):
    schema = pa.schema([("shard", pa.int32()), ("word_block", pa.binary()), ("pair_block", pa.binary())])

    def emit(tokens: list[np.ndarray], before: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, left = np.concatenate(tokens), np.concatenate(before)
        known, local = np.unique(np.concatenate([token, left]), return_inverse=True)
        own, prior = local[: len(token)], local[len(token) :]
        counts = np.bincount(own, minlength=len(known))
        pairs, pair_counts = np.unique((prior.astype(np.uint64) << np.uint64(32)) | own.astype(np.uint64), return_counts=True)
        a, b = known[pairs >> np.uint64(32)], known[pairs & np.uint64(0xFFFFFFFF)]
        # blocks of a shard stay in the order of the left word, which compresses
        place = arrays.shard_of(pair_hash(a, b), shards)
        order = np.argsort(place, kind="stable")
        edges = np.searchsorted(place[order], np.arange(shards + 1))
        seen = np.flatnonzero(counts)
        word_edges = np.searchsorted(arrays.shard_of(known[seen], shards), np.arange(shards + 1))
        for s in range(shards):
            pick, mine = order[edges[s] : edges[s + 1]], seen[word_edges[s] : word_edges[s + 1]]
            if len(pick) or len(mine):
                left_words = a[pick]
                first = np.flatnonzero(np.concatenate([[True], left_words[1:] != left_words[:-1]])) if len(pick) else np.zeros(0, np.int64)
                runs = np.diff(np.append(first, len(pick))).astype(np.uint32)
                row = [s, _block(known[mine], counts[mine].astype(np.uint32)), _block(left_words[first], runs, b[pick], pair_counts[pick].astype(np.uint32))]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, schema.types, strict=True)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, before, held = [], [], 0
        for batch in batches:
            for _, token, bounds in token_runs(batch.column(0)):
                tokens.append(token)
                before.append(contexts(token, bounds))
                held += len(token)
                if held >= CHUNK:
                    yield from emit(tokens, before)
                    tokens, before, held = [], [], 0
        if held:
            yield from emit(tokens, before)

    return work


def _merge_pairs(folder: str, shards: int):
    def work(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        word, count, left, right, pairs = [], [], [], [], []
        for w, p in zip(table.column("word_block").to_pylist(), table.column("pair_block").to_pylist(), strict=True):
            a, n = _unblock(w)
            word.append(a)
            count.append(n)
            h, runs, b, c = _unblock(p)
            left.append(np.repeat(h, runs))
            right.append(b)
            pairs.append(c)
        word, count = _sum_by(np.concatenate(word), np.concatenate(count))
        left, right, pairs = np.concatenate(left), np.concatenate(right), np.concatenate(pairs)
        key = pair_hash(left, right)
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        total = np.add.reduceat(pairs[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
        left, right = left[order[first]], right[order[first]]
        arrays.write_arrays(folder, f"pair-{shard:06d}", arrays.index(key[first], shard, shards) | arrays.small("count", total))
        # what the words of each shard need to know of these pairs
        ctx, n1, n2, n3 = _sum_by(left, total == 1, total == 2, total >= 3)
        cont, k = _sum_by(right, np.ones(len(right), np.int64))
        e_ctx, e_cont, e_word = (np.searchsorted(arrays.shard_of(x, shards), np.arange(shards + 1)) for x in (ctx, cont, word))
        rows = []
        stats = _block(np.array([int((total == i).sum()) for i in (1, 2, 3, 4)], np.int64))
        for s in range(shards):
            a, b, c = (slice(e[s], e[s + 1]) for e in (e_ctx, e_cont, e_word))
            if ctx[a].size or cont[b].size or word[c].size or s == shard:
                rows.append((s, _block(ctx[a], n1[a].astype(np.uint32), n2[a].astype(np.uint32), n3[a].astype(np.uint32), cont[b], k[b].astype(np.uint32), word[c], count[c].astype(np.uint64)), stats if s == shard else None))
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int32()), "block": pa.array([r[1] for r in rows], pa.binary()), "stats": pa.array([r[2] for r in rows], pa.binary())})

    return work


def _merge_words(folder: str, shards: int):
    def work(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        parts = [_unblock(b) for b in table.column("block").to_pylist()]
        key = np.concatenate([x for p in parts for x in (p[0], p[4], p[6])])
        sizes = [(len(p[0]), len(p[4]), len(p[6])) for p in parts]

        def column(which: int, at: int) -> np.ndarray:
            out = []
            for p, size in zip(parts, sizes, strict=True):
                for j, n in enumerate(size):
                    out.append(p[at].astype(np.int64) if j == which else np.zeros(n, np.int64))
            return np.concatenate(out)

        key, n1, n2, n3, k, count = _sum_by(key, column(0, 1), column(0, 2), column(0, 3), column(1, 5), column(2, 7))
        store = arrays.index(key, shard, shards)
        for name, values in (("count", count), ("k", k), ("n1", n1), ("n2", n2), ("n3", n3)):
            store |= arrays.small(name, values)
        arrays.write_arrays(folder, f"word-{shard:06d}", store)
        stats = np.zeros(4, np.int64)
        for s in table.column("stats").to_pylist():
            if s is not None:
                stats = stats + _unblock(s)[0]
        figures = [int(count.sum()), int((count > 0).sum()), int(k.sum()), *(int((k == i).sum()) for i in (1, 2, 3, 4)), int((k >= 3).sum()), *map(int, stats)]
        return pa.table({n: pa.array([x], pa.int64()) for n, x in zip(FIGURES, figures, strict=True)})

    return work


FIGURES = ("tokens", "types", "k_sum", "k1", "k2", "k3", "k4", "k3_up", "p1", "p2", "p3", "p4")


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from the numbers of entries seen 1 to 4 times.

    Where those numbers are zero, as in tiny corpora, a discount is kept inside 0 to its count.
    """
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [0.0] + [min(max(d, 0.05), i - 0.05) for i, d in enumerate(raw, 1)]


class Model:
    """Where a model's files lie, and its totals."""

    def __init__(self, folder: str, shards: int, figures: dict[str, int]):
        self.folder, self.shards, self.figures = folder, shards, figures


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count words and pairs of a text column and write the model below the shared folder."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lm-{uuid.uuid4().hex}"
    shards = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(_count_blocks(shards), "shard int, word_block binary, pair_block binary")
    merged = blocks.groupBy("shard").applyInArrow(_merge_pairs(folder, shards), "shard int, block binary, stats binary")
    merged.write.parquet(f"{folder}/merged")
    done = spark.read.parquet(f"{folder}/merged").groupBy("shard").applyInArrow(_merge_words(folder, shards), ", ".join(f"{f} bigint" for f in FIGURES))
    sums = done.agg(F.count(F.lit(1)).alias("n"), *(F.sum(f).alias(f) for f in FIGURES)).first()
    figures = {f: int(sums[f] or 0) for f in FIGURES}
    return Model(folder, shards if sums["n"] else 0, figures)


def _scorer(model: Model):
    figures, folder, shards = model.figures, model.folder, model.shards
    d = np.array(discounts(figures["p1"], figures["p2"], figures["p3"], figures["p4"]))
    e = np.array(discounts(figures["k1"], figures["k2"], figures["k3"], figures["k4"]))
    size, k_sum = figures["types"] + 1, max(1, figures["k_sum"])
    g0 = (e[1] * figures["k1"] + e[2] * figures["k2"] + e[3] * figures["k3_up"]) / k_sum if figures["k_sum"] else 1.0

    def score(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        word_store, pair_store = (arrays.Shards(folder, kind, shards) for kind in ("word", "pair"))
        for column in columns:
            tokens_of, known_of, base_of, score_of = [], [], [], []
            for _, token, bounds in token_runs(pa.array(column, pa.string(), from_pandas=True)):
                before = contexts(token, bounds)
                names, local = np.unique(np.concatenate([token, before]), return_inverse=True)
                n_names = len(names)
                zeros = [np.zeros(n_names, np.int64)] * 5
                count, k, n1, n2, n3 = word_store.rows(names, ["count", "k", "n1", "n2", "n3"]) if shards else zeros
                # each distinct pair once
                own, prior = local[: len(token)], local[len(token) :]
                pairs, back = np.unique((prior.astype(np.uint64) << np.uint64(32)) | own.astype(np.uint64), return_inverse=True)
                left, right = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
                key = pair_hash(names[left], names[right])
                order = np.argsort(key)
                seen = np.zeros(len(key), np.int64)
                if shards:
                    seen[order] = pair_store.rows(key[order], ["count"])[0]
                q = np.maximum(k - e[np.minimum(k, 3)], 0.0) / k_sum + g0 / size
                # what follows a word is as often as the word itself, but for the start, which each text has once
                total = np.where(names == _START, count[np.searchsorted(names, _END)], count).astype(np.float64)
                total[names == _END] = 0
                gamma = np.divide(d[1] * n1 + d[2] * n2 + d[3] * n3, total, out=np.ones(n_names), where=total > 0)
                gamma[total == 0] = 1.0
                p = gamma[left] * q[right] + np.divide(np.maximum(seen - d[np.minimum(seen, 3)], 0.0), total[left], out=np.zeros(len(seen)), where=total[left] > 0)
                log_p = np.log10(p)[back]
                base = np.log10((count + 1.0) / (figures["tokens"] + size))[own]
                firsts = bounds[:-1]
                tokens_of.append(np.diff(bounds))
                known_of.append(np.add.reduceat((count > 0)[own].astype(np.int64), firsts))
                base_of.append(np.add.reduceat(base, firsts))
                score_of.append(np.add.reduceat(log_p, firsts))
            parts = (tokens_of, known_of, base_of, score_of)
            kinds = (np.int64, np.int64, np.float64, np.float64)
            yield pd.DataFrame({n: np.concatenate(x) if x else np.zeros(0, t) for n, x, t in zip(("n_tokens", "n_known", "base_score", "score"), parts, kinds, strict=True)})

    return F.pandas_udf(score, "n_tokens bigint, n_known bigint, base_score double, score double")


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Append n_tokens, n_known, train_tokens, base_score, score (log10 probabilities) and perplexity.

    Columns of those names are replaced; all others are kept.
    """
    held = bitmaps.unused(docs.columns, "_lm")
    scored = docs.withColumn(held, _scorer(model)(F.coalesce(F.col(text), F.lit(""))))
    for name in ("n_tokens", "n_known", "base_score", "score"):
        scored = scored.withColumn(name, F.col(held)[name])
    scored = scored.drop(held).withColumn("train_tokens", F.lit(model.figures["tokens"]).cast("bigint"))
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def remainder(key: str | Column, modulus: int) -> Column:
    """crc32 of a key as text, modulo a number; of an empty text for a null key."""
    return F.crc32(F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit(""))) % modulus
