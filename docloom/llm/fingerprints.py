"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A fingerprint is the base64 text of the ``k`` smallest distinct 48-bit hashes of a text's shingles, ascending, six bytes
each.  Sketches of parts merge into the sketch of the union; two sketches estimate resemblance and containment, and one
estimates the number of distinct shingles.  A sketch with fewer than ``k`` hashes is the whole set, so its figures are
exact.

Defined cases: a null text is an empty text; an empty text, or one of white space only, has the empty fingerprint; a text
of fewer words than a shingle has one shingle, its whole sequence; equal texts have equal fingerprints; two empty
fingerprints resemble each other by 1, an empty and another by 0.  Repeated rows each give a row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words

K = 256
SHINGLE = 5
_BYTES = 6
_TOP = 1 << (8 * _BYTES)


def pack(hashes: np.ndarray) -> str:
    """Ascending 48-bit hashes as text."""
    return base64.b64encode(np.ascontiguousarray(hashes, ">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def unpack(fingerprint: str | None) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint or ""), np.uint8).reshape(-1, _BYTES)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").reshape(-1).astype(np.uint64)


def sketches(texts: pa.Array, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    """The bottom-k hashes of every text."""
    out: list[np.ndarray] = []
    for block in words.word_blocks(texts):
        hashes, bounds = words.shingle_hashes(block.words, block.bounds, shingle)
        hashes >>= np.uint64(64 - 8 * _BYTES)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            out.append(np.unique(hashes[a:b])[:k])
    return out


def merge(parts: list[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of a union from the sketches of its parts."""
    return np.unique(np.concatenate(parts))[:k] if parts else np.zeros(0, np.uint64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity: the share of the union's smallest ``k`` hashes that both sketches hold."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    same = np.flatnonzero(both[1:] == both[:-1])
    size = min(len(both) - len(same), k if len(a) >= k or len(b) >= k else len(both))
    # the i-th repeated hash is distinct value number (position - i) of the union
    return int((same - np.arange(len(same)) < size).sum()) / size


def distinct_count(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * _TOP / (float(a[k - 1]) + 1.0)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of ``a``'s shingles that ``b`` has."""
    if not len(a):
        return 1.0
    j = resemblance(a, b, k)
    union = (distinct_count(a, k) + distinct_count(b, k)) / (1.0 + j)
    return min(1.0, j * union / max(distinct_count(a, k), 1.0))


def add_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Append the fingerprint of a text column; every other column, whatever its name, is kept."""

    @F.pandas_udf("string")
    def fingerprint(column):
        import pandas as pd

        return pd.Series([pack(x) for x in sketches(pa.array(column, pa.string(), from_pandas=True), k, shingle)], dtype=object)

    return docs.withColumn(name, fingerprint(F.col(text)))


def merge_fingerprints(parts: DataFrame, keys: list[str], name: str = "fingerprint", k: int = K) -> DataFrame:
    """One fingerprint per key from those of its parts.

    Each task first merges what it holds, so a key that owns most parts reaches its final group as one sketch per task.
    Null keys form one group.
    """
    kept = parts.select(*keys, F.coalesce(F.col(name), F.lit("")).alias(name))
    schema = kept.schema

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def flush():
            if not held:
                return None
            columns = list(zip(*held, strict=True))
            arrays = [pa.array(c, arrow[i].type) for i, c in enumerate(columns)] + [pa.array([pack(v) for v in held.values()], pa.string())]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        arrow = None
        for batch in batches:
            arrow = arrow or batch.schema
            for *key, sketch in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = tuple(key)
                held[key] = merge([held[key], unpack(sketch)], k) if key in held else unpack(sketch)
            if len(held) > 20_000 and (out := flush()) is not None:
                yield out
        if (out := flush()) is not None:
            yield out

    def final(table: pa.Table) -> pa.Table:
        merged = pack(merge([unpack(x) for x in table.column(name).to_pylist()], k))
        return table.slice(0, 1).set_column(table.schema.get_field_index(name), name, pa.array([merged], pa.string()))

    return kept.mapInArrow(partial, schema).groupBy(*keys).applyInArrow(final, schema)


def _range_bucket(value: Column, cuts: list[int]) -> Column:
    """Number of cut points below a value, found in two steps so that many cut points stay cheap."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    array = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    nested = F.transform(F.split(F.lit(";".join(",".join(map(str, g)) for g in groups)), ";"), lambda s: F.split(s, ",").cast("array<bigint>"))
    group = F.size(F.filter(array([g[-1] for g in groups]), lambda c: c < value))
    inner = F.size(F.filter(F.coalesce(F.get(nested, group), F.array().cast("array<bigint>")), lambda c: c < value))
    return F.least(group * step + inner, F.lit(len(cuts)))


def with_edited(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprints of each whole text, of its edited text, and their likeness.

    The edited text replaces the last floor(n / 3) code points by the first as many (or all) of the next document in
    descending doc_id; after the last comes the first.  Documents are dealt out by ranges of doc_id, each range with a
    copy of the first document of the range below, so every text moves once.  Rows with equal doc_id stand in the order of
    their text hashes; a null doc_id comes last.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63) + 1))
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), order.alias("_order"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / parts for i in range(1, parts)]
    ids = docs.select(order.alias("_order"))
    cuts = sorted(set(ids.agg(F.percentile_approx("_order", shares, 10 * parts)).first()[0] or [])) if shares else []
    rows = rows.withColumn("_bucket", _range_bucket(F.col("_order"), cuts))
    # one row per range: its largest id
    heads = {r[0]: r[1] for r in ids.groupBy(_range_bucket(F.col("_order"), cuts).alias("b")).agg(F.max("_order")).collect()}
    used = sorted(heads)
    above = {b: used[(i + 1) % len(used)] for i, b in enumerate(used)}
    target = F.split(F.lit(",".join(str(above.get(b, 0)) for b in range(len(cuts) + 1))), ",").cast("array<int>")
    is_head = F.col("_order").isin(list(heads.values())) if heads else F.lit(False)
    places = F.when(
        is_head,
        F.array(F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("copy")), F.struct(F.get(target, F.col("_bucket")).alias("b"), F.lit(1).alias("copy"))),
    ).otherwise(F.array(F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("copy"))))
    dealt = rows.select("doc_id", "text", "_order", F.explode(places).alias("_to")).select("doc_id", "text", "_order", "_to.b", "_to.copy")
    dealt = dealt.repartition(parts, "b").sortWithinPartitions("b", "copy", F.desc("_order"), F.xxhash64("text"))
    output = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, distinct_shingles double"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("distinct_shingles", pa.float64())])

        def chunks():
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    yield batch.slice(at, 256)

        held = None  # (doc_id, text, sketch, bucket) that waits for its next document
        for batch in chunks():
            own = sketches(batch.column(1), k, shingle)
            ready = []  # (doc_id, text, sketch, next text, next sketch)
            for doc_id, text, bucket, copy, sketch in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), own, strict=True):
                if held is not None and held[3] == bucket:
                    ready.append((*held[:3], text, sketch))
                held = None if copy else (doc_id, text, sketch, bucket)
            if not ready:
                continue
            edited = []
            for _, text, _, after, _ in ready:
                cut = len(text) // 3
                edited.append(text[: len(text) - cut] + after[:cut])
            changed = sketches(pa.array(edited, pa.string()), k, shingle)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in ready], pa.int64()),
                    pa.array([len(r[1]) for r in ready], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited]),
                    pa.array([pack(r[2]) for r in ready]),
                    pa.array([pack(x) for x in changed]),
                    pa.array([resemblance(r[2], x, k) for r, x in zip(ready, changed, strict=True)], pa.float64()),
                    pa.array([resemblance(r[2], r[4], k) for r in ready], pa.float64()),
                    pa.array([distinct_count(r[2], k) for r in ready], pa.float64()),
                ],
                schema=schema,
            )

    return dealt.mapInArrow(work, output)
