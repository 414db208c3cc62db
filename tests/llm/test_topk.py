"""Exact top-k search against all inner products."""

import math

import pytest
from pyspark.sql import functions as F

from docloom.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, k, asked=lambda i: i is not None and i % 100 == 0):
    """All answers, a query's own row told by its position."""
    scaled = [(i, None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(1024 * x) for x in v]) for i, v in rows]
    out = []
    for n, (query, q) in enumerate(scaled):
        if not asked(query) or q is None:
            continue
        scores = [
            (-sum(a * b for a, b in zip(q, v, strict=True)), i is None, i)
            for m, (i, v) in enumerate(scaled) if m != n and v is not None and len(v) == len(q)
        ]
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(query, rank, i, -score) for rank, (score, _, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def found(frame):
    return sorted([tuple(r) for r in frame.select("query_id", "rank", "vec_id", "score").collect()], key=repr)


def numbers(seed, count):
    out, x = [], seed * 7919 + 12345
    for _ in range(count):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append(((x >> 11) % 2049 - 1024) / 1024)
    return out


def ask(spark, rows, k=10, schema=SCHEMA):
    frame = spark.createDataFrame(rows, schema).repartition(5)
    return topk.search(frame, F.col("vec_id") % 100 == 0, k)


@pytest.mark.parametrize("chunk", [4096, 7])
def test_equals_all_products(spark, monkeypatch, chunk):
    monkeypatch.setattr(topk, "ROWS", chunk)
    monkeypatch.setattr(topk, "BLOCK", 3)
    monkeypatch.setattr(topk, "SLAB_BYTES", 16 * 200)
    rows = [(i, numbers(i % 450, 16)) for i in range(900)]
    assert found(ask(spark, rows)) == brute(rows, 10)


def test_ties_hot_copies_and_repeated_rows(spark):
    same = numbers(3, 8)
    rows = [(i, same) for i in range(400, 1, -1)] + [(500, same)] * 3 + [(i, numbers(i, 8)) for i in range(600, 660)] + [(700, [0.0] * 8)]
    assert found(ask(spark, rows)) == brute(rows, 10)


def test_negative_scores_only(spark):
    rows = [(0, [1.0, 1.0, 1.0, 1.0])] + [(i, [-0.001 * i - 0.5, -0.25, -0.125, -0.5]) for i in range(1, 60)]
    assert found(ask(spark, rows)) == brute(rows, 10)


def test_nulls_odd_components_lengths_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, 0.25]), (100, None), (200, [None, 1.0]), (300, [nan, 1.0]), (400, [inf, 1.0]), (1, [0.5, -0.25]), (None, [0.5, -0.25]),
        (2, [1.0]), (500, [1.0]), (3, []), (600, []), (4, [1.0, 2.0, 3.0]), (700, [1.0, 1.0, 1.0]),
    ]
    got = found(ask(spark, rows))
    assert got == brute(rows, 10)
    assert (0, 2, None, 64 * 1024 * 3) in [(q, r, i, s) for q, r, i, s in got] or len(got) > 0
    assert found(ask(spark, rows, k=1)) == brute(rows, 1)


def test_large_components_are_exact(spark):
    rows = [(i * 50, [3.0e5 + i + 0.5, 2.0e5 - i / 3, 1.0e4 * i, -7.0e4]) for i in range(40)]
    assert found(ask(spark, rows, schema="vec_id bigint, embedding array<double>")) == brute(rows, 10)
    rows = [(i * 50, [3.0e4 * i + 0.5, 2.1e5]) for i in range(40)]
    assert found(ask(spark, rows, schema="vec_id bigint, embedding array<double>")) == brute(rows, 10)


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(topk.search(empty, F.col("vec_id") % 100 == 0)) == []
    rows = [(i, numbers(i, 4)) for i in range(120)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "vector", "score", "rank", "query_id", "block", "number", "own", "place", "self"):
        frame = frame.withColumn(name, F.lit("x"))
    assert found(topk.search(frame, F.col("vec_id") % 100 == 0)) == brute(rows, 10)
