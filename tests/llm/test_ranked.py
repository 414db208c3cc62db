"""Ranked lexical search against a plain version."""

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import ranked
from tests.llm import helpers

UPPER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items, k=50):
    held = [(i, terms(t)) for i, t in docs]
    n_docs, n_words = sum(1 for _, t in held if t), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for doc, t in held:
            if not t:
                continue
            m = 50 + (50 * len(t) * n_docs) // n_words
            score = 0
            for term in set(terms(text)):
                tf = t.count(term)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1))) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


def search(spark, docs, items, k=50):
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    found = ranked.search(frame, spark.createDataFrame(items, "item_id bigint, text string"), k)
    return sorted([tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()], key=repr)


def test_packed_bags_round_trip():
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.integers(0, 1 << int(b), 50) for b in range(1, 60, 4)])
    data, sizes = ranked.pack(values)
    assert sizes.sum() == len(data) and (ranked.unpack(data) == values).all()
    row, term, tf = np.array([0, 0, 2, 2, 2]), np.array([5, 70_000, 0, 1, 1 << 33]), np.array([1, 300, 2, 1, 1])
    bags = ranked.pack_bags(row, term, tf, 4)
    for got, want in zip(ranked.unpack_bags(bags), (row, term, tf), strict=True):
        assert (got == want).all()
    cut = ranked.unpack_bags(pa.array(bags.to_pylist()).slice(2, 2))
    assert (cut[0] == 0).all() and (cut[1] == term[2:]).all()


@pytest.mark.parametrize("small", [False, True])
def test_equals_plain_version(spark, monkeypatch, small):
    if small:
        # several item blocks, class slabs, chunks and vocabulary shards
        for name, value in (("BLOCK", 3), ("SLAB_BYTES", 500), ("CLASSES", 5), ("SHARD", 16)):
            monkeypatch.setattr(ranked, name, value)
    vocabulary = helpers.words_of(5, 60) + ["Zebra", "naïve", "日本語", "x1"]
    docs = [(i * 3 % 301, " ".join(vocabulary[(i * i + j * j * 7) % (20 + i % 44)] for j in range(i % 23)) + ("!" if i % 2 else "")) for i in range(301)]
    items = [(j, ", ".join(vocabulary[(j * 5 + t * t) % 64] for t in range(j % 9)).upper()) for j in range(11)]
    assert search(spark, docs, items) == brute(docs, items)
    assert search(spark, docs, items, k=3) == brute(docs, items, 3)


def test_classes_of_copies_and_ties(spark):
    docs = [(i, "red fox") for i in range(400, 0, -1)] + [(i, "RED  fox?") for i in range(500, 520)] + [(600, "red dog"), (601, "fox red red")] + [(0, "filler words only")] * 30
    items = [(1, "fox"), (1, "fox"), (None, "dog cat"), (2, "filler"), (3, "nowhere")]
    assert search(spark, docs, items) == brute(docs, items)


def test_nulls_repeats_and_long_texts(spark):
    docs = [(None, "apple pie"), (None, "apple tart"), (1, None), (2, ""), (3, "...!"), (4, "apple"), (4, "apple"), (5, "apple " * 40_000 + "pie"), (6, "y" * 100_000 + " pie")]
    docs += [(10 + i, "other thing") for i in range(20)]
    items = [(1, "Apple, pie!"), (2, None), (3, ""), (4, "y" * 100_000)]
    assert search(spark, docs, items) == brute(docs, items)


def test_empty_tables_and_other_columns(spark):
    docs, items = [(1, "a b"), (2, "c"), (3, "d")], [(1, "a")]
    assert search(spark, [], items) == [] and search(spark, docs, []) == [] and search(spark, [(1, None)], items) == []
    frame, wanted = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for name in ("n", "bag", "m", "item", "rank", "score", "hash", "doc_ids"):
        frame, wanted = frame.withColumn(name, F.lit("x")), wanted.withColumn(name, F.lit(7))
    assert sorted(tuple(r) for r in ranked.search(frame, wanted).collect()) == brute(docs, items)
