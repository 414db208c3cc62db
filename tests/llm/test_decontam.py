import random

import numpy as np

from docloom.llm import decontam
from tests.llm.helpers import documents, words_of


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_bit_vector_lcs_equals_the_table():
    r = random.Random(2)
    for _ in range(200):
        a, b = ([r.randrange(8) for _ in range(r.randrange(1, 70))] for _ in range(2))
        held = {}
        for i, w in enumerate(a):
            held[w] = held.get(w, 0) | (1 << i)
        assert decontam.lcs_length(held, len(a), b) == lcs(a, b)


def planted():
    """Items, documents and the pairs planted: whole, with other punctuation, with words changed, dropped and added."""
    r = random.Random(8)
    items = [" ".join(words_of(1000 + i, 20 + i)).capitalize() + "." for i in range(20)]
    common = ["the", "of", "and", "to", "in", "is", "that", "for"]
    docs, pairs = [], set()
    for d in range(200):
        body = [w if r.random() < 0.6 else r.choice(common) for w in words_of(d, 150)]
        if d % 5 == 0:
            i = (d // 5) % 20
            own = items[i].lower().strip(".").split()
            kind = (d // 5) % 4
            if kind == 1:
                own = [w + "," if k % 4 == 0 else w.upper() for k, w in enumerate(own)]
            elif kind == 2:
                own = [w for k, w in enumerate(own) if k % 7 != 3]
            elif kind == 3:
                own = [x for k, w in enumerate(own) for x in ((w, "added") if k % 6 == 2 else (w,))]
            at = r.randrange(len(body))
            body[at:at] = own
            pairs.add((d, i))
        docs.append(" ".join(body))
    return items, docs, pairs


def test_finds_what_is_planted_and_nothing_else(spark):
    items, docs, pairs = planted()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = decontam.find(documents(spark, docs), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == pairs
    for r in got:
        assert r["lcs_words"] <= r["item_words"] and r["cosine"] >= decontam.COSINE


def test_recall_against_brute_force(spark):
    """Of the pairs whose longest common subsequence in any stretch of the document suffices, at least nine tenths are found."""
    items, docs, _ = planted()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.find(documents(spark, docs), bench).collect()}
    want = set()
    for d, text in enumerate(docs[::5]):
        own = decontam.tokens(text).tolist()
        for i, item in enumerate(items):
            asked = decontam.tokens(item).tolist()
            size = len(asked)
            if max(lcs(asked, own[k : k + 2 * size]) for k in range(0, len(own), size // 2)) >= decontam.LCS * size:
                want.add((5 * d, i))
    assert want and len(want & got) >= 0.9 * len(want)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK", 6)
    items, docs, pairs = planted()
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.find(documents(spark, docs), bench).collect()} == pairs


def test_defined_cases(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "too short"), (None, " ".join(words_of(5, 12)))], "item_id bigint, text string")
    text = " ".join(words_of(5, 12))
    rows = documents(spark, [None, "", text, text, "x " * 50000], [1, 2, 3, 3, None]).withColumnRenamed("lang", "item_id")
    assert decontam.find(rows, none).count() == 0
    assert sorted((r["doc_id"], r["item_id"]) for r in decontam.find(rows, odd).collect()) == [(3, None), (3, None)]
    assert decontam.find(documents(spark, []), odd).count() == 0


def test_latent_space_keeps_item_cosines(spark):
    items, docs, _ = planted()
    texts = documents(spark, docs).select("text")
    weight, count = decontam._weights(texts)
    assert count == len(docs)
    space = decontam.latent_space(texts, items, weight)
    vectors = decontam.Items(list(enumerate(items)), weight, space).vectors
    apart = vectors @ vectors.T - np.eye(len(items))
    assert np.abs(apart).max() < 0.6


def test_latent_space_is_fitted_on_every_document(spark, monkeypatch):
    items, docs, _ = planted()
    given, fit = [], decontam.latent_space
    monkeypatch.setattr(decontam, "FIT_DOCUMENTS", 5, raising=False)
    monkeypatch.setattr(decontam, "latent_space", lambda texts, *rest: (given.append(texts.count()), fit(texts, *rest))[1])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    decontam.find(documents(spark, docs), bench)
    assert given == [len(docs)]


def test_latent_space_strengths_are_those_of_the_passages(spark):
    """Along its directions the passages of all texts are about equally strong, as a whitened space has it."""
    _, docs, _ = planted()
    texts = documents(spark, docs).select("text")
    weight, _ = decontam._weights(texts)
    space = decontam.latent_space(texts, [], weight).astype(np.float64)
    square = np.zeros((decontam.RANK, decontam.RANK))
    for text in docs:
        own = decontam.tokens(text)
        at, value, starts = decontam._passages(own, np.array([0, len(own)]), weight)
        there = np.add.reduceat((space / np.maximum(weight, 1e-9)[:, None])[at] * value[:, None], starts, axis=0)
        square += there.T @ there
    strong = np.diag(square)
    assert strong.max() < 4 * strong.min()


def test_items_of_any_length_in_long_documents(spark, monkeypatch):
    """Of 400 items of 1 to 400 words, whole or with every fourth word dropped, each is found in its long document."""
    monkeypatch.setattr(decontam, "BLOCK", 150)
    r = random.Random(11)
    sizes = [1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 40, 60, 90, 130, 200, 300, 400]
    items = [" ".join(words_of(50_000 + i, sizes[i % len(sizes)])) for i in range(400)]
    docs = []
    for i, item in enumerate(items):
        own, body = item.split(), words_of(i, 1500)
        at = r.randrange(len(body))
        body[at:at] = own if i % 40 < 20 else [w for k, w in enumerate(own) if k % 4 != 3]
        docs.append(" ".join(body))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(row["doc_id"], row["item_id"]) for row in decontam.find(documents(spark, docs), bench).collect()}
    assert [i for i in range(400) if (i, i) not in got] == []
    assert all(len(items[j].split()) < 6 for i, j in got if i != j)
