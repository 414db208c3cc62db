import collections
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docloom.llm import arrays, lm, quality
from tests.llm.helpers import ascii_words, documents, words_of


def corpus():
    return ["The cat sat on the mat", "the cat ate", "", None, "the dog sat on the cat", "the cat sat on the mat", " ".join(words_of(1, 400)), " ".join(words_of(1, 300)), "\t \n"]


def brute(train, texts):
    docs = [ascii_words(t) + [None] for t in train]
    c = collections.Counter(w for d in docs for w in d)
    pairs = collections.Counter(p for d in docs for p in zip([0, *d], d))
    k, ctx = collections.Counter(b for _, b in pairs), collections.defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), n in pairs.items():
        ctx[a][min(n, 3)] += 1
        ctx[a][0] += n
    cn, kn = collections.Counter(pairs.values()), collections.Counter(k.values())
    d, e = lm.discounts(*(cn[i] for i in (1, 2, 3, 4))), lm.discounts(*(kn[i] for i in (1, 2, 3, 4)))
    total, size, ks = sum(c.values()), len(c) + 1, sum(k.values())
    g0 = (e[1] * kn[1] + e[2] * kn[2] + e[3] * sum(v for i, v in kn.items() if i >= 3)) / ks

    def q(w):
        return max(k[w] - e[min(k[w], 3)], 0) / ks + g0 / size

    def p(a, b):
        t = ctx.get(a)
        if t is None:
            return q(b)
        n = pairs.get((a, b), 0)
        return max(n - d[min(n, 3)], 0) / t[0] + (d[1] * t[1] + d[2] * t[2] + d[3] * t[3]) / t[0] * q(b)

    assert abs(sum(p(b"the", w) for w in c) + p(b"the", b"never seen") - 1) < 1e-9
    for text in texts:
        own = ascii_words(text) + [None]
        yield len(own), sum(c[w] > 0 for w in own), total, sum(math.log10((c[w] + 1) / (total + size)) for w in own), sum(math.log10(p(a, w)) for a, w in zip([0, *own], own))


@pytest.mark.parametrize("chunk", [1_000_000, 5])
def test_scores_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(lm, "CHUNK", chunk)
    texts = corpus() + ["unknown words only", "the unknown cat"]
    model = lm.train(documents(spark, corpus()))
    got = {r["doc_id"]: r for r in lm.score(documents(spark, texts), model).collect()}
    for i, want in enumerate(brute(corpus(), texts)):
        row = got[i]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == want[:3]
        assert row["base_score"] == pytest.approx(want[3], abs=1e-9) and row["score"] == pytest.approx(want[4], abs=1e-9)


def test_no_training_rows_and_no_rows(spark):
    model = lm.train(documents(spark, []))
    row = lm.score(documents(spark, ["a b"]), model).first()
    assert row["n_known"] == 0 and row["train_tokens"] == 0 and row["score"] == 0
    assert lm.score(documents(spark, []), model).count() == 0


def test_frequent_counts_overflow_a_byte(spark):
    model = lm.train(documents(spark, ["a b " * 1000]))
    row = lm.score(documents(spark, ["a b"]), model).first()
    want = next(brute(["a b " * 1000], ["a b"]))
    assert row["score"] == pytest.approx(want[4], abs=1e-9)


@pytest.mark.parametrize("shards", [2, 3, 51, 64])
def test_hash_arrays_find_all_and_only_theirs(tmp_path, shards):
    r = np.random.default_rng(shards)
    keys = np.unique(r.integers(0, 1 << 64, 30000, dtype=np.uint64))
    edges = np.searchsorted(arrays.shard_of(keys, shards), np.arange(shards + 1))
    for s in range(shards):
        own = keys[edges[s] : edges[s + 1]]
        arrays.write_arrays(f"file://{tmp_path}", f"x-{s:06d}", arrays.index(own, s, shards) | arrays.small("v", (own % np.uint64(1000)).astype(np.int64) + 1))
    asked = np.unique(np.concatenate([keys[::7], r.integers(0, 1 << 64, 5000, dtype=np.uint64)]))
    got = arrays.Shards(str(tmp_path), "x", shards).rows(asked, ["v"])[0]
    want = np.where(np.isin(asked, keys), (asked % np.uint64(1000)).astype(np.int64) + 1, 0)
    assert (got == want).all()


def junk(i):
    w = words_of(i, 60)
    return [" ".join(x.upper() + "!!" for x in w), " ".join(x + "***" for x in w), " | ".join(w), " ".join(w[:3] * 20)][i % 4]


def test_quality_held_out(spark):
    texts = [junk(i) if i % 5 == 0 else ". ".join(" ".join(words_of(i, 40)[k : k + 8]).capitalize() for k in range(0, 40, 8)) + "." for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(0, 400, 1) if i % 3], "doc_id bigint, quality int")
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in quality.score(docs, quality.train(docs, labels)).collect()}
    held = [i for i in range(400) if i % 3 == 0]
    right = sum(got[i]["predicted"] == int(i % 5 != 0) for i in held)
    assert right / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_quality_defined_cases(spark):
    docs = documents(spark, [None, "", "a", "b c " * 30000])
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.score(docs, quality.train(docs, none)).collect()} == {1.0}
    one = spark.createDataFrame([(2, 0), (3, None)], "doc_id bigint, quality int")
    assert {r["predicted"] for r in quality.score(docs, quality.train(docs, one)).collect()} == {0}
    both = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (3, 0)], "doc_id bigint, quality int")
    rows = quality.score(docs.withColumnRenamed("lang", "statistics"), quality.train(docs, both)).collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(documents(spark, []), quality.train(docs, both)).count() == 0


def test_scores_keep_columns_of_any_name(spark):
    docs = documents(spark, corpus())
    for name in ("_lm", "_lm_", "k", "statistics", "label"):
        docs = docs.withColumn(name, F.lit(name))
    scored = lm.score(docs, lm.train(docs))
    assert all(r["_lm"] == "_lm" and r["_lm_"] == "_lm_" for r in scored.collect())
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id bigint, quality int")
    rows = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(rows) == 9 and all(r["k"] == "k" and r["label"] == "label" for r in rows)


def plain_statistics(text):
    """Some of the statistics, word by word."""
    own = ascii_words(text)
    n, sizes = len(own), [len(w) for w in own]
    mean = (sum(sizes) + 10 * 5.5) / (n + 10)
    spread = math.sqrt(max((sum(x * x for x in sizes) + 10 * (5.5**2 + 9)) / (n + 10) - mean * mean, 0))
    same = sum(a == b for a, b in zip(own, own[1:]))
    return [math.log1p(n), math.log((same + 0.2) / (n + 5)), math.log((len(set(own)) + 12) / (n + 12)), math.log((len(set(zip(own, own[1:]))) + 12) / (max(n - 1, 0) + 12)), math.log(mean), math.log(spread)]


def test_quality_equals_plain_discriminant(spark):
    texts = [junk(i) if i % 3 == 0 else " ".join(words_of(i, 10 + i % 50)).capitalize() + "." for i in range(240)] + ["", "word word word", None]
    x = quality.statistics(pa.array(texts, pa.string()))
    for row, text in zip(x, texts, strict=True):
        assert row[[0, 6, 7, 8, 9, 10]] == pytest.approx(plain_statistics(text), abs=1e-9)
    docs, label = documents(spark, texts), np.array([int(i % 3 != 0) for i in range(len(texts))])
    model = quality.train(docs, spark.createDataFrame([(i, int(v)) for i, v in enumerate(label)], "doc_id bigint, quality int"))
    n = np.bincount(label)
    mean = [x[label == c].mean(0) for c in (0, 1)]
    cov = [np.cov(x[label == c].T, bias=True) for c in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    density = []
    for c in (0, 1):
        s = (1 - quality.SHRINK_DIAGONAL - quality.SHRINK_POOLED) * cov[c] + quality.SHRINK_DIAGONAL * np.diag(np.diag(cov[c])) + quality.SHRINK_POOLED * pooled
        s += np.diag(1e-4 + 1e-3 * np.diag(pooled))
        z = x - mean[c]
        density.append(np.log(n[c] / n.sum()) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * (z * np.linalg.solve(s, z.T).T).sum(1))
    want = density[1] - density[0]
    assert model.difference(x) == pytest.approx(want, rel=1e-6, abs=1e-6)
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    squashed = np.sign(want) * np.log1p(np.abs(want))
    chance = 1 / (1 + np.exp(-np.clip(model.scale * squashed + model.shift, -30, 30)))
    assert [scored[i] for i in range(len(texts))] == pytest.approx(list(chance), abs=1e-6)
