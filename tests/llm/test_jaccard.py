import random

import numpy as np
import pytest

from docloom.llm import components, jaccard
from tests.llm.helpers import documents, shingles, words_of


def brute(texts, ids, size, percent):
    """Smallest id reachable by links."""
    sets = [shingles(t, size) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, key in enumerate(ids):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [(ids[i], len(sets[i]), least.get(root(i), ids[i])) for i in range(len(texts))]


def near_copies(seed, groups=6, each=30):
    r = random.Random(seed)
    out = []
    for g in range(groups):
        base = words_of(g + 10 * seed, r.choice([6, 30, 120]))
        shared = words_of(99, 20)
        for _ in range(each):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                own[r.randrange(len(own))] = f"x{r.randrange(9)}"
            out.append(" ".join(own + (shared if r.random() < 0.3 else [])))
    return out


@pytest.mark.parametrize("cell", [3000, 25])
def test_components_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(jaccard, "CELL", cell)
    texts = near_copies(cell) + ["", None, " \n", "one", "one", "One", "a b c", "a b c d", "the same line of words", "the same line of words"]
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    ids[-1] = ids[-2]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(documents(spark, texts, ids)).collect())
    assert got == sorted(brute(texts, ids, jaccard.SHINGLE, jaccard.PERCENT))


def test_null_ids_empty_table_and_clashing_columns(spark):
    rows = documents(spark, ["a b c d e", "a b c d e", "q"], [None, 7, None]).withColumnRenamed("lang", "set_id").withColumnRenamed("n_chars", "n")
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.join(rows).collect()}
    assert got == {(None, 7), (7, 7), (None, None)}
    assert jaccard.join(documents(spark, [])).count() == 0


def test_regions_join_exactly():
    r = np.random.default_rng(5)
    base = [np.unique(r.integers(0, 1 << 48, 60).astype(np.uint64)) for _ in range(12)]
    sets = []
    for i in range(400):
        own = base[i % 12].copy()
        change = r.integers(0, 12)
        own[r.choice(len(own), change, replace=False)] = r.integers(0, 1 << 48, change).astype(np.uint64)
        sets.append(np.unique(own))
    join = jaccard._Join(sets, 85)
    join.region(np.arange(len(sets)))
    plain = jaccard._Join(sets, 85)
    for i in range(len(sets) - 1):
        plain.link(i, np.arange(i + 1, len(sets)))
    assert [join.root(i) for i in range(400)] == [plain.root(i) for i in range(400)]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 150)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in range(100, 150)}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
