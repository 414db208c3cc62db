"""The Merkle manifest against a recursive version."""

import hashlib

from pyspark.sql import functions as F

from docloom.llm import manifest
from tests.llm import helpers


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def prove(tree, i):
    proof = []
    for level in tree[:-1]:
        first = i - i % 3
        proof.append((level[first:i], level[i + 1 : first + 3]))
        i //= 3
    return proof


def fold(digest, proof):
    for before, behind in proof:
        digest = sha(*before, digest, *behind)
    return digest


def brute(rows, tamper=lambda r: r["text"]):
    """Rows as (source, doc_id, leaf, subroot, root, proof digest, folded root)."""
    trees = {}
    for r in rows:
        trees.setdefault(r["source"], []).append((r["doc_id"], leaf(r, r["text"]), leaf(r, tamper(r))))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        trees[s].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    whole = {s: levels([t[1] for t in trees[s]]) for s in names}
    top = levels([whole[s][-1][0] for s in names])
    out = []
    for j, s in enumerate(names):
        for i, (doc_id, own, claim) in enumerate(trees[s]):
            proof = prove(whole[s], i) + prove(top, j)
            text = sha(*(d for before, behind in proof for d in before + behind))
            out.append((s, doc_id, own, whole[s][-1][0], top[-1][0], text, fold(claim, proof)))
    return out


def found(audit):
    return [(r["source"], r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in audit.collect()]


def order(rows):
    return sorted(rows, key=repr)


def test_positions_follow_completion():
    for leaves in range(1, 100):
        log = manifest.append_nodes([f"{i}" for i in range(leaves)], manifest.height(leaves))
        tree = levels([f"{i}" for i in range(leaves)])
        assert len(log) == sum(map(len, tree))
        for level, nodes in enumerate(tree):
            assert [log[manifest.position(level, i, leaves)] for i in range(len(nodes))] == nodes


def rows_of(spark, rows):
    return spark.createDataFrame(rows, helpers.DOCS)


def many(count):
    texts = [None, "", "a\nb", "x" * 50, "naïve Ünï\n", "long " * 5000]
    sources = ["hot"] * 12 + [None, "", "=", "b", "Ä"]
    return [(i * 7 % count, texts[i % 6], "en" if i % 5 else None, sources[i * 5 % 17], None if i % 4 == 0 else i) for i in range(count)]


def test_equals_recursion_over_tiers(spark, monkeypatch):
    # blocks of nine leaves: the hot source has three tiers
    monkeypatch.setattr(manifest, "LEVELS", 2)
    docs = rows_of(spark, many(700))
    tamper = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    written = manifest.append(docs.repartition(7), {"text": tamper})
    assert len(written.tiers) == 3

    def changed(r):
        return r["text"].replace("\n", "") if r["text"] and helpers.crc(r["doc_id"]) % 2 == 0 else r["text"]

    audit = manifest.audit(written, keep_proof=True).cache()
    want = brute([r.asDict() for r in docs.collect()], changed)
    assert order(found(audit)) == order(want)
    assert {r["verified"] for r in audit.collect()} == {True, False}
    for r in audit.collect():
        assert manifest.fold(r["leaf"], ",".join(r["proof"])) == written.root
    log = {(r["tree"], r["position"]): r["digest"] for r in written.log().collect()}
    for r in audit.where("source = 'hot'").collect():
        assert log["=hot", manifest.completed(r["ordinal"])] == r["leaf"]
    some = manifest.audit(written, sources=["b", None])
    assert order(found(some)) == order([w for w in want if w[0] in ("b", None)])


def test_nulls_ties_repeated_rows_and_other_columns(spark):
    rows = [(None, "a", "en", None, 1), (None, "b", "en", None, 1), (3, "a", None, "s", None), (3, "c", None, "s", None)] + [(5, "t", "en", "s", 1)] * 9
    docs = rows_of(spark, rows).withColumn("leaf", F.lit("x")).withColumn("tree", F.lit("y")).withColumn("ordinal", F.lit(-1))
    audit = manifest.audit(manifest.append(docs))
    assert order(found(audit)) == order(brute([r.asDict() for r in docs.collect()]))
    assert audit.where("not verified").count() == 0


def test_single_row_and_empty_table(spark):
    docs = rows_of(spark, [(4, "only", "en", "s", 4)])
    [row] = manifest.audit(manifest.append(docs)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha() and row["verified"]
    written = manifest.append(docs.where("doc_id < 0"))
    assert written.root is None and manifest.audit(written).count() == 0


def test_whole_null_columns(spark):
    docs = spark.range(4).selectExpr("cast(null as bigint) doc_id", "cast(null as string) text", "cast(null as string) lang", "cast(null as string) source", "cast(null as bigint) n_chars")
    audit = manifest.audit(manifest.append(docs)).collect()
    assert {r["leaf"] for r in audit} == {sha("-----")} and all(r["verified"] for r in audit)
