import hashlib

import pytest

from docloom.llm import fingerprints as fp
from tests.llm.helpers import documents, shingles, words_of

TEXTS = [" ".join(words_of(1, 300)), " ".join(words_of(1, 300)[:280] + words_of(2, 20)), "", None, "one", "one two three four five", " \t\n", "é😀 " * 50, " ".join(words_of(3, 3000))]


def edited(texts):
    """Texts by descending id with their edited form and their next text."""
    order = list(range(len(texts)))[::-1]
    plain = [texts[i] or "" for i in order]
    for k, i in enumerate(order):
        after = plain[(k + 1) % len(plain)]
        cut = len(plain[k]) // 3
        yield i, plain[k], plain[k][: len(plain[k]) - cut] + after[:cut], after


@pytest.mark.parametrize("parts", ["1", "4"])
def test_edited_and_likeness(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    rows = {r["doc_id"]: r for r in fp.with_edited(documents(spark, TEXTS)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(rows) == len(TEXTS)
    for i, text, changed, after in edited(TEXTS):
        row = rows[i]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        a, b, c = (shingles(x, 5) for x in (text, changed, after))
        exact = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        close = 1e-9 if max(map(len, (a, b, c))) < fp.K else 0.1
        assert abs(row["near_edited"] - exact(a, b)) <= close
        assert abs(row["near_next"] - exact(a, c)) <= close
    assert rows[2]["fingerprint"] == rows[3]["fingerprint"] == rows[6]["fingerprint"] == ""


def test_one_row_and_no_row(spark):
    alone = fp.with_edited(documents(spark, ["a b c d e f g h i"])).first()
    assert alone["near_next"] == 1.0
    assert fp.with_edited(documents(spark, [])).count() == 0


def test_equal_ids_and_null_ids_keep_their_rows(spark):
    out = fp.with_edited(documents(spark, ["a b", "a b", "c d", "e f"], [5, 5, None, 1])).collect()
    assert sorted(map(str, (r["doc_id"] for r in out))) == ["1", "5", "5", "None"]


def test_merge_is_the_sketch_of_the_union(spark):
    a, b = (fp.sketches(__import__("pyarrow").array([" ".join(words_of(s, 900))]))[0] for s in (4, 5))
    parts = spark.createDataFrame([("x", fp.pack(a)), ("x", fp.pack(b)), ("y", None), (None, fp.pack(a))], "k string, fingerprint string")
    got = {r["k"]: r["fingerprint"] for r in fp.merge_fingerprints(parts, ["k"]).collect()}
    assert got == {"x": fp.pack(fp.merge([a, b])), "y": "", None: fp.pack(a)}


def test_estimates():
    one = fp.sketches(__import__("pyarrow").array([" ".join(words_of(6, 4000))]))[0]
    half = fp.sketches(__import__("pyarrow").array([" ".join(words_of(6, 4000)[:2000])]))[0]
    assert abs(fp.distinct_count(one) / 3996 - 1) < 0.2
    assert abs(fp.containment(half, one) - 1) < 0.2
    assert abs(fp.resemblance(one, half) - 0.5) < 0.12
    assert fp.unpack(fp.pack(one)).tolist() == one.tolist()


def test_extra_columns_stay(spark):
    rows = documents(spark, ["a b c"]).withColumnRenamed("lang", "fingerprint_kind")
    assert "fingerprint_kind" in fp.add_fingerprint(rows).columns
