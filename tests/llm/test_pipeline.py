import public_tokenizers
import pytest
from pyspark.sql import functions as F
import sentencepiece

import __spark_entry__ as entry
import corpus_pipeline
from docloom.llm import decontam, queries
from tests.compare import compare, duck
from tests.llm.helpers import DOCS, documents, save_tables, words_of
from tests.llm.test_decontam import lcs
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_lines import brute as repeated
from tests.llm.test_scoring import junk

SF_DIR = "/root/testdata/sf0.001"


def clean(i):
    return "\n".join(". ".join(" ".join(words_of(1000 * i + k, 24)[j : j + 8]).capitalize() for j in range(0, 24, 8)) + "." for k in range(4))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clean documents, junk, copies, near copies, repeated lines and benchmark passages."""
    items = [(i, " ".join(words_of(70_000 + i, 25)).capitalize() + ".") for i in range(5)]
    texts = [junk(i) if i % 6 == 5 else clean(i) for i in range(120)]
    for k in (1, 7, 13):
        texts[k + 40] = texts[k]  # whole copies
        texts[k + 60] = texts[k].rsplit("\n", 1)[0] + "\n" + clean(500 + k)  # repeated lines
    for k in range(5):
        own = clean(900 + k).split("\n")
        own[2] += " " + items[k][1]
        texts[12 * k] = "\n".join(own)
    long = words_of(4242, 300)
    texts[2], texts[3] = " ".join(f"{w}." if j % 9 == 8 else w for j, w in enumerate(long)), ""
    texts[4] = " ".join(f"{w}," if j % 9 == 8 else w for j, w in enumerate([*long[:5], "changed", *long[6:]]))
    labels = [(i, int(i % 6 != 5), 0) for i in range(120) if i % 7]
    folder = tmp_path_factory.mktemp("tables")
    return save_tables(folder, spark, documents(spark, texts), labels, items), texts, items


def brute(texts, items):
    """Documents that stay and their texts, stage by stage; junk is what the fixture made so."""
    docs = {i: t for i, t in enumerate(texts) if i % 6 != 5 or i in (65,) and not t == junk(65)}
    gone = repeated(list(docs.items()))
    left = {}
    for i, t in docs.items():
        kept = "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone)
        if kept or not any(g[0] == i for g in gone):
            left[i] = kept
    same = {i: c for i, _, c in groups(list(left.values()), list(left), corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)}
    left = {i: t for i, t in left.items() if same[i] == i}
    asked = [decontam.tokens(t).tolist() for _, t in items]
    out = {}
    for i, t in left.items():
        own = decontam.tokens(t).tolist()
        if not any(max((lcs(a, own[k : k + 2 * len(a)]) for k in range(0, len(own), len(a) // 2)), default=0) >= decontam.LCS * len(a) for a in asked):
            out[i] = t
    return out


def test_pipeline_equals_brute_force(spark, tables):
    folder, texts, items = tables
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    want = brute(texts, items)
    assert set(got) == set(want)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for i, text in want.items():
        assert got[i]["text"] == text and got[i]["n_chars"] == len(text)
        assert got[i]["ids"] == library.encode(text) and got[i]["round_trip"]


def test_stages_keep_columns_and_take_odd_rows(spark, tables):
    folder = tables[0]
    line = "one two three four five six seven eight nine ten."
    rows = documents(spark, [None, "", line, line, line, "a " * 40000], [1, 2, 3, 3, None, 9]).selectExpr("*", "'x' AS score", "1 AS set_id")
    for name in ("_n", "_map", "_hit", "_bits", "_doc", "_gone", "_removed", "_lines", "_score", "_kept", "entry", "row", "number"):
        rows = rows.withColumn(name, F.lit(name))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, folder)
        assert out.columns == rows.columns
        out.collect()
        assert stage(spark, rows.limit(0), folder).count() == 0
    assert corpus_pipeline.encode(spark, rows, folder).count() == 6


def test_pipeline_of_no_documents(spark, tmp_path):
    folder = save_tables(tmp_path, spark, spark.createDataFrame([], DOCS))
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_stage_names():
    assert len(corpus_pipeline.STAGES) == 5 and entry.queries()["pipeline"] is corpus_pipeline.run


SCHEMAS = {
    "op2": ["doc_id", "n_bytes", "n_tokens", "ids"], "op3": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op4": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"], "op5": ["page_id", "url", "text", "n_chars"],
    "op6": ["doc_id", "n_bytes", "n_tokens", "over_limit"], "op7": ["doc_id", "held_out", "score", "predicted"], "op8": ["doc_id", "n_shingles", "component_id"],
    "op10": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op11": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"], "op12": ["query_id", "rank", "vec_id", "score"],
    "op13": ["item_id", "rank", "doc_id", "score"],
}
#: Queries that return matches, not a row for each row of their table.
SEARCHES = ("op1", "op12", "op13")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_covers_its_table(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR).toPandas()
    if name.split("_")[0] not in SEARCHES:
        key = "page_id" if "page_id" in rows else "doc_id"
        table = spark.read.parquet(f"{SF_DIR}/{'pages' if key == 'page_id' else 'documents'}.parquet")
        assert sorted(rows[key]) == sorted(r[0] for r in table.select(key).collect())
    assert set(SCHEMAS.get(name.split("_")[0], [])) <= set(rows.columns)


def test_queries_with_sql(spark):
    sql = {k: v for k, v in entry.oracle_sql().items() if k.startswith("op")}
    assert sql
    for name, text in sql.items():
        ok, note = compare(spark, queries.QUERIES[name], text, SF_DIR, duck(SF_DIR))
        assert ok, (name, note)
