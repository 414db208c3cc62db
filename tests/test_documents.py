"""Denormalised rows, summaries, enrichments, formats, the store and the workflow."""

import dataclasses
import json
import string

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions import text
from docloom.functions.assembly import dense_ordinal, ordered_array, ordered_concat, row_positions
from docloom.operators import denorm, enrichment, parts, store, summaries, tables, workflow
from docloom.sources import formats


def canonical(spark, *documents):
    """Rows of the stored schema from partial dictionaries."""
    return spark.read.schema(schemas.CANONICAL).json(spark.sparkContext.parallelize([json.dumps(d) for d in documents]))


FIXTURE = {
    "document_id": "plan-6", "document_type": "site plan", "mime_type": "application/pdf", "metadata": json.dumps({"language": "en", "provider": "p"}),
    "text_spans": [{"content": "North wall 4B", "confidence": 0.9, "page": 1, "bounding_box": [0, 0, 210, 55]}],
    "tables": [{"table_id": "rooms", "confidence": 0.8, "cells": [{"row_index": 0, "column_index": 0, "content": "Boiler room", "page": 1, "bounding_box": [12, 9, 47, 31], "row_span": 1, "column_span": 1}]}],
    "fields": [{"name": "Area", "value": "86.25", "confidence": 0.9, "value_type": "area", "page": 1, "bounding_box": [3, 40, 33, 52]}],
    "visual_descriptions": [], "page_segments": [], "enrichments": [{"enrichment_type": "keywords", "provider": "x", "content": "{}", "confidence": 0.5}],
    "summaries": [{"summary": "Two rooms, one door.", "confidence": 0.7, "method": "m", "title": "Plan of the north wing"}],
    "attachments": [{"attachment_id": "1", "file_name": "legend.txt", "mime_type": "text/plain"}],
}


def rows_of(spark, *documents):
    docs = canonical(spark, *documents)
    attached = docs.select("document_id", F.posexplode("attachments").alias("ord", "_a")).select("document_id", F.col("ord").cast("long").alias("ord"), "_a.*")
    tree = parts.part_tree(docs.where("document_id NOT LIKE '%::%'"), attached)
    return denorm.denormalise(denorm.tables_of(docs, tree))


def test_denormalised_fixture(spark):
    levels = rows_of(spark, FIXTURE)
    docs = {r.part_id: r for r in levels["doc"].collect()}
    assert docs[None].doc_title == "Plan of the north wing" and docs[None].status == "succeeded" and docs[None].doc_language == "en"
    assert (docs[None].total_pages, docs[None].total_blocks, docs[None].doc_summary) == (1, 3, "Two rooms, one door.")
    assert (docs["root.attachment-1"].status, docs["root.attachment-1"].doc_title, docs["root.attachment-1"].doc_type) == ("partial", "legend.txt", "text/plain")
    page = levels["page"].collect()[0]
    assert (page.width, page.height, page.page_text, page.source_mime, page.engine_id) == (210.0, 55.0, "North wall 4B Boiler room Area: 86.25", "application/pdf", "p")
    blocks = {b.block_type: b for b in levels["block"].collect()}
    assert set(blocks) == {"paragraph", "table", "kv_pair"}
    assert (blocks["table"].block_id, blocks["table"].table_rows, blocks["table"].bbox_w) == ("rooms", 1, 35.0)
    assert blocks["paragraph"].block_id == "root-span-1" and blocks["kv_pair"].text == "Area: 86.25"
    insights = levels["insight"].collect()
    assert sorted(i.insight_kind for i in insights) == ["extraction", "extraction", "summary"]
    assert [i.value_number for i in insights if i.field] == [86.25]
    assert denorm.all_rows(levels).count() == 9


def test_nested_attachments(spark):
    child = {**FIXTURE, "document_id": "plan-6::1", "summaries": [], "attachments": [{"attachment_id": "1", "file_name": "deep.txt", "mime_type": "text/plain", "child_document_id": "plan-6::1::1"}]}
    deep = {**FIXTURE, "document_id": "plan-6::1::1", "summaries": [], "attachments": [], "metadata": "{}", "enrichments": []}
    root = {**FIXTURE, "attachments": [{"attachment_id": "9", "file_name": "mid.pdf", "mime_type": "application/pdf", "child_document_id": "plan-6::1"}]}
    levels = rows_of(spark, root, child, deep)
    docs = {r.part_id: r for r in levels["doc"].collect()}
    assert set(docs) == {None, "root.attachment-1", "root.attachment-1.attachment-1"}
    assert docs["root.attachment-1"].doc_title == "mid.pdf" and {d.bundle_id for d in docs.values()} == {"plan-6"}
    blocks = levels["block"].where("part_id = 'root.attachment-1.attachment-1' AND block_type = 'kv_pair'").collect()
    assert [b.block_id for b in blocks] == ["root.attachment-1.attachment-1-field-1"]
    # every page block count adds up to the blocks of its part
    pages = {(r.part_id): r.n for r in levels["page"].groupBy("part_id").agg(F.sum("page_block_count").alias("n")).collect()}
    assert pages == {k: 3 for k in docs}


def test_chain_of_attachments(spark):
    chain = spark.createDataFrame([(f"n{i}", 0, f"f{i}", "text/plain", f"n{i + 1}") for i in range(7)], "document_id string, ord long, file_name string, mime_type string, child_document_id string")
    root = spark.createDataFrame([("n0",)], "document_id string")
    assert sorted(r.depth for r in parts.part_tree(root, chain).collect()) == list(range(8))
    assert parts.part_tree(root, chain, max_depth=7).count() == 8
    with pytest.raises(ValueError):
        parts.part_tree(root, chain, max_depth=4)
    loop = chain.union(spark.createDataFrame([("n7", 0, "x", "y", "n3")], chain.schema))
    with pytest.raises(ValueError):
        parts.part_tree(root, loop)


def test_bad_payloads_do_not_end_the_job(spark):
    rows = [("cr", b"a,b\rc,d\r", "text/csv"), ("charset", b"From: a@b\nContent-Type: text/plain; charset=no-such\n\nhello", "message/rfc822"), ("fine", b"x,y\n1,2\n", "text/csv")]
    docs = spark.createDataFrame(rows, "document_id string, content binary, mime_type string")
    cells = formats.csv_cells(docs.where("mime_type = 'text/csv'"))
    assert sorted((r.document_id, r.row_index, r.content) for r in cells.collect()) == [("cr", 0, "a"), ("cr", 0, "b"), ("cr", 1, "c"), ("cr", 1, "d"), ("fine", 0, "x"), ("fine", 0, "y"), ("fine", 1, "1"), ("fine", 1, "2")]
    assert formats.email_documents(docs.where("document_id = 'charset'")).collect()[0].body == "hello"
    assert formats.unreadable(docs).count() == 0


def test_versions_of_a_document_stay_apart(spark, tmp_path):
    rows = [("d", "s", b"a,b\n1,2\n", "text/csv", "{}"), ("d", "s", b"x,y\n8,9\n", "text/csv", "{}"), ("d", "s", b"plain words", "text/plain", "{}")]
    docs = spark.createDataFrame(rows, "document_id string, source_uri string, content binary, mime_type string, metadata string")
    done = workflow.process(docs.limit(2), str(tmp_path / "store"), batch="one")
    assert sorted("".join(c.content for c in r.tables[0].cells) for r in done.documents.collect()) == ["ab12", "xy89"]
    assert {r.bundle_id for r in done.rows["doc"].collect()} == {"d"} and done.failures.count() == 0
    later = workflow.process(docs, str(tmp_path / "store"), batch="two")
    assert [r.text_spans[0].content for r in later.documents.collect()] == ["plain words"]
    assert workflow.read_store(spark, str(tmp_path / "store")).count() == 3
    with pytest.raises(ValueError):
        workflow.process(docs, str(tmp_path / "store"), batch="two")


def test_levels_from_rows_written_once(spark, tmp_path):
    docs = canonical(spark, {**FIXTURE, "attachments": []})
    tree = parts.part_tree(docs, docs.select("document_id").where("false").selectExpr("document_id", "0L AS ord", "'' AS file_name", "'' AS mime_type", "'' AS child_document_id"))
    found, stamp = denorm.tables_of(docs, tree), F.to_timestamp(F.lit("2024-01-01"))
    planned, written = denorm.denormalise(found, stamp), denorm.denormalise(found, stamp, str(tmp_path))
    for name, rows in planned.items():
        assert written[name].columns == rows.columns and written[name].collect() == rows.collect()
    # the tables are folded for the written blocks alone
    plan = written["doc"]._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and (tmp_path / "blocks").exists()


def test_levels_written_by_shares(spark, tmp_path, monkeypatch):
    """Shares of the bundles give the rows of one piece, also where keys are null or a part has two documents."""
    docs = canonical(spark, *[{**FIXTURE, "document_id": f"doc-{k}", "attachments": []} for k in range(9)])
    tree = parts.part_tree(docs, docs.select("document_id").where("false").selectExpr("document_id", "0L AS ord", "'' AS file_name", "'' AS mime_type", "'' AS child_document_id"))
    found, stamp = denorm.tables_of(docs, tree), F.to_timestamp(F.lit("2024-01-01"))
    twice = found.documents.union(found.documents.where("document_id = 'doc-3'").withColumn("mime_type", F.lit("other/type")))
    nobody = [rows.unionByName(rows.where("bundle_id = 'doc-4'").withColumn("bundle_id", F.lit(None).cast("string"))) for rows in (twice, found.spans, found.segments)]
    found = dataclasses.replace(found, documents=nobody[0], spans=nobody[1], segments=nobody[2])
    monkeypatch.setattr(denorm, "_SHARE_BYTES", 1)
    freed = []
    monkeypatch.setattr(denorm, "release_shuffles", freed.append)
    planned, written = denorm.denormalise(found, stamp), denorm.denormalise(found, stamp, str(tmp_path))
    assert len(freed) == 2 * denorm._SHARES and len(list((tmp_path / "pages").iterdir())) == denorm._SHARES
    for name, rows in planned.items():
        assert written[name].columns == rows.columns
        assert sorted(map(str, written[name].collect())) == sorted(map(str, rows.collect())), name


def test_cells_in_any_order_fold_from_one_narrow_shuffle(spark):
    """Cells of 20 tables over many batches, positions repeated: keys and extents go through the shuffle once for neighbours."""
    cells = spark.range(60_000).select(
        F.concat(F.lit("t"), F.col("id") % 60_000 % 20).alias("key"), F.expr("cast(id div 20 % 1500 as int)").alias("row_index"), F.expr("cast(hash(id) % 3 as int)").alias("column_index"),
        F.expr("hash(id, 1) * 100000L + id").alias("cell_ord"), F.expr("if(id % 7 = 0, '', concat('c', id))").alias("content"),
    ).repartition(5)
    rows = tables.table_lines(cells, ["key"])
    best, want = {}, {}
    for c in cells.collect():
        at = (c.key, c.row_index, c.column_index)
        best[at] = max(best.get(at, (-(1 << 62), "")), (c.cell_ord, c.content))
    for (key, row, _), (_, content) in sorted(best.items()):
        want.setdefault(key, {}).setdefault(row, []).extend([content] if content else [])
    got = {r.key: r.lines for r in rows.collect()}
    assert got == {k: [" | ".join(v) for _, v in sorted(lines.items())] for k, lines in want.items()}
    assert rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") <= 2


def test_table_text_and_segments(spark):
    cells = [
        {"row_index": 1, "column_index": 1, "content": "old", "row_span": 1, "column_span": 2}, {"row_index": 0, "column_index": 0, "content": "", "row_span": 1, "column_span": 1, "page": 0},
        {"row_index": 1, "column_index": 1, "content": "new", "row_span": 2, "column_span": 1, "page": 3}, {"row_index": 1, "column_index": 0, "content": "a", "row_span": 1, "column_span": 1, "page": 2},
    ]
    doc = {**FIXTURE, "text_spans": [], "fields": [], "attachments": [], "tables": [{"confidence": 1.0, "cells": cells}, {"confidence": 1.0, "cells": []}]}
    empty = {**doc, "document_id": "doc-2", "tables": [], "page_segments": [{"page_number": 2}, {"page_number": 2}, {"page_number": 1}]}
    levels = rows_of(spark, doc, empty)
    tables = {b.block_id: b for b in levels["block"].collect()}
    first = tables["root-table-1"]
    assert (first.text, first.lines, first.table_rows, first.table_cols, first.page_number) == ("\na | new", ["", "a | new"], 3, 3, 3)
    assert (tables["root-table-2"].text, tables["root-table-2"].lines, tables["root-table-2"].table_rows) == ("", None, 0)
    pages = sorted((p.page_number, p.page_block_count, p.page_text) for p in levels["page"].where("bundle_id = 'doc-2'").collect())
    assert pages == [(1, 0, None), (2, 0, None)]


def test_ordered_helpers_equal_plain_ones(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        ((F.col("id") * 7919) % 20011).alias("ord"), F.when(F.col("id") % 5 > 0, F.col("id").cast("string")).alias("t"),
    )

    ranked = dense_ordinal(rows, ["k"], "ord", "n", chunk=64).withColumn("want", F.row_number().over(Window.partitionBy("k").orderBy("ord")) - 1)
    assert ranked.where("n <> want").count() == 0 and ranked.count() == 20000
    total = dense_ordinal(rows, [], "ord", "n", chunk=16).withColumn("want", F.row_number().over(Window.orderBy("ord")) - 1)
    assert total.where("n <> want").count() == 0
    joined = ordered_concat(rows, ["k"], "ord", "t", ",", "s", chunk=100)
    plain = rows.groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "t"))), lambda x: x["t"]), ",").alias("w"))
    assert joined.join(plain, "k").where("s <> w").count() == 0 and joined.count() == 41
    arrays = ordered_array(rows, ["k"], "ord", F.col("t"), "a", chunk=100).select("k", F.array_join("a", ",").alias("s"))
    assert arrays.join(plain, "k").where("s <> w").count() == 0


def test_row_positions_equal_row_number(spark):
    values = [None, -5.5, 0.0, 1e300, 2.0] + [7.25] * 400 + [i / 3 for i in range(300)]
    rows = spark.createDataFrame([(i % 7 if i % 50 else None, v, f"t{i * 31 % 997}") for i, v in enumerate(values)], "k long, v double, t string").repartition(5)
    for keys in ([], ["k"]):
        window = Window.partitionBy(*keys).orderBy(F.col("v").asc_nulls_first(), "t")
        got = row_positions(rows, ["v"], "n", keys, tie_breakers=["t"]).withColumn("want", F.row_number().over(window) - 1)
        assert got.count() == len(values) and got.where("n <> want").count() == 0
    # repeated rows, text order, sparse numbers, no rows
    same = spark.createDataFrame([("b", 1 << 60)] * 300 + [("a", -(1 << 60))], "s string, o long")
    assert sorted(r.n for r in row_positions(same, ["s"], "n").collect()) == list(range(301))
    assert row_positions(same, ["o"], "n").where("s = 'a'").first().n == 0
    assert row_positions(same.where("s = 'z'"), ["s"], "n").count() == 0


def test_provider_slices(spark):
    docs = spark.createDataFrame([(f"d{i}", i * i * 1_000_003, "x") for i in range(25)], "document_id string, o long, text string").repartition(4)

    def answer(frame):
        import pandas as pd

        if "d3" in set(frame["document_id"]):
            raise ValueError("down")
        return pd.DataFrame({"document_id": frame["document_id"], "raw_response": [",".join(frame["document_id"])] * len(frame)})

    provider = enrichment.Provider("p", batch=answer, max_batch_size=4)
    rows = {r.document_id: r for r in enrichment.call_provider(docs, provider, "o").collect()}
    assert len(rows) == 25 and all(rows[f"d{i}"].error == "ValueError: down" for i in range(4))
    assert rows["d5"].raw_response == "d4,d5,d6,d7" and rows["d24"].raw_response == "d24"
    calls = {r.raw_response for r in enrichment.call_provider(docs.coalesce(1), provider).collect() if r.raw_response}
    assert sorted(len(c.split(",")) for c in calls)[1:] == [4] * (len(calls) - 1)



def test_heuristic_summary(spark):
    docs = spark.createDataFrame([("a", ["This is the first sentence. And a second one! Third.", "x"]), ("b", ["  "]), ("c", ["word " * 300, "Short title"])], "document_id string, contents array<string>")
    got = {r.document_id: r.summary for r in summaries.heuristic_summaries(docs).collect()}
    assert set(got) == {"a", "c"}
    assert got["a"].summary == "This is the first sentence. And a second one!" and got["a"].confidence == 0.3
    assert got["a"].method == "heuristic_leading_sentences" and got["a"].title == "This is the first sentence. And a second one! Third."
    assert len(got["c"].summary) <= 512 and got["c"].summary.endswith("word") and got["c"].title == "Short title"


def test_model_summary(spark):
    good = {"summary": " S ", "title": "T", "confidence": 0.85, "justification": "j", "metadata": {"tone": "x"}}
    responses = [
        {"choices": [{"message": {"content": json.dumps(good)}}]}, {"choices": [{"message": {"content": [{"text": '{"summary": "p'}, {"text": 'arts"}'}]}}]},
        {"choices": [{"content": '{"summary": "c", "reasoning": "r", "confidence": "bad"}'}]}, {"choices": []}, {"choices": [{"message": {"content": '{"summary": "  "}'}}]},
    ]
    rows = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(responses)], "i int, r string")
    got = {x.i: x.s for x in rows.select("i", summaries.model_summary(F.col("r"), F.lit("gpt")).alias("s")).collect()}
    assert (got[0].summary, got[0].title, got[0].model, got[0].confidence, json.loads(got[0].metadata)) == ("S", "T", "gpt", 0.85, {"tone": "x"})
    assert got[1].summary == "parts" and got[1].confidence == 0.7
    assert (got[2].summary, got[2].justification, got[2].confidence) == ("c", "r", 0.7)
    assert got[3] is None and got[4] is None


def test_provider_batches_and_failures(spark):
    docs = spark.createDataFrame([(f"doc-{i}",) for i in range(3)], "document_id string").coalesce(1)

    def run(frame):
        if len(frame) == 1:
            raise RuntimeError("down")
        return pd.DataFrame({"document_id": frame["document_id"], "enrichments": [json.dumps([{"type": "n", "content": {"size": len(frame)}}])] * len(frame)})

    provider = enrichment.Provider("p", batch=run, max_batch_size=2)
    responses = {r.document_id: r for r in enrichment.call_provider(docs, provider).collect()}
    assert responses["doc-2"].error == "RuntimeError: down" and responses["doc-0"].error is None
    merged = {r.document_id: r.enrichments for r in enrichment.merge_enrichments(docs, enrichment.dispatch(docs, [provider], ["p", "none"])).collect()}
    assert [json.loads(e.content) for e in merged["doc-0"]] == [{"size": 2}] and merged["doc-2"] == []
    with pytest.raises(ValueError):
        enrichment.dispatch(docs, [provider], ["none"])


def test_text_content_is_no_enrichment(spark):
    responses = spark.createDataFrame(
        [("d", '[{"type": null, "content": "text"}, {"enrichment_type": 5, "type": "t"}, {"type": "ok"}]', None, None, '{"a": 1}', None)], enrichment.RESPONSE
    )
    rows = enrichment.normalise_responses(responses, "p").collect()
    assert [r.enrichment_type for r in rows] == ["ok"] and json.loads(rows[0].metadata) == {"response_metadata": '{"a": 1}'}


def test_csv_reader(spark):
    rows = spark.createDataFrame([("d", b"Name,Value\nAlice,10\nBob,20\n"), ("q", b'a,"b\nc ""x"""\n'), ("e", b"")], "document_id string, content binary")
    cells = formats.csv_cells(rows)
    got = {(c.document_id, c.row_index, c.column_index): c.content for c in cells.collect()}
    assert got["d", 0, 0] == "Name" and {"Alice", "Bob", "10", "20"} <= set(got.values()) and got["q", 0, 1] == 'b\nc "x"'
    facts = {r.document_id: (r.paragraph, r.row_count) for r in formats.csv_summaries(rows).collect()}
    assert facts == {"d": ("Name, Value", 3), "q": ('a, b\nc "x"', 1), "e": ("", 1)}


def test_html_only_email(spark):
    raw = b"Subject: s\nContent-Type: multipart/alternative; boundary=b\n\n--b\nContent-Type: text/html\n\n<p>Hello <b>you</b></p>\n--b--\n"
    row = formats.email_documents(spark.createDataFrame([("d", raw)], "document_id string, content binary")).collect()[0]
    assert (row.body, row.subject, row.sender, row.attachment_names) == ("Hello you", "s", None, [])


def _nested_email():
    from email.message import EmailMessage

    inner = EmailMessage()
    inner["Subject"] = "inner"
    inner.set_content("inner body")
    inner.add_attachment(b"%PDF-1", maintype="application", subtype="pdf", filename="deep.pdf")
    outer = EmailMessage()
    outer["Subject"] = "outer"
    outer.set_content("outer body")
    outer.add_attachment(inner)
    outer.add_attachment("note text", filename="n.txt")
    return outer.as_bytes()


def test_nested_email_lists_files_flat(spark):
    frame = spark.createDataFrame([("mail", "s3://m", _nested_email())], "document_id string, source_uri string, content binary")
    got = sorted((p.file_name, p.walk_index, p.part_id, p.child_document_id, p.source_uri) for p in formats.email_parts(frame).collect())
    assert got == [
        ("deep.pdf", 5, "root.attachment-1", "mail::attachment-6", "s3://m#attachment/deep.pdf"),
        ("n.txt", 6, "root.attachment-2", "mail::attachment-7", "s3://m#attachment/n.txt"),
    ]


RAW = "document_id string, source_uri string, content binary, mime_type string, metadata string, force boolean"


def test_workflow_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "store")
    mail = b"From: a@b\nSubject: Hi\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary=x\n\n--x\nContent-Type: text/plain\n\nFirst one. Second one. Third.\n--x\nContent-Type: text/plain\nContent-Disposition: attachment; filename=note.txt\n\nhello\n--x--\n"
    rows = [
        ("email-doc", "s3://m", mail, "message/rfc822", '{"mime_type": "message/rfc822"}', False), ("csv", "s3://c", b"A,B\n1,2\n", "text/csv", "{}", False),
        ("txt", "s3://t", b"  some \n words ", "text/plain", '{"request_id": "r-9"}', False), ("txt", "s3://t", b"  some \n words ", "text/plain", "{}", False),
    ]
    docs = spark.createDataFrame(rows, RAW)
    done = workflow.process(docs, path, force="force", providers=[enrichment.sorted_keyword_provider()], enrich_with=["keyword_insights"], batch="batch-0")
    stored = {r.document_id: r for r in done.documents.collect()}
    assert set(stored) == {"email-doc", "csv", "txt", "email-doc::attachment-3"}
    assert stored["email-doc"].summaries[0].summary == "First one. Second one." and stored["txt"].text_spans[0].content == "some words"
    assert [c.content for c in stored["csv"].tables[0].cells] == ["A", "B", "1", "2"] and stored["csv"].fields[0].value == "2"
    assert [(a.file_name, a.child_document_id) for a in stored["email-doc"].attachments] == [("note.txt", "email-doc::attachment-3")]
    assert all(len(r.enrichments) == 1 for r in stored.values())
    docs_rows = {(r.bundle_id, r.part_id): r for r in done.rows["doc"].collect()}
    assert ("email-doc", "root.attachment-1") in docs_rows and docs_rows["txt", None].request_id in ("r-9", "txt")
    assert {r.part_id for r in done.rows["block"].where("bundle_id = 'email-doc'").collect()} == {None, "root.attachment-1"}
    assert done.rows["insight"].where("insight_kind = 'summary'").count() == 4
    again = workflow.process(docs, path, force="force", batch="batch-1")
    assert again.documents.count() == 0 and again.rows["doc"].count() == 0
    forced = workflow.process(docs.where("document_id = 'csv'").withColumn("force", F.lit(True)), path, force="force", batch="batch-2")
    assert forced.documents.count() == 1
    # repeating a batch replaces it instead of skipping its own rows
    repeated = workflow.process(docs, path, force="force", batch="batch-0", replace=True)
    assert {r.document_id for r in repeated.documents.collect()} == {"email-doc", "txt", "email-doc::attachment-3"}


def test_new_payloads(spark):
    docs = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", "2"), ("b", "1")], "document_id string, checksum string")
    seen = spark.createDataFrame([("a", "2")], "document_id string, checksum string")
    assert sorted(tuple(r) for r in store.new_payloads(docs, seen).collect()) == [("a", "1"), ("b", "1")]


def test_readers_hold_few_payloads(monkeypatch):
    monkeypatch.setattr(formats, "SLICE_BYTES", 100)
    mail = b"From: a@b\nContent-Type: text/plain\n\nbody"
    data = [b"a,b\n" * 20, None, mail, b"x" * 300, b"c\nd", mail, b"", mail]
    asked = pa.array([{"reader": "email" if d == mail else "csv", "parts": False, "data": d} for d in data], pa.struct([("reader", pa.string()), ("parts", pa.bool_()), ("data", pa.binary())]))
    small = list(formats._read(iter([asked, asked.slice(0, 0), asked.slice(2, 4)])))
    texts = list(formats._texts(iter([pa.array(data, pa.binary())])))
    assert len(small) > 5 and len(texts) > 2
    monkeypatch.setattr(formats, "SLICE_BYTES", 1 << 30)
    whole = list(formats._read(iter([asked, asked.slice(2, 4)])))
    assert [r for part in small for r in part.to_pylist()] == [r for part in whole for r in part.to_pylist()]
    assert [t for part in texts for t in part.to_pylist()] == next(formats._texts(iter([pa.array(data, pa.binary())]))).to_pylist()


def test_native_answers_are_worked_out_once(spark):
    docs = spark.createDataFrame([("a", "Alphabet soup, alphabet. Gardens")], "document_id string, text string")
    rows = enrichment.dispatch(docs, [enrichment.sorted_keyword_provider(limit=6)], ["keyword_insights"])
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
    assert json.loads(rows.first().content) == {"keywords": ["alphabet", "gardens"], "token_count": 4}


def test_calls_leave_together(spark, monkeypatch):
    monkeypatch.setattr(enrichment, "HELD_CALLS", 3)

    def run(frame):
        if "d5" in set(frame["document_id"]):
            raise ValueError("no")
        return pd.DataFrame({"document_id": frame["document_id"], "duration_ms": len(frame)}) if "d8" not in set(frame["document_id"]) else None

    docs = spark.range(0, 21, 1, 1).select(F.concat(F.lit("d"), "id").alias("document_id"))
    made = enrichment.call_provider(docs, enrichment.Provider("p", batch=run, max_batch_size=2))
    got = {r.document_id: (r.duration_ms, r.error) for r in made.collect()}
    assert got["d5"] == got["d4"] == (None, "ValueError: no") and "d8" not in got and len(got) == 19 and got["d0"] == (2, None) and got["d20"] == (1, None)


def test_leading_keywords_and_summary_read_a_text_as_far_as_they_must(spark):
    head = text.HEAD
    texts = [
        "", "  ", "(alphas) betas gammas, GAMMAS deltas zetazeta etaeta thetas", "x " * head + "lonely words behind headers always counted", "a" * (head + 50) + " second longer tokens follow behind",
        "y" * (head - 8) + " cutting across borders", "one two. Three four! Five six? seven", " . Lead. Next. Last.", "No end", "Only one. ",
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(len(texts), None)], "i int, t string")
    found = text.sentences("t")
    rows = docs.select("i", text.leading_keywords("t").alias("k"), F.slice(found, 1, 2).alias("all"), F.slice(text.sentences("t", 2), 1, 2).alias("first"), F.size(text.sentences("t", 2)).alias("n"))
    for r in rows.orderBy("i").collect():
        assert r["all"] == r["first"]
        if r.i == len(texts):
            assert r.k is None
            continue
        bare = [w.strip(string.punctuation) for w in texts[r.i].split()]
        assert r.k == list(dict.fromkeys(w.lower() for w in bare if len(w) >= 6))[:5]
        assert r.n <= 3


def test_payloads_are_joined_and_texts_worked_out_once(spark):
    def plan(rows):
        return rows._jdf.queryExecution().optimizedPlan().toString()

    docs = spark.createDataFrame([(f"d{i}", f"c{i}", f"u{i % 3}") for i in range(6)], "document_id string, checksum string, source_uri string")
    docs = docs.withColumn("content", F.encode("source_uri", "UTF-8"))
    stored = spark.createDataFrame([("d0", "c0")], "document_id string, checksum string")
    batch = docs.unionByName(docs).unionByName(docs.withColumn("source_uri", F.lit("other")))
    kept = store.pending(batch, stored)
    assert plan(kept).count("Join ") == 1
    assert sorted(r.document_id for r in kept.collect()) == ["d1", "d2", "d3", "d4", "d5"]
    texts = spark.createDataFrame([(" a \n b ",), (" \n",), ("One two. Three?  Four. Five",), ("x" * 300 + " " + "y" * 300,), (None,)], "t string")
    read = texts.select(formats.text_paragraph(F.encode("t", "UTF-8")).alias("p"), summaries.summary_text(F.col("t")).alias("s"))
    assert plan(texts.select(formats.text_paragraph(F.encode("t", "UTF-8")).alias("p"))).count("regexp_replace(") == 1
    assert plan(texts.select(summaries.summary_text(F.col("t")).alias("s"))).count("split(") == 1
    empty = formats.EMPTY_DOCUMENT
    assert [tuple(r) for r in read.collect()] == [
        ("a b", "a \n b"), (empty, None), ("One two. Three? Four. Five", "One two. Three?"), ("x" * 300 + " " + "y" * 300, "x" * 300), (empty, None),
    ]
