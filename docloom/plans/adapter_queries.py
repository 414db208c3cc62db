"""Registered queries: parser payloads built from whole texts, adapted and flattened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators import adapters, canonical, denorm, parts, summaries
from docloom.plans import staging
from docloom.session import scratch_folder


def _inputs(spark, sf_dir, payload: Column, metadata: Column) -> DataFrame:
    docs = staging.text_documents(spark, sf_dir)
    return docs.select(
        "document_id", "source_uri", F.sha2("text", 256).alias("checksum"), payload.alias("payload"), metadata.alias("metadata")
    )


def _lines() -> Column:
    return F.split("text", "\n", -1)


def _meta(**entries) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in entries.items()]))


def _analyze_payload() -> Column:
    """Paragraphs with regions; German texts come as page lines instead, inside an envelope."""
    paragraphs = F.transform(
        _lines(),
        lambda line, i: F.struct(
            line.alias("content"), F.when(i % 2 == 0, 0.5).alias("confidence"),
            F.when(i % 3 == 0, F.concat(F.lit("para-"), i.cast("string"))).alias("id"),
            F.array(F.struct((1 + F.floor(i / 10)).cast("int").alias("pageNumber"), F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0), F.lit(3.0)).alias("polygon"))).alias("boundingRegions"),
        ),
    )
    page = F.struct(F.lit(2).alias("pageNumber"), F.lit(0.75).alias("confidence"), F.transform(_lines(), lambda line: F.struct(line.alias("content"))).alias("lines"))
    cells = F.transform(
        F.array("lang", "source", F.col("n_chars").cast("string")),
        lambda v, i: F.struct(F.lit(0).alias("rowIndex"), i.alias("columnIndex"), v.alias("content"), F.lit(2).alias("columnSpan")),
    )
    table = F.array(F.struct(F.lit("facts").alias("id"), cells.alias("cells"), F.array(F.lit("note")).alias("footnotes")))
    fields = F.struct(
        F.struct(F.col("lang").alias("value"), F.lit("string").alias("type"), F.lit(0.9).alias("confidence")).alias("Language"),
        F.struct(F.col("n_chars").alias("content"), F.lit("number").alias("value_type")).alias("Size"),
    )
    documents = F.array(F.struct(fields.alias("fields")))
    plain = F.to_json(F.struct(paragraphs.alias("paragraphs"), table.alias("tables"), documents.alias("documents")))
    paged = F.to_json(F.struct(F.struct(F.array(page).alias("pages"), table.alias("tables"), documents.alias("documents")).alias("analyzeResult")))
    return F.when(F.col("lang") == "de", paged).otherwise(plain)


def _analyzed(spark, sf_dir) -> DataFrame:
    return adapters.analyze_adapter(_inputs(spark, sf_dir, _analyze_payload(), _meta(mime_type=F.lit("text/plain"), lang=F.col("lang"))))


def analyze_adapter(spark, sf_dir):
    rows = canonical.explode_spans(_analyzed(spark, sf_dir))
    return rows.select("document_id", "ord", "content", "confidence", "page", "span_id", "method", F.size("polygon").alias("points"))


def analyze_adapter_fields(spark, sf_dir):
    fields = canonical.explode_fields(_analyzed(spark, sf_dir))
    return fields.select("document_id", "name", "value", "value_type", "confidence", "page")


def analyze_adapter_tables(spark, sf_dir):
    cells = canonical.explode_cells(_analyzed(spark, sf_dir))
    return cells.select("document_id", "table_id", "row_index", "column_index", "content", "column_span", "page")


def analyze_adapter_segments(spark, sf_dir):
    rows = canonical.explode_segments(_analyzed(spark, sf_dir))
    return rows.select("document_id", "page_number", "method", "confidence", "parser")


def vision_adapter(spark, sf_dir):
    """Spans and the stand-in visual of whole texts."""
    spans = F.transform(_lines(), lambda line, i: F.struct(line.alias("text"), F.when(i % 2 == 0, i + 1).alias("page"), F.lit(0.25).alias("confidence")))
    payload = F.to_json(F.struct(spans.alias("text_spans"), F.col("source").alias("overall_description")))
    found = adapters.vision_adapter(_inputs(spark, sf_dir, payload, F.lit("{}")))
    rows = canonical.explode_spans(found).select("document_id", "ord", "content", "page", "span_id")
    visuals = canonical.explode_visuals(found)
    return rows.unionByName(visuals.select("document_id", F.lit(-1).cast("long").alias("ord"), F.col("description").alias("content"), "page", F.col("parser").alias("span_id")))


def _pages(item: str = "text") -> Column:
    """Pages of five lines."""
    lines = _lines()
    numbers = F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 5).cast("int"))
    return F.transform(
        numbers,
        lambda n: F.struct(
            (n + 1).alias("page_number"), F.lit(0.5).alias("confidence"),
            F.transform(F.slice(lines, n * 5 + 1, 5), lambda line: F.struct(line.alias(item))).alias("lines"),
            F.struct(F.struct(F.col("lang").alias("value"), n.alias("page")).alias("Lang")).alias("fields"),
        ),
    )


def page_payload_adapter(spark, sf_dir):
    payload = F.to_json(F.struct(_pages().alias("pages"), F.lit("report").alias("document_type")))
    found = adapters.page_adapter(_inputs(spark, sf_dir, payload, F.lit("{}")))
    return canonical.explode_spans(found).select("document_id", "ord", "content", "page", "span_id", "confidence")


def page_payload_fields(spark, sf_dir):
    payload = F.to_json(F.struct(_pages().alias("pages"), F.array(F.struct(F.col("n_chars").alias("value"))).alias("fields")))
    found = adapters.page_adapter(_inputs(spark, sf_dir, payload, F.lit("{}")))
    return canonical.explode_fields(found).select("document_id", "ord", "name", "value", "page")


def email_adapter(spark, sf_dir):
    payload = F.to_json(
        F.struct(
            F.col("source").alias("subject"), F.col("text").alias("body_text"), F.struct(F.col("lang").alias("X-Lang"), F.col("source").alias("From")).alias("headers"),
            F.array(F.struct(F.lit("size").alias("label"), F.col("n_chars").cast("string").alias("text"), F.lit(0.5).alias("confidence"))).alias("entities"),
            F.array(F.struct(F.lit("a.pdf").alias("name"), F.lit("application/pdf").alias("content_type")), F.struct(F.lit("b").alias("name"), F.lit(None).cast("string").alias("content_type"))).alias("attachments"),
        )
    )
    found = adapters.email_adapter(_inputs(spark, sf_dir, payload, F.lit("{}")))
    return found.select(
        "document_id", "document_type", "mime_type", F.get_json_object("metadata", "$.subject").alias("subject"),
        F.get("text_spans", 0)["content"].alias("body"), F.size("fields").alias("fields"), F.get("fields", 2)["name"].alias("entity"),
        F.get("fields", 2)["value"].alias("entity_value"), F.size("attachments").alias("attachments"), F.get("attachments", 0)["attachment_id"].alias("attachment_id"),
    )


def merge_parsers(spark, sf_dir):
    """Page extraction and vision output of every text merged."""
    entries = F.array(
        F.struct(F.lit("pymupdf").alias("name"), F.to_json(F.struct(_pages().alias("pages"), F.col("source").alias("mime_type"))).alias("payload")),
        F.struct(F.lit("vision").alias("name"), F.to_json(F.struct(F.array(F.struct(F.col("text").alias("content"))).alias("text_spans"))).alias("payload")),
    )
    payload = F.to_json(F.struct(F.struct("lang").alias("document_metadata"), entries.alias("parsers")))
    registry = {"pymupdf": adapters.page_adapter, "vision": adapters.vision_adapter}
    found = adapters.merge_parsers(_inputs(spark, sf_dir, payload, F.lit("{}")), registry)
    last = F.try_element_at("text_spans", F.lit(-1))
    return found.select(
        "document_id", "document_type", "mime_type", F.get_json_object("metadata", "$.parsers_used").alias("parsers_used"),
        F.get_json_object("metadata", "$.lang").alias("lang"), F.size("text_spans").alias("spans"), last["content"].alias("last_span"),
        F.size("page_segments").alias("segments"), F.size("fields").alias("fields"),
    )


def bad_confidence(spark, sf_dir):
    """Payloads of odd-length texts carry a word as confidence and are turned away."""
    confidence = F.when(F.col("n_chars") % 2 == 1, "high").otherwise("0.5")
    payload = F.to_json(F.struct(F.array(F.struct(F.col("text").alias("content"), confidence.alias("confidence"))).alias("paragraphs")))
    good, bad = adapters.split_errors(adapters.analyze_adapter(_inputs(spark, sf_dir, payload, F.lit("{}"))))
    return good.select("document_id", F.lit(None).cast("string").alias("adapter_error")).unionByName(bad.select("document_id", "adapter_error"))


def canonical_json(spark, sf_dir):
    """Export of every analyzed text read back."""
    rows = canonical.canonical_json(_analyzed(spark, sf_dir))
    value = lambda p: F.get_json_object("canonical_document", p)
    keys = F.json_object_keys("canonical_document")
    return rows.select(
        "document_id", value("$.schema_version").alias("schema_version"), value("$.metadata.provider").alias("provider"),
        F.array_contains(keys, "summaries").alias("has_summaries"), F.array_contains(keys, "tables").alias("has_tables"),
        F.json_array_length(value("$.text_spans")).alias("spans"), value("$.tables[0].footnotes[0]").alias("footnote"),
    )


def reassembled_documents(spark, sf_dir):
    """Flat spans and fields put together again equal the adapter's nested rows."""
    found = _analyzed(spark, sf_dir)
    spans, fields = canonical.explode_spans(found), canonical.explode_fields(found)
    columns = lambda d: [c for c in d.columns if c not in ("document_id", "ord")]
    rebuilt = canonical.assemble(
        found.select("document_id"), {"text_spans": (spans, "ord", columns(spans)), "fields": (fields, "ord", columns(fields))}
    )
    text = F.array_join(F.transform("text_spans", lambda s: s["content"]), "\n")
    return rebuilt.select("document_id", F.size("text_spans").alias("spans"), F.size("fields").alias("fields"), F.sha2(text, 256).alias("checksum"))


def process_documents(spark, sf_dir):
    """Adapter, heuristic summary and denormalised block and insight counts of every text in one go."""
    documents, _ = adapters.split_errors(_analyzed(spark, sf_dir))
    # read several times below
    path = scratch_folder(spark, "documents")
    summaries.add_summaries(documents).write.parquet(path)
    documents = spark.read.parquet(path)
    tree = parts.root_parts(documents)
    tables = denorm.tables_of(documents, tree)
    rows = denorm.blocks(tables).select("bundle_id", "block_type").unionByName(
        denorm.insight_rows(tables).select("bundle_id", F.col("insight_kind").alias("block_type"))
    )
    return rows.groupBy("block_type").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("bundle_id").alias("documents"))


def page_selection(spark, sf_dir):
    spans = staging.document_spans(spark, sf_dir)
    chosen = canonical.select_pages(spans, [1, 3])
    wanted = spans.withColumn("pages", F.when(F.col("ord") % 2 == 0, F.array(F.lit(2))))
    asked = canonical.select_requested_pages(wanted)
    return chosen.select(F.lit("list").alias("how"), "document_id", "ord").unionByName(asked.select(F.lit("column").alias("how"), "document_id", "ord"))


def page_tables(spark, sf_dir):
    """Extractor tables with both key spellings, one table per order line."""
    cells = F.array(
        F.struct(F.col("l_linenumber").alias("row"), F.lit(None).cast("int").alias("rowIndex"), F.lit(0).alias("col"), F.col("l_returnflag").alias("text"), F.lit(None).cast("string").alias("content"), F.array("l_quantity").alias("bbox")),
        F.struct(F.lit(None).cast("int").alias("row"), F.col("l_linenumber").alias("rowIndex"), F.lit(None).cast("int").alias("col"), F.lit("").alias("text"), F.concat(F.lit("  "), "l_linestatus", F.lit(" \n x")).alias("content"), F.array().cast("array<double>").alias("bbox")),
    )
    pages = staging.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("document_id"), F.col("l_linenumber").alias("page_number"), F.to_json(F.array(F.struct(F.lit("cap").alias("caption"), cells.alias("cells")))).alias("tables")
    )
    rows = canonical.page_tables(pages)
    return rows.select("document_id", "table_id", "caption", "row_index", "column_index", "content", F.coalesce(F.size("bounding_box"), F.lit(0)).alias("points"))


QUERIES = {
    f.__name__: f
    for f in (
        analyze_adapter, analyze_adapter_fields, analyze_adapter_tables, analyze_adapter_segments, vision_adapter,
        page_payload_adapter, page_payload_fields, email_adapter, merge_parsers, bad_confidence, canonical_json,
        reassembled_documents, process_documents, page_selection, page_tables,
    )
}
