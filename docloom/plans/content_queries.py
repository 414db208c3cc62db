"""Registered queries: raw formats, layout from content, summaries, enrichments and the store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.config import RoutingConfig
from docloom.functions import binary, text
from docloom.operators import content_routing, enrichment, layout, store, summaries
from docloom.plans import staging
from docloom.session import scratch_folder
from docloom.sources import content, formats
from docloom.sources import messages as msg


CONTENT_CONFIG = RoutingConfig(
    strategies={"short_form": "short", "form_heavy": "forms", "table_heavy": "tables", "scanned": "vision"}, fallback="rest", short_form_pages=3, short_form_density=0.3
)


def _documents(spark, sf_dir) -> DataFrame:
    return staging.text_documents(spark, sf_dir)


def _raw(spark, sf_dir) -> DataFrame:
    """Texts and web pages as bytes."""
    docs = _documents(spark, sf_dir).select("document_id", "source_uri", F.encode("text", "UTF-8").alias("content"))
    pages = staging.table(spark, sf_dir, "pages", costly=True).select(
        F.concat(F.lit("p-"), F.col("page_id").cast("string")).alias("document_id"),
        F.concat(F.lit("s3://web/"), F.col("page_id").cast("string"), F.lit(".bin")).alias("source_uri"),
        F.encode("html", "UTF-8").alias("content"),
    )
    return docs.unionByName(pages)


def text_documents(spark, sf_dir):
    return formats.text_documents(_raw(spark, sf_dir)).drop("source_uri")


def format_dispatch(spark, sf_dir):
    return _raw(spark, sf_dir).select(
        "document_id",
        formats.document_format(F.col("content"), F.lit(None).cast("string")).alias("format"),
        formats.document_format(F.col("content"), F.lit("text/plain"), strict_csv=True).alias("strict_format"),
    )


def mime_sniff(spark, sf_dir):
    none = F.lit(None).cast("string")
    return _raw(spark, sf_dir).select(
        "document_id", binary.sniff_mime(none, F.col("content"), F.col("source_uri")).alias("mime_type"),
        F.round(binary.ascii_share("content"), 6).alias("ascii_share"), binary.checksum("content").alias("checksum"),
    )


def inline_payloads(spark, sf_dir):
    """Texts inlined in message bodies under different keys, plain or base64."""
    whole = F.col("text")
    coded = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"[\r\n]", "")
    body = (
        F.when(F.col("lang") == "en", F.to_json(F.struct(F.lit("").alias("documentBytes"), coded.alias("document_bytes"))))
        .when(F.col("lang") == "fr", F.to_json(F.struct(whole.alias("documentContent"))))
        .when(F.col("lang") == "de", F.to_json(F.struct(F.struct(coded.alias("inlineContent")).alias("documentMetadata"))))
        .otherwise(F.to_json(F.struct(whole.alias("payload"), F.lit("unused").alias("ignored"))))
    )
    rows = _documents(spark, sf_dir).select("document_id", F.from_json(body, _body_schema()).alias("doc"))
    rows = rows.select("document_id", msg.inline_bytes(F.col("doc")).alias("content"))
    return rows.select("document_id", binary.checksum("content").alias("checksum"), F.length("content").alias("size"))


def _body_schema() -> str:
    from docloom.schemas import message_body

    return message_body("parser_override")


def _csv_payloads(spark, sf_dir) -> DataFrame:
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    content = F.concat(F.lit('id,"text, whole"\n'), F.col("doc_id").cast("string"), F.lit(","), quoted, F.lit("\n"))
    return _documents(spark, sf_dir).select("document_id", F.encode(content, "UTF-8").alias("content"))


def csv_documents(spark, sf_dir):
    return formats.csv_cells(_csv_payloads(spark, sf_dir))


def csv_headers(spark, sf_dir):
    return formats.csv_summaries(_csv_payloads(spark, sf_dir))


def _emails(spark, sf_dir) -> DataFrame:
    """Every conversation turn as a message: the text as body and again as an attached file."""
    turn = F.concat(F.col("conv_id").cast("string"), F.lit("."), F.col("turn").cast("string"))
    coded = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"[\r\n]", "")
    content = F.concat(
        F.lit("From: "), "role", F.lit("@example.com\nTo: desk@example.com\nSubject: Turn "), turn,
        F.lit('\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="=b="\n\n--=b=\n'),
        F.lit('Content-Type: text/plain; charset="utf-8"\nContent-Transfer-Encoding: 8bit\n\n'), "text",
        F.lit("\n--=b=\nContent-Type: text/plain; charset=\"utf-8\"\nContent-Disposition: attachment; filename=\"turn.txt\"\n"),
        F.lit("Content-ID: <c1>\nContent-Transfer-Encoding: base64\n\n"), coded, F.lit("\n--=b=--\n"),
    )
    return staging.table(spark, sf_dir, "conversations", costly=True).select(
        F.concat(F.lit("m-"), turn).alias("document_id"), F.concat(F.lit("s3://mail/"), turn).alias("source_uri"),
        F.encode(content, "UTF-8").alias("content"),
    )


def file_content(spark, sf_dir):
    """All texts of a source as one file each, read back as bytes and attached to the documents that name them."""
    folder = scratch_folder(spark, "files")
    docs = staging.table(spark, sf_dir, "documents").select("source", "doc_id", "text")
    docs.repartition("source").sortWithinPartitions("source", "doc_id").select("source", "text").write.partitionBy("source").text(folder)
    files = content.read_files(spark, folder, "*.txt")
    named = files.select(F.regexp_extract("path", "source=([^/]+)/", 1).alias("source"), F.col("path").alias("source_uri"))
    asked = docs.groupBy("source").agg(F.count(F.lit(1)).alias("documents")).join(named, "source")
    missing = asked.select("source", "documents", F.concat("source_uri", F.lit(".none")).alias("source_uri"))
    found = content.attach_content(asked.unionByName(missing), files)
    return found.select("source", "documents", F.length("content").cast("long").alias("size"), binary.checksum("content").alias("checksum"))


def email_documents(spark, sf_dir):
    rows = formats.email_documents(_emails(spark, sf_dir))
    return rows.withColumn("attachment_names", F.array_join("attachment_names", ","))


def email_parts(spark, sf_dir):
    return formats.email_parts(_emails(spark, sf_dir)).drop("content", "ord", "walk_index")


def _page_mail(spark, sf_dir) -> DataFrame:
    """Every web page mailed: its address as plain part, the page as HTML part."""
    coded = F.regexp_replace(F.base64(F.encode("html", "UTF-8")), r"[\r\n]", "")
    content = F.concat(
        F.lit('From: web@example.com\nMIME-Version: 1.0\nContent-Type: multipart/alternative; boundary="=b="\n\n--=b=\nContent-Type: text/plain\n\n'), "url",
        F.lit('\n--=b=\nContent-Type: text/html; charset="utf-8"\nContent-Transfer-Encoding: base64\n\n'), coded, F.lit("\n--=b=--\n"),
    )
    return staging.table(spark, sf_dir, "pages", costly=True).select(
        "page_id", F.concat(F.lit("p-"), F.col("page_id").cast("string")).alias("document_id"), F.encode(content, "UTF-8").alias("content")
    )


def email_layout(spark, sf_dir):
    """Text parts of messages as pages, HTML parts by their density, profiled per message."""
    mail = _emails(spark, sf_dir).select("document_id", "content").unionByName(_page_mail(spark, sf_dir).select("document_id", "content"))
    pages = formats.email_text_parts(mail)
    pages = pages.select("document_id", "index", layout.part_metrics(F.col("is_html"), F.col("text")).alias("m")).select("document_id", "m.*")
    profile = layout.profile_pages(pages, ["document_id"])
    densities = [F.round(c, 6).alias(c) for c in ("average_text_density", "average_image_density", "table_page_ratio", "form_page_ratio")]
    return profile.select("document_id", "page_count", *densities, "total_tables", "total_checkboxes")


def _flaky(descriptor: dict) -> bytes | None:
    if descriptor["source_path"].endswith("7.eml"):
        raise OSError("store is down")
    return None


def _cover_letter(documents: list[dict]) -> list:
    """A layout model that knows cover letters only, and fails for whole slices with a key ending in 5."""
    if any(d["source_path"].endswith("5.txt") for d in documents):
        raise ValueError("cannot read")
    return [[{"textDensity": 0.9, "tableCount": 1}, {"text_density": "0.1"}] if (d["source_path"] or "").endswith("0.txt") else None for d in documents]


def route_content(spark, sf_dir):
    """Messages routed by what their documents hold: inline, fetched, joined from a store, modelled, or nothing at all."""
    mail, docs = _page_mail(spark, sf_dir), staging.table(spark, sf_dir, "documents")
    page, doc = F.col("page_id"), F.col("doc_id")
    coded = F.regexp_replace(F.base64("content"), r"[\r\n]", "")
    key = F.concat(F.lit("mail/"), page.cast("string"), F.lit(".eml"))
    declared = F.struct(F.lit(2).alias("pageCount"), F.struct(F.lit(0.25).alias("textDensity")).alias("layout"))
    mailed = F.to_json(F.struct(key.alias("object_key"), declared.alias("documentMetadata"), F.when(page % 3 == 0, coded).alias("documentBytes")))
    texts = F.to_json(F.struct(F.concat(F.lit("text/"), doc.cast("string"), F.lit(".txt")).alias("object_key"), declared.alias("documentMetadata")))
    sent = mail.select(F.concat(F.lit("m-p"), page.cast("string")).alias("message_id"), mailed.alias("body")).unionByName(
        docs.select(F.concat(F.lit("m-d"), doc.cast("string")).alias("message_id"), texts.alias("body"))
    )
    sent = sent.withColumns({"queue_url": F.lit("q"), "stream": F.lit("s"), "receive_count": F.lit(1)})
    stored = mail.where(page % 3 == 1).select(key.alias("_key"), F.col("content").alias("stored"))
    analysis = content_routing.ContentAnalysis(
        resolvers=(
            ("_fetched", content.Fetcher("flaky", _flaky)), ("stored", lambda d: d.join(stored, d.source_path == F.col("_key"), "left").drop("_key")),
        ),
        model=_cover_letter,
    )
    routed = content_routing.route_content(msg.accepted(msg.parse_messages(sent)), CONTENT_CONFIG, analysis=analysis)
    densities = [F.round(c, 6).alias(c) for c in ("average_text_density", "average_image_density", "table_page_ratio", "form_page_ratio")]
    return routed.select(
        "source_path", "page_count", *densities, "total_tables", "document_category", "parser_strategy", F.get("resolver_errors", 0)["error"].alias("error")
    )


def html_layout(spark, sf_dir):
    counts = staging.table(spark, sf_dir, "pages", costly=True).select("page_id", layout.html_layout_counts("html").alias("c"))
    rows = counts.select("page_id", layout.html_metrics(F.col("c")).alias("m")).select("page_id", "m.*")
    return rows.withColumn("text_density", F.round("text_density", 6))


def html_text(spark, sf_dir):
    stripped = text.collapse_whitespace(text.strip_tags("html"))
    return staging.table(spark, sf_dir, "pages", costly=True).select(
        "page_id", F.length(stripped).alias("chars"), binary.checksum(F.encode(stripped, "UTF-8")).alias("checksum")
    )


def text_part_metrics(spark, sf_dir):
    rows = _documents(spark, sf_dir).select("document_id", layout.plain_text_metrics(F.col("text")).alias("m")).select("document_id", "m.*")
    return rows.select("document_id", "char_count", F.round("text_density", 6).alias("text_density"), "image_density")


def page_block_metrics(spark, sf_dir):
    """``lineitem`` rows as blocks of the page (order, line number)."""
    kind = (
        F.when(F.col("l_returnflag") == "A", "text").when(F.col("l_returnflag") == "N", "image")
        .when(F.col("l_linestatus") == "O", "table").when(F.col("l_linenumber") < 4, "checkbox").otherwise("radio")
    )
    blocks = staging.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit(10.0).alias("page_width"), F.lit(20.0).alias("page_height"), kind.alias("kind"),
        F.array(F.lit(1.0), F.lit(2.0), F.col("l_quantity") - 4.0, F.lit(8.0)).alias("bbox"), F.col("l_partkey").alias("char_count"),
    )
    pages = layout.block_metrics(blocks, ["l_orderkey", "l_linenumber"])
    return pages.select(
        "l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in ("text_density", "image_density", "table_density")],
        "char_count", "table_count", "image_count", "checkbox_count", "radio_button_count",
    )


def _with_contents(spark, sf_dir) -> DataFrame:
    return _documents(spark, sf_dir).withColumn("contents", F.split("text", "\n", -1))


def heuristic_summary(spark, sf_dir):
    rows = summaries.heuristic_summaries(_with_contents(spark, sf_dir))
    return rows.select("document_id", "summary.summary", "summary.title", "summary.confidence", "summary.method")


def summary_input(spark, sf_dir):
    return summaries.summary_input(staging.document_spans(spark, sf_dir))


def model_summary(spark, sf_dir):
    """Chat responses of four shapes; two of them fall back to the heuristic."""
    docs = _with_contents(spark, sf_dir)
    good = F.to_json(F.struct(F.col("text").alias("summary"), F.concat(F.lit(" "), "lang").alias("title"), F.lit(0.85).alias("confidence"), F.lit("why").alias("justification"), F.struct("source").alias("metadata")))
    odd = F.to_json(F.struct(F.col("text").alias("summary"), F.lit("high").alias("confidence"), F.lit("because").alias("reasoning"), F.lit("own-model").alias("model")))

    def wrapped(content):
        return F.to_json(F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices")))

    shape = F.col("doc_id") % 4
    response = (
        F.when(shape == 0, wrapped(good)).when(shape == 1, wrapped(odd)).when(shape == 2, wrapped(F.lit("{not json")))
        .otherwise(F.lit('{"choices": []}'))
    )
    rows = summaries.summarise(docs.withColumn("response", response), response="response", deployment="summarizer")
    return rows.select(
        "document_id", "summary.summary", "summary.title", "summary.confidence", "summary.method", "summary.model",
        "summary.justification", F.get_json_object("summary.metadata", "$.source").alias("source"),
    )


def keyword_enrichment(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return docs.select("document_id", F.array_join(text.leading_keywords("text"), ",").alias("keywords"))


def keyword_insights(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return docs.select(
        "document_id", F.array_join(text.sorted_keywords("text", 10), ",").alias("keywords"),
        F.array_join(text.sorted_keywords("text", 6), ",").alias("short_keywords"), text.token_count("text").alias("token_count"),
    )


def enrichment_batches(spark, sf_dir):
    numbered = enrichment.batch_numbers(_documents(spark, sf_dir).select("doc_id"), 8, "doc_id")
    return numbered


def _count_words(frame):
    import json

    import pandas as pd

    entries = [json.dumps([{"type": "word_count", "data": {"words": len(t.split())}, "confidence": "0.9"}]) for t in frame["text"]]
    return pd.DataFrame({"document_id": frame["document_id"], "enrichments": entries, "duration_ms": 7})


def enrichment_merge(spark, sf_dir):
    """Three providers (one over pandas batches, one unknown name ignored) merged onto every document."""
    docs = _documents(spark, sf_dir).select("document_id", "text")
    providers = [
        enrichment.leading_keyword_provider(), enrichment.sorted_keyword_provider(limit=6),
        enrichment.Provider("words", batch=_count_words, max_batch_size=2),
    ]
    rows = enrichment.dispatch(docs, providers, ["words", "missing", "keyword_insights", "keyword_extraction"])
    merged = enrichment.merge_enrichments(docs.select("document_id"), rows)
    entry = lambda i: F.get("enrichments", i)
    return merged.select(
        "document_id", F.size("enrichments").alias("entries"),
        F.array_join(F.transform("enrichments", lambda e: e["provider"]), ",").alias("providers"),
        F.get_json_object(entry(0)["content"], "$.words").cast("int").alias("words"),
        F.get_json_object(entry(0)["metadata"], "$.duration_ms").cast("int").alias("duration_ms"),
        entry(0)["confidence"].alias("confidence"),
        F.get_json_object(entry(1)["content"], "$.token_count").cast("int").alias("token_count"),
    )


def enrichment_normalise(spark, sf_dir):
    """Entries of every label row: usable, without a type, with text as content, with odd confidence."""
    doc = F.col("doc_id").cast("string")
    entries = F.concat(
        F.lit('[{"enrichment_type": "a", "content": {"q": '), F.col("quality").cast("string"), F.lit('}, "confidence": "0.'), F.col("toxic").cast("string"),
        F.lit('5", "model": 7, "metadata": {"duration_ms": 1}}, {"type": null, "content": {"x": 1}}, {"type": "b", "content": "text"}, '),
        F.lit('{"enrichment_type": "", "type": "c", "content": {}, "data": {"d": "'), doc, F.lit('"}, "confidence": "high", "model": "m"}, {"type": "d", "metadata": 3}]'),
    )
    none = F.lit(None)
    responses = staging.table(spark, sf_dir, "labels").select(
        F.concat(F.lit("d-"), doc).alias("document_id"), entries.alias("enrichments"), none.cast("string").alias("raw_response"),
        F.lit(12).cast("long").alias("duration_ms"), none.cast("string").alias("metadata"), none.cast("string").alias("error"),
    )
    rows = enrichment.normalise_responses(responses, "p")
    return rows.withColumn("duration_in_metadata", F.get_json_object("metadata", "$.duration_ms")).drop("metadata")


def _payloads(spark, sf_dir) -> DataFrame:
    """Texts under their language as document id, so exact copies repeat a payload."""
    return _documents(spark, sf_dir).select(
        F.col("lang").alias("document_id"), binary.checksum(F.encode("text", "UTF-8")).alias("checksum"), "doc_id"
    )


def _stored(spark, sf_dir) -> DataFrame:
    bad = staging.table(spark, sf_dir, "labels").where("quality = 0").select("doc_id")
    return _payloads(spark, sf_dir).join(bad, "doc_id", "left_semi").select("document_id", "checksum")


def idempotent_append(spark, sf_dir):
    fresh = store.new_payloads(_payloads(spark, sf_dir), _stored(spark, sf_dir))
    return fresh.select("document_id", "checksum")


def idempotent_force(spark, sf_dir):
    forced = _payloads(spark, sf_dir).withColumn("force", F.col("document_id") == "en")
    return store.new_payloads(forced, _stored(spark, sf_dir), "force").groupBy("document_id").agg(F.count(F.lit(1)).alias("payloads"))


def skipped_documents(spark, sf_dir):
    return store.skip_flags(_payloads(spark, sf_dir), _stored(spark, sf_dir)).select("doc_id", "skipped")


QUERIES = {
    f.__name__: f
    for f in (
        text_documents, format_dispatch, mime_sniff, inline_payloads, csv_documents, csv_headers, file_content, email_documents, email_parts,
        email_layout, route_content, html_layout, html_text, text_part_metrics, page_block_metrics, heuristic_summary, summary_input,
        model_summary, keyword_enrichment, keyword_insights, enrichment_batches, enrichment_merge, enrichment_normalise,
        idempotent_append, idempotent_force, skipped_documents,
    )
}
