"""Raw documents to canonical documents to rows, idempotent per payload."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.binary import checksum
from docloom.functions.records import json_map, merge_maps
from docloom.functions.text import ROOT, attachment_uri, blank_to_null, child_part
from docloom.operators import denorm, enrichment, store, summaries
from docloom.operators.adapters import ANALYZE
from docloom.session import read_or_empty, remove_folder, scratch_folder
from docloom.sources import formats

# What the local readers report about themselves.
PROVIDER = ANALYZE
READER_CONFIDENCE = 0.93
CSV_TABLE, CSV_CAPTION = "csv-table", "CSV data table"

# stands between id and checksum in the keys of payloads; no id holds it
_MARK = "\u0001"

_PART = ("request_id", "bundle_id", "part", "attachment_label")
_DOCUMENT = ("document_id", "source_uri", "checksum", "mime_type", "metadata")


def _typed(schema: str, **values) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in values.items()]).cast(schema)


def _field(name: str, value: Column, kind: str) -> Column:
    return _typed(
        schemas.FIELD, name=name, value=value.cast("string"), confidence=READER_CONFIDENCE, value_type=kind, page=None,
        polygon=None, bounding_box=None, parser=PROVIDER, method="field",
    )


def parse_documents(documents: DataFrame, strict_csv: bool = False, keep: Iterable[str] = ()) -> DataFrame:
    """Canonical rows of raw payloads, with the attachments found (``attachment_payloads``), the reader's ``error``, and the
    columns to ``keep``.

    Texts are read by built-in functions, CSV and messages in one Python pass over the rows; nothing is joined or
    shuffled.  A payload that cannot be read has an error and is else empty.  Spreadsheets are read as CSV text and PDFs
    as plain text (``method`` says ``undecoded``): there is no decoder for either here, and this is what happens
    without one.  Feed decoded pages through the page adapter instead.
    """
    mime = F.lower(F.coalesce("mime_type", F.lit("")))
    kinds = documents.withColumn("_format", formats.document_format(F.col("content"), F.col("mime_type"), strict_csv))
    kinds = kinds.withColumn("_reader", formats.reader_of(F.col("_format")))
    read = kinds.withColumn("_read", formats.reading(F.col("_reader"), F.col("content"), mime.startswith("message/")))
    r, reader = F.col("_read"), F.col("_reader")
    text = F.when(reader.isNull(), formats.text_paragraph(F.col("content")))
    read = read.withColumns({"_text": text, "_body": F.when(reader == "csv", formats.csv_header(r["records"])).when(reader == "email", formats.mail_body(r))})
    body = F.coalesce("_text", "_body")
    method = F.when(F.col("_format").isin("pdf", "excel"), "undecoded").otherwise("paragraph")
    span_id = F.when(reader == "csv", "csv-header").when(reader == "email", "email-body").otherwise("text-body")
    span = _typed(
        schemas.SPAN, content=body, confidence=READER_CONFIDENCE, page=1, polygon=None, bounding_box=None, span_id=span_id, parser=PROVIDER, method=method,
    )
    spans = F.when(body != "", F.array(span)).otherwise(F.array().cast(f"array<{schemas.SPAN}>"))
    names = F.when(F.size(r["attachment_names"]) > 0, _field("Attachments", F.to_json(r["attachment_names"]), "list"))
    headers = [_field(n, r[c], "string") for n, c in (("Subject", "subject"), ("From", "sender"), ("To", "recipient"))]
    fields = (
        F.when(reader == "csv", F.array(_field("RowCount", formats.csv_row_count(r["records"]), "number")))
        .when(reader == "email", F.array_compact(F.array(*headers, names)))
        .otherwise(F.array(_field("CharacterCount", F.length("_text").cast("long"), "number")))
    )
    cells = F.flatten(F.transform(r["records"], lambda row, i: F.transform(row, lambda c, j: _typed(
        schemas.CELL, row_index=i, column_index=j, content=c, confidence=READER_CONFIDENCE, page=1, polygon=None, bounding_box=None, row_span=1, column_span=1,
    ))))
    table = _typed(
        schemas.TABLE, table_id=CSV_TABLE, confidence=READER_CONFIDENCE, cells=F.coalesce(cells, F.array().cast(f"array<{schemas.CELL}>")), caption=CSV_CAPTION,
        footnotes=None, parser=PROVIDER,
    )
    tables = F.when(reader == "csv", F.array(table)).otherwise(F.array().cast(f"array<{schemas.TABLE}>"))
    empty = {name: F.array().cast(f"array<{kind}>") for name, kind in (
        ("visual_descriptions", schemas.VISUAL), ("attachments", schemas.ATTACHMENT), ("summaries", schemas.SUMMARY), ("enrichments", schemas.ENRICHMENT),
    )}
    segment = _typed(schemas.SEGMENT, page_number=1, parser=PROVIDER, method="layout", confidence=READER_CONFIDENCE, metadata=None)
    metadata = merge_maps(F.create_map(F.lit("provider"), F.lit(PROVIDER)), json_map("metadata"))
    return read.select(
        "document_id", "source_uri", "checksum", F.lit(schemas.CANONICAL_VERSION).alias("schema_version"),
        blank_to_null(F.get_json_object("metadata", "$.document_type")).alias("document_type"),
        F.col("mime_type"), F.to_json(metadata).alias("metadata"), spans.alias("text_spans"), tables.alias("tables"), fields.alias("fields"),
        empty["visual_descriptions"].alias("visual_descriptions"), F.array(segment).alias("page_segments"),
        empty["attachments"].alias("attachments"), empty["summaries"].alias("summaries"), empty["enrichments"].alias("enrichments"),
        F.when(mime.startswith("message/"), r["attachments"]).alias("attachment_payloads"), reader.alias("reader"), r["error"].alias("error"), *keep,
    )


def part_documents(found: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Attachments as raw documents of their own, with the columns to ``keep``."""
    metadata = F.to_json(
        F.struct("mime_type", _plain(F.col("document_id")).alias("parent_document_id"), F.col("file_name").alias("attachment_file_name"), "content_id")
    )
    return found.select(
        F.col("child_document_id").alias("document_id"), "source_uri", "checksum", "mime_type", metadata.alias("metadata"), "content", *keep
    )


@dataclass(frozen=True)
class Processed:
    """Canonical rows as stored, their part tree, the four row levels, and the payloads no reader could read."""

    documents: DataFrame
    parts: DataFrame
    rows: dict[str, DataFrame]
    failures: DataFrame


def process(
    documents: DataFrame,
    store_path: str,
    force: str | None = None,
    providers: Iterable[enrichment.Provider] = (),
    enrich_with: Iterable[str] = (),
    summarise: bool = True,
    generated_at: Column | None = None,
    *,
    batch: str,
    replace: bool = False,
) -> Processed:
    """Process raw documents once per ``(document_id, checksum)``.

    ``documents``: ``document_id, source_uri, content, mime_type, metadata`` (and the ``force`` flag).  The canonical
    rows are written under ``store_path`` first; rows are then derived from the written table, so parsing runs once
    and a lost executor costs a re-read only.  A batch that the store holds already is refused, or with ``replace``
    written anew.  Payloads are kept apart by ``payload_key``, id and checksum, so several versions of one document in
    a batch do not mix; ids in the rows are the plain ones.  Payloads that a reader cannot read are in ``failures``.
    """
    spark = documents.sparkSession
    documents = documents.withColumn("checksum", checksum("content"))
    stored = read_store(spark, store_path)
    if not replace and not stored.where(F.col("batch") == batch).isEmpty():
        raise ValueError(f"the store holds {batch} already; pass another name, or replace=True")
    fresh = store.pending(documents, stored.where(F.col("batch") != batch), force)
    roots = fresh.select(*_DOCUMENT, "content").withColumn("document_id", F.concat("document_id", F.lit(_MARK), "checksum"))
    # each payload is read once: what the readers found is written, attachments and rows come from there
    scratch = scratch_folder(spark, "read")
    # the part key of a root and its attachments is known here; attachments of attachments are listed flat below the root
    request = F.coalesce(blank_to_null(F.get_json_object("metadata", "$.request_id")), F.col("document_id"))
    none = F.lit(None).cast("string")
    as_root = {"request_id": request, "bundle_id": F.col("document_id"), "part": F.lit(ROOT), "attachment_label": none}
    read_roots = _written(parse_documents(roots.withColumns(as_root), keep=_PART), f"{scratch}/roots")
    found = formats.attachment_rows(read_roots, F.col("attachment_payloads"), ["request_id"])
    as_part = {"bundle_id": F.col("document_id"), "part": child_part(F.lit(ROOT), "ord"), "attachment_label": F.col("file_name")}
    read_parts = _written(parse_documents(part_documents(found.withColumns(as_part), keep=_PART), keep=_PART), f"{scratch}/parts")
    listed = F.transform("attachment_payloads", lambda a: _typed(
        schemas.ATTACHMENT, attachment_id=(a["walk_index"] + 1).cast("string"), file_name=a["file_name"], mime_type=a["mime_type"], checksum=a["checksum"],
        source_uri=attachment_uri(F.col("source_uri"), a["file_name"]), metadata=F.to_json(F.struct(a["size_bytes"].alias("size_bytes"), a["content_id"].alias("content_id"))),
        child_document_id=F.concat("document_id", F.lit("::attachment-"), (a["walk_index"] + 1).cast("string")),
    ))
    read_roots = read_roots.withColumn("attachments", F.coalesce(listed, F.col("attachments")))
    both = read_roots.drop("attachment_payloads").unionByName(read_parts.drop("attachment_payloads"))
    failed = both.where("error IS NOT NULL").select(_plain(F.col("document_id")).alias("document_id"), "reader", "error")
    failures = _written(failed, scratch_folder(spark, "failures"))
    canonical = both.where("error IS NULL").drop("reader", "error")
    if summarise:
        canonical = summaries.add_summaries(canonical)
    names = list(enrich_with)
    if names:
        text = F.array_join(F.transform("text_spans", lambda s: s["content"]), " ")
        answers = enrichment.dispatch(canonical.select("document_id", text.alias("text")), providers, names)
        canonical = enrichment.merge_enrichments(canonical, answers)
    canonical = canonical.withColumn("is_root", F.get_json_object("metadata", "$.parent_document_id").isNull())
    # stored ids are plain; the key keeps payloads apart
    listed_plain = F.transform("attachments", lambda a: a.withField("child_document_id", _plain(a["child_document_id"])))
    canonical = canonical.withColumns({"payload_key": F.col("document_id"), "document_id": _plain(F.col("document_id")), "attachments": listed_plain})
    target = f"{store_path}/batch={batch}"
    canonical.write.mode("overwrite").parquet(target)
    remove_folder(spark, scratch)
    part_columns = ", ".join(f"{c} string" for c in ("payload_key", *_PART))
    written = spark.read.schema(f"{schemas.CANONICAL}, is_root boolean, {part_columns}").parquet(target)
    keyed = written.withColumn("document_id", F.col("payload_key")).where(F.col("is_root") | (F.col("part") != ROOT))
    rows = denorm.denormalise(denorm.tables_of(keyed), generated_at)
    plain = {k: _plain_ids(v) for k, v in rows.items()}
    return Processed(written.drop(*_PART), _plain_ids(_part_rows(keyed)), plain, failures)


def _part_rows(keyed: DataFrame) -> DataFrame:
    """The part tree of stored documents: the roots, and what they list."""
    text = F.lit(None).cast("string")
    roots = keyed.where("is_root").select(
        "request_id", "bundle_id", "part", text.alias("parent_part"), F.lit(0).alias("depth"), "document_id", text.alias("file_name"), text.alias("mime_type"), "attachments"
    )
    listed = roots.select("request_id", "bundle_id", "part", F.posexplode("attachments").alias("ord", "_a"))
    below = listed.select(
        "request_id", "bundle_id", child_part("part", "ord").alias("part"), F.col("part").alias("parent_part"), F.lit(1).alias("depth"),
        F.col("_a.child_document_id").alias("document_id"), "_a.file_name", "_a.mime_type",
    )
    return roots.drop("attachments").unionByName(below)


def _written(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _plain(value: Column) -> Column:
    return F.regexp_replace(value, f"{_MARK}[0-9a-f]*", "")


def _plain_ids(rows: DataFrame) -> DataFrame:
    """Take checksums out of all text columns that name documents."""
    named = {c: _plain(F.col(c)) for c, kind in rows.dtypes if kind == "string" and c.endswith(("_id", "_uri"))}
    return rows.withColumns(named) if named else rows


def read_store(spark, store_path: str, but: str | None = None) -> DataFrame:
    """Keys of everything stored; an absent store is empty."""
    rows = read_or_empty(spark, store_path, "document_id string, checksum string, batch string")
    return rows.where(F.col("batch") != but) if but else rows
