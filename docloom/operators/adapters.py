"""Parser payloads to canonical documents.

Every adapter takes one row per payload (``document_id, source_uri, checksum, payload`` JSON text,
``metadata`` JSON text from the caller) and returns ``schemas.CANONICAL`` rows plus
``adapter_error``.  All work happens inside the row with array functions, so an adapter is a
narrow stage; ``canonical.explode_*`` turns its output into the flat working tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.numbers import confidence_or_one, parse_int
from docloom.functions.records import (
    first_scalar, first_truthy, has_key, json_map, merge_maps, non_empty, truthy, truthy_variant,
)
from docloom.functions.text import blank_to_null, strip

Adapter = Callable[[DataFrame], DataFrame]

# Provider names stored with the extracted parts.
ANALYZE, VISION, PAGES, EMAIL, MULTI = (
    "azure_document_intelligence", "databricks_llm_image", "pymupdf", "email_parser", "multi_parser",
)

_REGION = "struct<page_number:string,pageNumber:string,polygon:array<double>,bounding_box:array<double>,boundingBox:array<double>>"
_REGIONS = f"bounding_regions:array<{_REGION}>,boundingRegions:array<{_REGION}>,regions:array<{_REGION}>"
_BOX = (
    "page:string,page_number:string,pageNumber:string,polygon:array<double>,bounding_box:array<double>,"
    "boundingBox:array<double>,bbox:array<double>,rect:array<double>"
)


# --- shared builders -----------------------------------------------------------------


def _typed(schema: str, **parts) -> Column:
    columns = [(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in parts.items()]
    return F.struct(*columns).cast(schema)


def _integer(value: Column, default: Column | int | None = None) -> Column:
    number = parse_int(value).cast("int")
    return number if default is None else F.coalesce(number, default if isinstance(default, Column) else F.lit(default))


def _items(value: Column) -> Column:
    """Array without null entries (what is not an object parses to null)."""
    return F.filter(F.coalesce(value, F.array()), lambda x: x.isNotNull())


def _named_entries(json_text: Column) -> Column:
    """Object members or list elements as ``name, entry`` pairs; list elements are named by position."""
    listed = F.transform(F.from_json(json_text, "array<string>"), lambda e, i: F.struct(i.cast("string").alias("name"), e.alias("entry")))
    members = F.transform(
        F.map_entries(json_map(json_text)), lambda m: F.struct(m["key"].alias("name"), m["value"].alias("entry"))
    )
    pairs = F.when(F.ltrim(json_text).startswith("["), listed).otherwise(members)
    return F.filter(F.coalesce(pairs, F.array()), lambda p: p["entry"].isNotNull() & (p["entry"] != "null"))


def _numbered(items: Column, schema_fields: str) -> Column:
    """Attach each element's position in the payload, so filtering does not renumber."""
    return F.transform(items, lambda x, i: F.struct(i.alias("i"), x.alias("x")))


def _caller_metadata() -> Column:
    return json_map(F.coalesce("metadata", F.lit("{}")))


def _provider(name: str) -> Column:
    return F.create_map(F.lit("provider"), F.lit(name))


def _meta(key: str) -> Column:
    return blank_to_null(F.try_element_at("_meta", F.lit(key)))


def _no_confidence(*arrays: Column) -> Column:
    """Null confidences are the non-numeric ones: missing ones became 1.0."""
    return reduce(
        Column.__or__, [F.coalesce(F.exists(a, lambda x: x["confidence"].isNull()), F.lit(False)) for a in arrays]
    )


def _canonical(rows: DataFrame, document_type: Column, mime_type: Column, error: Column | None = None) -> DataFrame:
    """Final projection; ``rows`` holds ``_spans, _tables, _fields, _visuals, _segments, _attachments, _meta``."""

    def array(name: str, element: str) -> Column:
        source = F.col(name) if name in rows.columns else F.array()
        return F.coalesce(source, F.array()).cast(f"array<{element}>")

    arrays = {
        "text_spans": array("_spans", schemas.SPAN),
        "tables": array("_tables", schemas.TABLE),
        "fields": array("_fields", schemas.FIELD),
        "visual_descriptions": array("_visuals", schemas.VISUAL),
        "page_segments": array("_segments", schemas.SEGMENT),
        "attachments": array("_attachments", schemas.ATTACHMENT),
        "summaries": F.array().cast(f"array<{schemas.SUMMARY}>"),
        "enrichments": F.array().cast(f"array<{schemas.ENRICHMENT}>"),
    }
    result = rows.select(
        "document_id",
        "source_uri",
        "checksum",
        F.lit(schemas.CANONICAL_VERSION).alias("schema_version"),
        document_type.alias("document_type"),
        mime_type.alias("mime_type"),
        F.to_json("_meta").alias("metadata"),
        *[c.alias(n) for n, c in arrays.items()],
        F.col("payload").isNull().alias("_empty"),
        *([] if error is None else [error.alias("_problem")]),
    )
    cells = F.flatten(F.transform("tables", lambda t: t["cells"]))
    bad = _no_confidence(F.col("text_spans"), F.col("tables"), cells, F.col("fields"), F.col("visual_descriptions"))
    problem = F.when(F.col("_empty"), "payload is empty")
    if error is not None:
        problem = F.coalesce(problem, F.col("_problem"))
    problem = F.coalesce(problem, F.when(bad, "confidence values must be numeric"))
    return result.withColumn("adapter_error", problem).drop("_empty", "_problem")


def split_errors(adapted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good canonical rows, and the rejected ones as ``document_id, source_uri, adapter_error``."""
    good = adapted.where(F.col("adapter_error").isNull()).drop("adapter_error")
    bad = adapted.where(F.col("adapter_error").isNotNull()).select("document_id", "source_uri", "adapter_error")
    return good, bad


# --- analysis service ----------------------------------------------------------------

_PARAGRAPH = f"struct<content:string,confidence:string,id:string,{_REGIONS}>"
_ANALYZE = (
    f"paragraphs array<{_PARAGRAPH}>, documents array<struct<fields:string>>,"
    f"pages array<struct<page_number:string,pageNumber:string,confidence:string,lines:array<{_PARAGRAPH}>>>,"
    "tables array<struct<id:string,index:string,confidence:string,caption:string,footnotes:array<string>,"
    "cells:array<struct<row_index:string,rowIndex:string,column_index:string,columnIndex:string,content:string,"
    f"confidence:string,row_span:string,rowSpan:string,column_span:string,columnSpan:string,{_REGIONS}>>>>"
)
_ANALYZE_FIELD = (
    f"struct<value:string,content:string,confidence:string,type:string,value_type:string,valueType:string,{_REGIONS}>"
)


def _first_region(owner: Column) -> Column:
    found = F.coalesce(
        non_empty(owner["bounding_regions"]), non_empty(owner["boundingRegions"]), non_empty(owner["regions"])
    )
    return F.get(found, 0)


def _region_parts(owner: Column, default_page: Column | int | None) -> dict[str, Column]:
    """Page, polygon and box of the first region; without one only the default page (None: no region)."""
    region = _first_region(owner)
    fallback = F.lit(1) if default_page is None else (default_page if isinstance(default_page, Column) else F.lit(default_page))
    page = F.coalesce(_integer(region["page_number"]), _integer(region["pageNumber"]), fallback)
    if default_page is None:
        page = F.when(region.isNotNull(), page)
    return {
        "page": page,
        "polygon": region["polygon"],
        "bounding_box": F.coalesce(region["bounding_box"], region["boundingBox"]),
    }


def analyze_adapter(payloads: DataFrame) -> DataFrame:
    """Analyze results: paragraphs (page lines when there are none), tables, document fields, pages."""
    name = ANALYZE
    body = F.when(has_key("payload", "analyzeResult"), F.get_json_object("payload", "$.analyzeResult")).otherwise(F.col("payload"))
    # the generator keeps the optimizer from reading the payload again for a test of what is in it
    rows = payloads.withColumn("_p", F.explode(F.array(F.from_json(body, _ANALYZE))))
    rows = rows.withColumn("_meta", merge_maps(_provider(name), _caller_metadata()))
    p = F.col("_p")

    def span(x: Column, span_id: Column, default_page, method: str) -> Column:
        return _typed(
            schemas.SPAN, content=x["content"], confidence=confidence_or_one(x["confidence"]),
            **_region_parts(x, default_page), span_id=F.coalesce(x["id"], span_id), parser=name, method=method,
        )

    numbered = _numbered(F.coalesce(p["paragraphs"], F.array()), _PARAGRAPH)
    paragraphs = F.transform(
        F.filter(numbered, lambda e: e["x"]["content"] != ""),
        lambda e: span(e["x"], e["i"].cast("string"), 1, "paragraph"),
    )

    def page_number(page: Column) -> Column:
        return F.coalesce(_integer(page["page_number"]), _integer(page["pageNumber"]), F.lit(1))

    def page_lines(page: Column) -> Column:
        lines = F.filter(_numbered(F.coalesce(page["lines"], F.array()), _PARAGRAPH), lambda e: e["x"]["content"] != "")
        prefix = F.concat(F.lit("page-"), page_number(page).cast("string"), F.lit("-line-"))
        return F.transform(
            lines, lambda e: span(e["x"], F.concat(prefix, e["i"].cast("string")), page_number(page), "line")
        )

    pages = _items(p["pages"])
    lines = F.flatten(F.transform(pages, page_lines))
    spans = F.when(F.coalesce(F.size(p["paragraphs"]), F.lit(0)) > 0, paragraphs).otherwise(lines)

    def cell(x: Column) -> Column:
        return _typed(
            schemas.CELL,
            row_index=_integer(F.coalesce(x["row_index"], x["rowIndex"]), 0),
            column_index=_integer(F.coalesce(x["column_index"], x["columnIndex"]), 0),
            content=F.coalesce(x["content"], F.lit("")),
            confidence=confidence_or_one(x["confidence"]),
            **_region_parts(x, 1),
            row_span=_integer(F.coalesce(x["row_span"], x["rowSpan"]), 1),
            column_span=_integer(F.coalesce(x["column_span"], x["columnSpan"]), 1),
        )

    tables = F.transform(
        _items(p["tables"]),
        lambda t: _typed(
            schemas.TABLE,
            table_id=F.coalesce(truthy(t["id"]), F.concat(F.lit("table-"), F.coalesce(t["index"], F.lit("unknown")))),
            confidence=confidence_or_one(t["confidence"]),
            cells=F.transform(_items(t["cells"]), cell),
            caption=t["caption"],
            footnotes=t["footnotes"],
            parser=name,
        ),
    )

    entries = F.flatten(F.transform(_items(p["documents"]), lambda d: _named_entries(d["fields"])))

    def field(e: Column) -> Column:
        x = e["f"]
        # a value given as null does not fall through to the content
        value = F.when(has_key(e["entry"], "value"), x["value"]).otherwise(x["content"])
        return _typed(
            schemas.FIELD, name=e["name"], value=value, confidence=confidence_or_one(x["confidence"]),
            value_type=F.coalesce(x["type"], x["value_type"], x["valueType"]),
            **_region_parts(x, None), parser=name, method="field",
        )

    parsed_entries = F.transform(
        entries, lambda e: F.struct(e["name"].alias("name"), e["entry"].alias("entry"), F.from_json(e["entry"], _ANALYZE_FIELD).alias("f"))
    )
    layout = F.transform(
        pages,
        lambda g: _typed(
            schemas.SEGMENT, page_number=page_number(g), parser=name, method="layout",
            confidence=confidence_or_one(g["confidence"]), metadata=None,
        ),
    )
    rows = rows.withColumns({"_spans": spans, "_tables": tables, "_fields": F.transform(parsed_entries, field), "_layout": layout})
    seen = F.array_sort(F.array_distinct(F.transform("_spans", lambda s: s["page"])))
    inferred = F.transform(seen, lambda n: _segment(n, name, "inferred"))
    single = F.array(_segment(F.lit(1), name, "analysis"))
    segments = F.coalesce(non_empty("_layout"), non_empty(inferred), single)
    mime = F.coalesce(_meta("mime_type"), _meta("content_type"))
    return _canonical(rows.withColumn("_segments", segments), _meta("document_type"), mime)


def _segment(page: Column, parser: str, method: str) -> Column:
    return _typed(schemas.SEGMENT, page_number=page, parser=parser, method=method, confidence=None, metadata=None)


# --- vision model --------------------------------------------------------------------

_VISION_SPAN = f"struct<content:variant,text:variant,confidence:string,id:variant,span_id:variant,{_BOX}>"
_VISION_VISUAL = (
    f"struct<description:variant,content:variant,confidence:string,tags:array<string>,labels:array<string>,{_BOX}>"
)
_VISION = (
    f"text_spans array<{_VISION_SPAN}>, textSpans array<{_VISION_SPAN}>, textSegments array<{_VISION_SPAN}>,"
    f"fields array<struct<name:variant,value:string,confidence:string,value_type:string,type:string,{_BOX}>>,"
    f"visual_descriptions array<{_VISION_VISUAL}>, visualDescriptions array<{_VISION_VISUAL}>,"
    "overall_description variant, summary variant, page string"
)


def _vision_region(x: Column) -> dict[str, Column]:
    page = _integer(first_truthy(x["page"], x["page_number"], x["pageNumber"]))
    box = F.coalesce(non_empty(x["bounding_box"]), x["boundingBox"])
    placed = x["polygon"].isNotNull() | box.isNotNull()
    return {"page": F.coalesce(page, F.when(placed, 1)), "polygon": x["polygon"], "bounding_box": box}


def vision_adapter(payloads: DataFrame) -> DataFrame:
    """Vision responses: spans, fields, visual descriptions; one overall description may stand for all visuals."""
    name = VISION
    rows = payloads.withColumn("_p", F.from_json("payload", _VISION))
    p = F.col("_p")
    overall = first_scalar(p["overall_description"], p["summary"])
    caller = merge_maps(_provider(name), _caller_metadata())
    described = F.when(
        overall.isNotNull() & ~F.map_contains_key(caller, "overall_description"),
        F.create_map(F.lit("overall_description"), overall),
    )
    raw_spans = F.coalesce(non_empty(F.coalesce(p["text_spans"], p["textSpans"])), p["textSegments"], F.array())

    def span(e: Column) -> Column:
        x = e["x"]
        own_id = first_scalar(x["id"], x["span_id"])
        return _typed(
            schemas.SPAN, content=first_scalar(x["content"], x["text"]), confidence=confidence_or_one(x["confidence"]),
            **_vision_region(x), span_id=F.coalesce(own_id, F.concat(F.lit("span-"), e["i"].cast("string"))),
            parser=name, method="llm_text",
        )

    spans = F.filter(F.transform(_numbered(raw_spans, _VISION_SPAN), span), lambda s: s["content"].isNotNull())
    fields = F.transform(
        F.filter(_items(p["fields"]), lambda x: truthy_variant(x["name"]).isNotNull()),
        lambda x: _typed(
            schemas.FIELD, name=x["name"].cast("string"), value=x["value"], confidence=confidence_or_one(x["confidence"]),
            value_type=first_truthy(x["value_type"], x["type"]), **_vision_region(x), parser=name, method="llm_field",
        ),
    )
    raw_visuals = F.coalesce(non_empty(F.coalesce(p["visual_descriptions"], p["visualDescriptions"])), p["visualDescriptions"], F.array())
    visuals = F.filter(
        F.transform(
            _items(raw_visuals),
            lambda x: _typed(
                schemas.VISUAL, description=first_scalar(x["description"], x["content"]),
                confidence=confidence_or_one(x["confidence"]), **_vision_region(x),
                tags=F.coalesce(non_empty(x["tags"]), x["labels"]), parser=name, method="vision_description",
            ),
        ),
        lambda v: v["description"].isNotNull(),
    )
    single = _typed(
        schemas.VISUAL, description=overall, confidence=1.0, page=None, polygon=None, bounding_box=None, tags=None,
        parser=name, method="vision_description",
    )
    stand_in = F.when(overall.isNotNull(), F.array(single)).otherwise(F.array().cast(f"array<{schemas.VISUAL}>"))
    rows = rows.withColumns(
        {
            "_meta": merge_maps(caller, described),
            "_spans": spans,
            "_fields": fields,
            "_visuals": F.when(F.size(raw_visuals) > 0, visuals).otherwise(stand_in),
        }
    )
    pages = F.array_distinct(F.array_compact(F.transform("_spans", lambda s: s["page"])))
    default_page = F.array(_integer(truthy(p["page"]), 1))
    segments = F.transform(F.coalesce(non_empty(pages), default_page), lambda n: _segment(n, name, "vision"))
    mime = F.coalesce(_meta("mime_type"), _meta("content_type"), F.lit("image"))
    return _canonical(rows.withColumn("_segments", segments), F.coalesce(_meta("document_type"), F.lit("image")), mime)


# --- page extraction -----------------------------------------------------------------

_PAGE_TEXT = f"struct<content:variant,text:variant,confidence:string,id:variant,method:string,{_BOX}>"
_PAGE_CELL = (
    "struct<content:string,text:string,row_index:string,row:string,column_index:string,column:string,row_span:string,"
    f"rowSpan:string,column_span:string,col_span:string,columnSpan:string,confidence:string,{_BOX}>"
)
_PAGE_TABLE = f"struct<id:string,confidence:string,caption:string,footnotes:array<string>,cells:array<{_PAGE_CELL}>>"
_PAGE_FIELD = f"struct<value:variant,text:variant,confidence:string,method:string,value_type:string,type:string,{_BOX}>"
_TEXT_KEYS = ("text_spans", "spans", "text_blocks", "blocks", "lines")
_PAGES = (
    "pages array<struct<page_number:string,number:string,index:string,confidence:string,method:string,rotation:string,"
    + ",".join(f"{k}:array<{_PAGE_TEXT}>" for k in _TEXT_KEYS)
    + f",text:string,tables:array<{_PAGE_TABLE}>,fields:string>>,"
    "fields string, metadata string, document_type string, mime_type string"
)


def _page_region(x: Column, default_page: Column) -> dict[str, Column]:
    page = _integer(first_truthy(x["page"], x["page_number"], x["pageNumber"]))
    box = F.coalesce(non_empty(x["bounding_box"]), non_empty(x["bbox"]), x["rect"])
    return {"page": F.coalesce(page, default_page), "polygon": x["polygon"], "bounding_box": box}


def page_adapter(payloads: DataFrame) -> DataFrame:
    """Page extraction payloads.

    A page numbered 0 counts as page 1, and so does page 1: zero falls through the number keys.
    """
    name = PAGES
    rows = payloads.withColumn("_p", F.from_json("payload", _PAGES))
    p = F.col("_p")
    pages = _items(p["pages"])

    def number(g: Column) -> Column:
        return _integer(first_truthy(g["page_number"], g["number"], g["index"]), 1)

    def numbered_id(kind: str, g: Column, i: Column) -> Column:
        return F.concat(F.lit("p"), number(g).cast("string"), F.lit(f"-{kind}-"), i.cast("string"))

    def page_spans(g: Column) -> Column:
        plain = F.array(
            F.from_json(F.to_json(F.struct(g["text"].alias("content"))), _PAGE_TEXT)
        )
        items = F.coalesce(
            *[g[k] for k in _TEXT_KEYS],
            F.when(strip(g["text"]) != "", plain),
            F.array().cast(f"array<{_PAGE_TEXT}>"),
        )

        def span(e: Column) -> Column:
            x = e["x"]
            return _typed(
                schemas.SPAN, content=first_scalar(x["content"], x["text"]),
                confidence=confidence_or_one(first_truthy(x["confidence"], g["confidence"])),
                **_page_region(x, number(g)),
                span_id=F.coalesce(truthy_variant(x["id"]), numbered_id("span", g, e["i"])),
                parser=name, method=F.coalesce(truthy(x["method"]), F.lit("text_block")),
            )

        return F.filter(F.transform(_numbered(items, _PAGE_TEXT), span), lambda s: s["content"].isNotNull())

    def page_tables(g: Column) -> Column:
        def cell(x: Column, table: Column) -> Column:
            return _typed(
                schemas.CELL,
                row_index=_integer(first_truthy(x["row_index"], x["row"]), 0),
                column_index=_integer(first_truthy(x["column_index"], x["column"]), 0),
                # only an empty text is skipped here: "0" is a cell value
                content=F.coalesce(blank_to_null(x["content"]), x["text"], F.lit("")),
                confidence=confidence_or_one(first_truthy(x["confidence"], table["confidence"])),
                **_page_region(x, number(g)),
                row_span=_integer(first_truthy(x["row_span"], x["rowSpan"]), 1),
                column_span=_integer(first_truthy(x["column_span"], x["col_span"], x["columnSpan"]), 1),
            )

        def table(e: Column) -> Column:
            t = e["x"]
            return _typed(
                schemas.TABLE, table_id=F.coalesce(truthy(t["id"]), numbered_id("table", g, e["i"])),
                confidence=confidence_or_one(first_truthy(t["confidence"], g["confidence"])),
                cells=F.transform(_items(t["cells"]), lambda x: cell(x, t)), caption=t["caption"],
                footnotes=F.coalesce(t["footnotes"], F.array()), parser=name,
            )

        numbered = _numbered(F.coalesce(g["tables"], F.array()), _PAGE_TABLE)
        return F.transform(F.filter(numbered, lambda e: e["x"].isNotNull()), table)

    def fields(json_text: Column, page: Column) -> Column:
        parsed = F.transform(
            _named_entries(json_text),
            lambda e: F.struct(e["name"].alias("name"), F.from_json(e["entry"], _PAGE_FIELD).alias("f")),
        )
        return F.transform(
            F.filter(parsed, lambda e: e["f"].isNotNull()),
            lambda e: _typed(
                schemas.FIELD, name=e["name"],
                value=F.coalesce(truthy_variant(e["f"]["value"]), e["f"]["text"].cast("string")),
                confidence=confidence_or_one(e["f"]["confidence"]),
                value_type=first_truthy(e["f"]["value_type"], e["f"]["type"]),
                **_page_region(e["f"], page),
                parser=name, method=F.coalesce(truthy(e["f"]["method"]), F.lit("field")),
            ),
        )

    segments = F.transform(
        pages,
        lambda g: _typed(
            schemas.SEGMENT, page_number=number(g), parser=name, method=F.coalesce(truthy(g["method"]), F.lit("text")),
            confidence=confidence_or_one(g["confidence"]),
            metadata=F.when(g["rotation"].isNotNull(), F.to_json(F.struct(g["rotation"]))),
        ),
    )
    page_fields = F.flatten(F.transform(pages, lambda g: fields(g["fields"], number(g))))
    rows = rows.withColumns(
        {
            "_spans": F.flatten(F.transform(pages, page_spans)),
            "_tables": F.flatten(F.transform(pages, page_tables)),
            "_fields": F.concat(page_fields, fields(p["fields"], F.lit(1))),
            "_segments": segments,
            "_meta": merge_maps(_provider(name), json_map(p["metadata"]), _caller_metadata()),
            "_no_pages": F.coalesce(F.size(p["pages"]), F.lit(0)) <= 0,
        }
    )
    error = F.when(F.col("_no_pages"), "payload must include a non-empty 'pages' list")
    kind = F.coalesce(_meta("document_type"), truthy(p["document_type"]), F.lit("document"))
    return _canonical(rows, kind, F.coalesce(_meta("mime_type"), p["mime_type"]), error)


# --- email ---------------------------------------------------------------------------

_ATTACHMENTS = (
    "array<struct<attachment_id:string,id:string,file_name:string,name:string,mime_type:string,content_type:string,"
    "checksum:string,source_uri:string,metadata:string,canonical_document:string>>"
)
_EMAIL_KEYS = ("subject", "from", "to", "cc", "bcc", "sent_at")
_EMAIL = (
    "body_text variant, text variant, headers string, metadata string,"
    "text_spans array<struct<content:variant,text:variant,confidence:string,method:string,id:variant>>,"
    "entities array<struct<name:variant,label:variant,value:variant,text:string,confidence:string,method:string,type:string>>,"
    f"attachments {_ATTACHMENTS}," + ",".join(f"`{k}` string" for k in _EMAIL_KEYS)
)


def attachment_structs(raw: Column, require_id: bool) -> Column:
    """Attachments with a name and a media type; an inlined document moves into the metadata."""

    def build(e: Column) -> Column:
        x = e["x"]
        own_id = first_truthy(x["attachment_id"], x["id"])
        default_id = F.lit(None) if require_id else F.concat(F.lit("attachment-"), e["i"].cast("string"))
        inlined = F.when(
            x["canonical_document"].isNotNull(), F.create_map(F.lit("canonical_document"), x["canonical_document"])
        )
        return _typed(
            schemas.ATTACHMENT, attachment_id=F.coalesce(own_id, default_id),
            file_name=first_truthy(x["file_name"], x["name"]), mime_type=first_truthy(x["mime_type"], x["content_type"]),
            checksum=x["checksum"], source_uri=x["source_uri"],
            metadata=F.to_json(merge_maps(json_map(x["metadata"]), inlined)), child_document_id=None,
        )

    built = F.transform(_numbered(F.coalesce(raw, F.array()), _ATTACHMENTS), build)
    return F.filter(
        built, lambda a: a["attachment_id"].isNotNull() & a["file_name"].isNotNull() & a["mime_type"].isNotNull()
    )


def email_adapter(payloads: DataFrame) -> DataFrame:
    """Parsed emails: body and extra spans, header and entity fields, attachments."""
    name = EMAIL
    rows = payloads.withColumn("_p", F.from_json("payload", _EMAIL))
    p = F.col("_p")

    def span(content: Column, confidence: Column, span_id: Column, method: Column) -> Column:
        return _typed(
            schemas.SPAN, content=content, confidence=confidence, page=None, polygon=None, bounding_box=None,
            span_id=span_id, parser=name, method=method,
        )

    text = first_scalar(p["body_text"], p["text"])
    main = F.when(
        strip(text) != "", F.array(span(text, F.lit(1.0), F.lit("body-text"), F.lit("body_text")))
    ).otherwise(F.array().cast(f"array<{schemas.SPAN}>"))
    extra = F.transform(
        _numbered(F.coalesce(p["text_spans"], F.array()), ""),
        lambda e: span(
            first_scalar(e["x"]["content"], e["x"]["text"]), confidence_or_one(e["x"]["confidence"]),
            F.coalesce(truthy_variant(e["x"]["id"]), F.concat(F.lit("email-span-"), e["i"].cast("string"))),
            F.coalesce(truthy(e["x"]["method"]), F.lit("body_segment")),
        ),
    )

    def field(field_name: Column, value: Column, confidence: Column, kind: Column, method: Column) -> Column:
        return _typed(
            schemas.FIELD, name=field_name, value=value, confidence=confidence, value_type=kind, page=None, polygon=None,
            bounding_box=None, parser=name, method=method,
        )

    headers = F.transform(
        F.coalesce(F.map_entries(json_map(p["headers"])), F.array()),
        lambda m: field(m["key"], m["value"], F.lit(1.0), F.lit("header"), F.lit("header")),
    )
    entities = F.transform(
        _numbered(F.coalesce(p["entities"], F.array()), ""),
        lambda e: field(
            F.coalesce(first_scalar(e["x"]["name"], e["x"]["label"]), F.concat(F.lit("entity-"), e["i"].cast("string"))),
            F.coalesce(truthy_variant(e["x"]["value"]), e["x"]["text"]), confidence_or_one(e["x"]["confidence"]),
            F.coalesce(truthy(e["x"]["type"]), F.lit("entity")), F.coalesce(truthy(e["x"]["method"]), F.lit("entity")),
        ),
    )
    known = F.map_from_entries(
        F.filter(
            F.array(*[F.struct(F.lit(k).alias("key"), p[k].alias("value")) for k in _EMAIL_KEYS]),
            lambda m: m["value"].isNotNull(),
        )
    )
    rows = rows.withColumns(
        {
            "_spans": F.concat(main, F.filter(extra, lambda s: s["content"].isNotNull())),
            "_fields": F.concat(headers, entities),
            "_attachments": attachment_structs(p["attachments"], require_id=False),
            "_segments": F.array(_segment(F.lit(1), name, "message")),
            # keys of the message fill gaps only
            "_meta": merge_maps(known, _provider(name), json_map(p["metadata"]), _caller_metadata()),
        }
    )
    mime = F.coalesce(_meta("mime_type"), F.lit("message/rfc822"))
    return _canonical(rows, F.coalesce(_meta("document_type"), F.lit("email")), mime)


# --- registry and merge --------------------------------------------------------------

ADAPTERS: dict[str, Adapter] = {
    ANALYZE: analyze_adapter,
    VISION: vision_adapter,
    PAGES: page_adapter,
    EMAIL: email_adapter,
}


def adapter(name: str, registry: dict[str, Adapter] | None = None) -> Adapter:
    registry = ADAPTERS if registry is None else registry
    if name not in registry:
        raise KeyError(f"no adapter registered for parser {name!r}")
    return registry[name]


_MULTI = f"document_metadata string, parsers array<struct<name:string,payload:string,metadata:string>>, attachments {_ATTACHMENTS}"
_MERGED_ARRAYS = ("text_spans", "tables", "fields", "visual_descriptions", "page_segments", "attachments", "summaries")


def _payload_key() -> Column:
    """Tells the payloads of a table apart, several versions of one document too."""
    return F.sha2(F.to_json(F.struct("document_id", "source_uri", "checksum", "payload", "metadata"), {"ignoreNullFields": "false"}), 256)


def parser_entries(payloads: DataFrame) -> DataFrame:
    """One row per parser of a combined payload, with the payload's key and the metadata its adapter sees."""
    rows = payloads.withColumns({"_p": F.from_json("payload", _MULTI), "_payload_key": _payload_key()})
    rows = rows.withColumn("_shared", merge_maps(json_map(F.col("_p.document_metadata")), _caller_metadata()))
    exploded = rows.select(
        "document_id", "source_uri", "checksum", "_payload_key", F.col("_shared"),
        F.posexplode("_p.parsers").alias("parser_ord", "_e"),
    )
    return exploded.select(
        "document_id", "source_uri", "checksum", F.col("_payload_key").alias("payload_key"), "parser_ord", F.col("_e.name").alias("parser_name"),
        F.col("_e.payload").alias("payload"),
        F.to_json(merge_maps(F.col("_shared"), json_map(F.col("_e.metadata")))).alias("metadata"),
    )


def merge_parsers(payloads: DataFrame, registry: dict[str, Adapter]) -> DataFrame:
    """Several parsers' outputs for one document, concatenated in parser order; each payload by itself.

    Parser names outside ``registry`` end up in ``adapter_error``, as does an empty parser list.
    Enrichments of the parts are not carried over.
    """
    if not registry:
        raise ValueError("at least one adapter is needed")
    entries = parser_entries(payloads)
    parts = []
    for name, run in registry.items():
        # the ordinal travels inside the id through the adapter
        mine = entries.where(F.col("parser_name") == name)
        tagged = mine.withColumn("document_id", F.to_json(F.struct("payload_key", "parser_ord", "parser_name")))
        parts.append(run(tagged.drop("payload_key")))
    adapted = reduce(DataFrame.unionByName, parts)
    key = F.from_json("document_id", "payload_key string, parser_ord int, parser_name string")
    ordered = adapted.withColumn("_key", key).select(
        F.col("_key.payload_key").alias("_payload_key"),
        F.struct(
            F.col("_key.parser_ord").alias("parser_ord"),
            F.coalesce(F.get_json_object("metadata", "$.provider"), F.col("_key.parser_name")).alias("provider"),
            "document_type", "mime_type", "adapter_error", *_MERGED_ARRAYS,
        ).alias("part"),
    )
    # a payload has as many parts as it lists parsers; a repeated row brings the same ones
    merged = ordered.groupBy("_payload_key").agg(F.array_sort(F.collect_set("part")).alias("parts"))
    rows = payloads.withColumns({"_p": F.from_json("payload", _MULTI), "_payload_key": _payload_key()})
    rows = rows.select(
        "document_id", "source_uri", "checksum", "payload", "_payload_key",
        merge_maps(json_map(F.col("_p.document_metadata")), _caller_metadata()).alias("_shared"),
        F.transform(F.coalesce("_p.parsers", F.array()), lambda e: e["name"]).alias("_names"),
        attachment_structs(F.col("_p.attachments"), require_id=True).alias("_extra"),
    )
    joined = rows.join(merged, "_payload_key", "left")

    def concat_parts(name: str) -> Column:
        return F.flatten(F.transform("parts", lambda part: part[name]))

    def first_of(name: str) -> Column:
        return F.get(F.array_compact(F.transform("parts", lambda part: part[name])), 0)

    used = F.to_json(F.transform("parts", lambda part: part["provider"]))
    listed = F.when(F.size("parts") > 0, F.create_map(F.lit("parsers_used"), used))
    unknown = F.filter("_names", lambda n: n.isNull() | ~n.isin(*registry))
    error = (
        F.when(F.size("_names") == 0, "payload must contain a non-empty 'parsers' list")
        .when(F.size(unknown) > 0, F.concat(F.lit("no adapter registered for parser "), F.array_join(unknown, ", ", "(none)")))
        .otherwise(first_of("adapter_error"))
    )
    shared = F.col("_shared")
    joined = joined.withColumns(
        {
            "_spans": concat_parts("text_spans"),
            "_tables": concat_parts("tables"),
            "_fields": concat_parts("fields"),
            "_visuals": concat_parts("visual_descriptions"),
            "_segments": concat_parts("page_segments"),
            "_attachments": F.concat(F.coalesce(concat_parts("attachments"), F.array().cast(f"array<{schemas.ATTACHMENT}>")), "_extra"),
            "_meta": merge_maps(_provider(MULTI), shared, listed),
        }
    )

    def shared_or_part(key: str) -> Column:
        return F.coalesce(F.try_element_at(shared, F.lit(key)), first_of(key))

    return _canonical(joined, shared_or_part("document_type"), shared_or_part("mime_type"), error)
