"""Routing by content: what a document holds decides, its declared metadata only where nothing else does.

Content comes from a chain of resolvers.  Its pages come from a layout model, then from a decoder for PDFs or the parts of an
e-mail, then from the metadata.  Whatever fails, fails for one document: the next way is taken for it.  All of this is one
Python pass over the rows, between narrow stages; only resolvers that are joins shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.config import RoutingConfig
from docloom.operators import layout, routing
from docloom.sources import formats
from docloom.sources import messages as msg
from docloom.sources.content import resolve_content

#: What resolvers and models are told about a document.
DESCRIPTOR = ("source_path", "source_uri", "bucket", "file_type", "mime_type")
#: Densities of message parts (characters of a full page, shares of one image and one table).
PLAIN_CHARS, HTML_CHARS, PLAIN_IMAGE, IMAGE_SHARE, TABLE_SHARE = 3000.0, 4000.0, 0.05, 0.1, 0.25


@dataclass(frozen=True)
class ContentAnalysis:
    """How content is found and read.

    ``resolvers``: see ``sources.content.resolve_content``; the payload inlined in the message comes before them.
    ``decoders``: page payloads of a format (``"pdf"``) from its bytes.  ``model``: page payloads, or None, for each of a
    list of descriptors with their ``content``; it gets ``slice_rows`` documents at a time and, where that fails, each alone.
    Page payloads are dictionaries with the keys of a message's page list, in either spelling.
    """

    resolvers: tuple = ()
    decoders: Mapping[str, Callable[[bytes], list[dict]]] = field(default_factory=dict)
    model: Callable[[list[dict]], list[list[dict] | None]] | None = None
    slice_rows: int = 64


def _email_pages(content: bytes) -> list[dict]:
    pages = []
    for index, (is_html, text) in enumerate(formats.message_texts(content)):
        if is_html:
            chars, tables, images, boxes, radios = layout.count_layout(text)
            density, image, table = chars / HTML_CHARS, min(images * IMAGE_SHARE, 1.0), min(tables * TABLE_SHARE, 1.0)
        else:
            chars, tables, images, boxes, radios = len(text.strip()), 0, 0, 0, 0
            density, image, table = chars / PLAIN_CHARS, PLAIN_IMAGE, 0.0
        pages.append({
            "index": index, "text_density": min(density, 1.0), "image_density": image, "table_density": table, "char_count": chars,
            "table_count": tables, "image_count": images, "checkbox_count": boxes, "radio_button_count": radios,
        })
    return pages


def _format(one: dict) -> str | None:
    mime, key = (one["mime_type"] or "").lower(), (one["source_path"] or "").lower()
    if mime in layout.PDF_TYPES or key.endswith(".pdf"):
        return "pdf"
    return "email" if mime in layout.EMAIL_TYPES or key.endswith((".eml", ".msg")) else None


def _quietly(work: Callable, *given):
    """A result, or None where the work fails: the next way is taken."""
    try:
        return work(*given)
    except Exception:
        return None


def _analyse(analysis: ContentAnalysis) -> Callable:
    # resolvers may hold DataFrames, which do not travel
    model, decoders, slice_rows = analysis.model, dict(analysis.decoders), analysis.slice_rows

    def modelled(asked: list[dict]) -> list:
        out = []
        for first in range(0, len(asked), slice_rows):
            part = asked[first : first + slice_rows]
            found = _quietly(model, part)
            if found is None or len(found) != len(part):
                alone = [_quietly(model, [one]) for one in part]
                found = [f[0] if f else None for f in alone]
            out += found
        return out

    def decoded(one: dict | None) -> list[dict] | None:
        if not one or not one["content"]:
            return None
        kind = _format(one)
        if kind in decoders:
            return _quietly(decoders[kind], one["content"])
        return _quietly(_email_pages, one["content"]) if kind == "email" else None

    def analyse(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for documents in columns:
            asked = documents.to_pylist()
            pages = modelled(asked) if model else [None] * len(asked)
            texts = [_quietly(json.dumps, p or decoded(one)) for one, p in zip(asked, pages, strict=True)]
            yield pa.array([t if t not in (None, "null", "[]") else None for t in texts], pa.string())

    return analyse


def content_pages(documents: DataFrame, analysis: ContentAnalysis, output: str = "content_pages") -> DataFrame:
    """Add the page metrics found in ``content``, null where there are none."""
    # without a model, only content that has a reader is handed to Python
    mime, key = F.lower(F.coalesce("mime_type", F.lit(""))), F.lower(F.coalesce("source_path", F.lit("")))
    readable = mime.isin(*layout.PDF_TYPES, *layout.EMAIL_TYPES) | key.rlike(r"[.](pdf|eml|msg)$")
    asked = F.struct(*DESCRIPTOR, "content")
    if analysis.model is None:
        asked = F.when(readable & (F.length("content") > 0), asked)
    rows = documents.withColumn("_pages", F.arrow_udf(_analyse(analysis), "string")(asked))
    listed = F.from_json("_pages", f"array<{schemas.PAGE_PAYLOAD}>")
    return rows.withColumn(output, F.transform(listed, layout.page_metrics)).drop("_pages")


def route_content(
    accepted: DataFrame, config: RoutingConfig, rules: DataFrame | None = None, analysis: ContentAnalysis | None = None
) -> DataFrame:
    """Describe, resolve, profile and route accepted messages; ``resolver_errors`` lists what resolvers could not do."""
    analysis = analysis or ContentAnalysis()
    described = msg.describe(accepted, config.override_flag)
    laid_out = layout.message_layout(described).withColumn("_inline", msg.inline_bytes(F.col("doc")))
    resolved = resolve_content(laid_out, [("_inline", None), *analysis.resolvers], "content", DESCRIPTOR)
    paged = content_pages(resolved, analysis)
    pages = F.when(F.size("content_pages") > 0, F.col("content_pages")).otherwise(F.col("listed_pages"))
    paged = paged.withColumn("listed_pages", pages).drop("content_pages", "content")
    return routing.choose_strategy(layout.profile_messages(paged), config, rules)
