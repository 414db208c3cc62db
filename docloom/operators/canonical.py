"""Canonical documents: flat working tables and the stored nested form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.assembly import ordered_array
from docloom.functions.numbers import parse_int
from docloom.functions.records import non_empty
from docloom.functions.text import blank_to_null, collapse_whitespace


def _exploded(documents: DataFrame, array: str, ordinal: str, *, keep: tuple[str, ...] = ()) -> DataFrame:
    rows = documents.select("document_id", *keep, F.posexplode(array).alias(ordinal, "_x"))
    return rows.select("document_id", *keep, F.col(ordinal).cast("long").alias(ordinal), "_x.*")


def explode_spans(documents: DataFrame) -> DataFrame:
    return _exploded(documents, "text_spans", "ord")


def explode_tables(documents: DataFrame) -> DataFrame:
    return _exploded(documents, "tables", "ord")


def explode_cells(documents: DataFrame) -> DataFrame:
    """Every table cell as a row; the ordinals come from the arrays, so nothing is shuffled."""
    tables = explode_tables(documents).withColumnRenamed("ord", "table_ord")
    rows = tables.select("document_id", "table_ord", "table_id", F.posexplode("cells").alias("cell_ord", "_x"))
    return rows.select("document_id", "table_ord", "table_id", F.col("cell_ord").cast("long").alias("cell_ord"), "_x.*")


def explode_fields(documents: DataFrame) -> DataFrame:
    return _exploded(documents, "fields", "ord")


def explode_visuals(documents: DataFrame) -> DataFrame:
    return _exploded(documents, "visual_descriptions", "ord")


def explode_segments(documents: DataFrame) -> DataFrame:
    return _exploded(documents, "page_segments", "ord")


def explode_attachments(documents: DataFrame) -> DataFrame:
    return _exploded(documents, "attachments", "ord")


def explode_summaries(documents: DataFrame) -> DataFrame:
    return _exploded(documents, "summaries", "ord")


def explode_enrichments(documents: DataFrame) -> DataFrame:
    return _exploded(documents, "enrichments", "ord")


def assemble(documents: DataFrame, parts: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Nested rows from flat tables.

    ``parts`` maps an array name to ``(rows, ordinal, element columns)``.  Each array is built in
    chunks of 1024 ordinals first, so a document holding most of the rows is put together by many tasks
    and only its finished chunks meet; the row itself is as large as the document.
    """
    for name, (rows, ordinal, columns) in parts.items():
        whole = ordered_array(rows, ["document_id"], ordinal, F.struct(*columns), name)
        documents = documents.join(whole, "document_id", "left")
        documents = documents.withColumn(name, F.coalesce(name, F.array()))
    return documents


_OMITTED_WHEN_EMPTY = ("visual_descriptions", "page_segments", "attachments", "summaries", "enrichments")


def _embedded_json(column: str) -> Column:
    """Metadata is stored as JSON text; re-read it so the export nests it instead of quoting it."""
    return F.from_json(F.coalesce(column, F.lit("{}")), "map<string,string>")


def canonical_json(documents: DataFrame) -> DataFrame:
    """``document_id, canonical_document``: nulls left out, and optional arrays when empty."""
    present = [c for c in schemas.CANONICAL_COLUMNS if c in documents.columns]
    columns = []
    for name in present:
        if name == "metadata":
            columns.append(_embedded_json("metadata").alias("metadata"))
        elif name in _OMITTED_WHEN_EMPTY:
            columns.append(non_empty(name).alias(name))
        else:
            columns.append(F.col(name))
    return documents.select("document_id", F.to_json(F.struct(*columns)).alias("canonical_document"))


def flatten_tables(documents: DataFrame) -> DataFrame:
    """Cell rows with their table id."""
    cells = explode_cells(documents)
    return cells.select("document_id", "table_id", "row_index", "column_index", "content", "confidence")


def select_pages(rows: DataFrame, pages: list[int] | None, column: str = "page") -> DataFrame:
    """Rows of the requested pages; no list or an empty one keeps all."""
    return rows.where(F.col(column).isin([int(p) for p in pages])) if pages else rows


def select_requested_pages(rows: DataFrame, column: str = "page", requested: str = "pages") -> DataFrame:
    """Same with the wanted pages per row in an array column."""
    wanted = F.col(requested)
    return rows.where(wanted.isNull() | (F.size(wanted) <= 0) | F.array_contains(wanted, F.col(column)))


def page_tables(pages: DataFrame) -> DataFrame:
    """Extractor tables of a page as cells.

    ``pages`` has ``document_id, page_number`` and ``tables``, JSON text of a list whose cells use either
    spelling of row, column, text and box.
    """
    box = "array<double>"
    cell = (
        f"struct<row:string,rowIndex:string,col:string,columnIndex:string,text:string,content:string,bbox:{box},rect:{box}>"
    )
    tables = F.from_json("tables", f"array<struct<caption:string,cells:array<{cell}>>>")
    rows = pages.select("document_id", "page_number", F.posexplode(tables).alias("_t", "_table"))
    rows = rows.select("document_id", "page_number", "_t", "_table.caption", F.posexplode("_table.cells").alias("cell_ord", "_c"))
    c = F.col("_c")
    return rows.select(
        "document_id",
        "page_number",
        F.concat(F.lit("pdf-table-"), F.col("page_number").cast("string"), F.lit("-"), F.col("_t").cast("string")).alias("table_id"),
        "caption",
        "cell_ord",
        F.coalesce(parse_int(F.coalesce(c["row"], c["rowIndex"])), F.lit(0)).cast("int").alias("row_index"),
        F.coalesce(parse_int(F.coalesce(c["col"], c["columnIndex"])), F.lit(0)).cast("int").alias("column_index"),
        collapse_whitespace(F.coalesce(blank_to_null(c["text"]), c["content"])).alias("content"),
        F.coalesce(non_empty(c["bbox"]), c["rect"]).alias("bounding_box"),
    )
