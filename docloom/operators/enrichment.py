"""Enrichment providers: dispatch in batches, response normalisation, merge onto documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.assembly import row_positions
from docloom.functions.numbers import parse_double
from docloom.functions.records import truthy
from docloom.functions.text import leading_keywords, sorted_keywords, token_count

# provider output: entries as JSON text of a list, optional duration and metadata
RESPONSE = "document_id string, enrichments string, raw_response string, duration_ms long, metadata string, error string"
_ENTRY = (
    "struct<enrichment_type:variant,type:variant,content:string,payload:string,data:string,confidence:string,model:variant,"
    "metadata:string>"
)


#: Calls whose responses leave a task as one batch; a batch for each call costs more than small calls do.
HELD_CALLS = 256

# stands between id and checksum of a version while providers have it; no id holds it
_MARK = "\u0001"


@dataclass(frozen=True)
class Provider:
    """A named provider: native (``DataFrame -> responses``) or a function over pandas batches.

    ``timeout_seconds`` is handed to the function's own client; Spark does not interrupt a running batch.
    """

    name: str
    native: Callable[[DataFrame], DataFrame] | None = None
    batch: Callable[[pd.DataFrame], pd.DataFrame] | None = None
    max_batch_size: int = 8
    timeout_seconds: float | None = None


def _nullable(values: pd.Series) -> list:
    return [None if pd.isna(v) else v for v in values.tolist()]


def call_provider(documents: DataFrame, provider: Provider, order: str | None = None) -> DataFrame:
    """Responses of a provider; each slice of at most ``max_batch_size`` documents is one call.

    Slices run on over the batches of a task.  With ``order`` they are the same whatever the partitions: consecutive
    documents in the order of that column, every slice but the last full.  A failing slice yields one error row for each of
    its documents instead of responses and leaves the other slices alone.
    """
    if provider.native is not None:
        return provider.native(documents)
    size, run = max(1, int(provider.max_batch_size)), provider.batch
    names = [c.split()[0] for c in RESPONSE.split(", ")]

    def answers(part: pd.DataFrame) -> dict[str, list]:
        try:
            result = run(part)
        except Exception as error:
            result = pd.DataFrame({"document_id": part["document_id"], "error": f"{type(error).__name__}: {error}"})
        rows = 0 if result is None else len(result)
        return {n: _nullable(result[n]) if rows and n in result.columns else [None] * rows for n in names}

    def together(parts: list[dict[str, list]]) -> pd.DataFrame:
        return pd.DataFrame({n: [v for part in parts for v in part[n]] for n in names}, dtype=object)

    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, made = None, []
        for frame in batches:
            held = frame if held is None or not len(held) else pd.concat([held, frame], ignore_index=True)
            whole = len(held) - len(held) % size
            for start in range(0, whole, size):
                made.append(answers(held.iloc[start : start + size]))
                if len(made) == HELD_CALLS:
                    yield together(made)
                    made = []
            held = held.iloc[whole:]
        if held is not None and len(held):
            made.append(answers(held))
        yield together(made)

    if order is None:
        return documents.mapInPandas(slices, RESPONSE)
    numbered = batch_numbers(documents, size, order)

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        return together([answers(frame.sort_values(order, kind="stable").drop(columns="batch").reset_index(drop=True))])

    return numbered.groupBy("batch").applyInPandas(one, RESPONSE)


def batch_numbers(documents: DataFrame, size: int, order: str, keys: Iterable[str] = ()) -> DataFrame:
    """Request batches of ``size`` documents in the order of any column, numbered without a global sort in one task."""
    numbered = row_positions(documents, [order], "_position", list(keys))
    return numbered.withColumn("batch", F.floor(F.col("_position") / max(1, size)).cast("long")).drop("_position")


def _text_or_null(value: Column) -> Column:
    """Variant that is a non-empty string, else null."""
    return F.when(F.schema_of_variant(value) == "STRING", F.nullif(value.cast("string"), F.lit("")))


def _present(value: Column) -> Column:
    """A variant an ``or`` chain stops at: any string but '', any other non-null value."""
    kind = F.schema_of_variant(value)
    return (kind != "VOID") & (value.cast("string") != "")


def _mapping(value: Column) -> Column:
    """JSON text of a non-empty object, list or scalar; null for what an ``or`` chain skips."""
    kept = truthy(value)
    return F.when(kept.isin("{}", "[]"), None).otherwise(kept)


def normalise_responses(responses: DataFrame, provider: str) -> DataFrame:
    """Enrichment rows of provider responses.

    Entries need a string type and object content; a bad confidence or model becomes null, bad metadata empty.
    """
    entries = F.from_json("enrichments", f"array<{_ENTRY}>")
    # the generator keeps the optimizer from working a native answer out again for the test that there is one
    answers = responses.withColumn("enrichments", F.explode(F.array("enrichments")))
    rows = answers.where("enrichments IS NOT NULL").select(
        "document_id", "raw_response", "duration_ms", F.col("metadata").alias("_response_metadata"),
        F.posexplode(entries).alias("ord", "_e"),
    )
    e = F.col("_e")
    kind = F.when(_present(e["enrichment_type"]), _text_or_null(e["enrichment_type"])).otherwise(_text_or_null(e["type"]))
    content = F.coalesce(_mapping(e["content"]), _mapping(e["payload"]), e["data"], F.lit("{}"))
    own = F.when(e["metadata"].startswith("{"), F.from_json(e["metadata"], "map<string,string>"))
    extra = F.map_from_entries(
        F.filter(
            F.array(
                F.struct(F.lit("response_metadata").alias("k"), _mapping(F.col("_response_metadata")).alias("v")),
                F.struct(F.lit("raw_response").alias("k"), F.col("raw_response").alias("v")),
                F.struct(F.lit("duration_ms").alias("k"), F.col("duration_ms").cast("string").alias("v")),
            ),
            lambda x: x["v"].isNotNull(),
        )
    )
    own = F.coalesce(own, F.from_json(F.lit("{}"), "map<string,string>"))
    metadata = F.map_concat(own, F.map_filter(extra, lambda k, _: ~F.map_contains_key(own, k)))
    rows = rows.withColumns({"_kind": kind, "_content": content})
    return rows.where(F.col("_kind").isNotNull() & F.col("_content").startswith("{")).select(
        "document_id",
        F.col("ord").cast("long").alias("ord"),
        F.col("_kind").alias("enrichment_type"),
        F.lit(provider).alias("provider"),
        F.col("_content").alias("content"),
        parse_double(e["confidence"]).alias("confidence"),
        _text_or_null(e["model"]).alias("model"),
        "duration_ms",
        F.to_json(metadata).alias("metadata"),
    )


def dispatch(documents: DataFrame, providers: Iterable[Provider], names: Iterable[str], order: str | None = None) -> DataFrame:
    """Enrichment rows of the named providers in request order; unknown names and unknown documents are dropped.

    ``order`` names the column by which documents are put into request batches (see ``call_provider``).  Where documents have
    a ``checksum``, versions of one document are kept apart: providers see ids with the checksum behind a mark, and the rows
    have both again.
    """
    known = {p.name: p for p in providers}
    versions = "checksum" in documents.columns
    if versions:
        documents = documents.withColumn("document_id", F.concat("document_id", F.lit(_MARK), F.coalesce("checksum", F.lit(""))))
    found = []
    for rank, name in enumerate(names):
        if name in known:
            rows = normalise_responses(call_provider(documents, known[name], order), name)
            found.append(rows.withColumn("ord", F.lit(rank * (1 << 32)) + F.col("ord")))
    if not found:
        raise ValueError("none of the requested providers is configured")
    rows = reduce(DataFrame.unionByName, found)
    rows = rows.join(documents.select("document_id").distinct(), "document_id", "left_semi")
    if versions:
        parts = {"checksum": F.nullif(F.substring_index("document_id", _MARK, -1), F.lit("")), "document_id": F.substring_index("document_id", _MARK, 1)}
        rows = rows.withColumns(parts)
    return rows


def merge_enrichments(documents: DataFrame, enrichments: DataFrame) -> DataFrame:
    """Documents with their enrichment array; documents without any get an empty one.

    The array holds one entry per provider answer, a number the request fixes.  Versions of a document take their own
    enrichments where these have a checksum.
    """
    keys = ["document_id", "checksum"] if "checksum" in enrichments.columns and "checksum" in documents.columns else ["document_id"]
    columns = [c.split(":")[0] for c in schemas.ENRICHMENT[len("struct<"):-1].split(",")]
    listed = enrichments.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("ord", F.struct(*columns).alias("v")))).alias("_listed")
    ).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = documents.join(listed, same, "left").drop(*[f"_{k}" for k in keys])
    made = F.transform(F.coalesce("_listed", F.array()), lambda x: x["v"])
    existing = F.col("enrichments") if "enrichments" in documents.columns else F.array()
    return joined.withColumn("enrichments", F.concat(existing, made)).drop("_listed")


def _response(documents: DataFrame, kind: str, content: Column, confidence: float | None, metadata: str) -> DataFrame:
    entry = F.struct(
        F.lit(kind).alias("enrichment_type"), content.alias("content"), F.lit(confidence).cast("double").alias("confidence")
    )
    none = F.lit(None)
    return documents.select(
        "document_id", F.to_json(F.array(entry)).alias("enrichments"), none.cast("string").alias("raw_response"),
        none.cast("long").alias("duration_ms"), F.lit(metadata).alias("metadata"), none.cast("string").alias("error"),
    )


def leading_keyword_provider(text: str = "text", limit: int = 5) -> Provider:
    """First distinct long tokens of a document."""

    def native(documents: DataFrame) -> DataFrame:
        content = F.struct(leading_keywords(text, 6, limit).alias("keywords"))
        return _response(documents, "keyword_extraction", content, 0.6, '{"method":"heuristic_ngram"}')

    return Provider("keyword_extraction", native=native)


def sorted_keyword_provider(name: str = "keyword_insights", text: str = "text", limit: int = 10, confidence: float | None = 0.55) -> Provider:
    """Alphabetically first long words and the token count of a document."""

    def native(documents: DataFrame) -> DataFrame:
        content = F.struct(sorted_keywords(text, limit).alias("keywords"), token_count(text).alias("token_count"))
        return _response(documents, "keyword_summary", content, confidence, '{"provider":"keyword_stub"}')

    return Provider(name, native=native)
