"""Document summaries: the leading-sentence heuristic and model responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.assembly import ordered_concat
from docloom.functions.numbers import parse_double
from docloom.functions.records import truthy
from docloom.functions.text import once, sentences, strip, strip_to_null, title_like, truncate_at_space

# Fixed values of a heuristic summary.
HEURISTIC = "heuristic_leading_sentences"
HEURISTIC_CONFIDENCE = 0.3
HEURISTIC_JUSTIFICATION = "Generated via deterministic leading-sentence heuristic fallback."
MODEL_METHOD = "azure_openai"
MODEL_CONFIDENCE = 0.7


def distinct_contents(contents: Column) -> Column:
    """Stripped non-empty texts, first occurrence kept, order kept."""
    return F.array_distinct(F.filter(F.transform(contents, strip), lambda c: c != ""))


def summary_text(text: Column) -> Column:
    """First two sentences, cut to 512 characters at a space; null for blank text."""
    joined = F.array_join(F.slice(sentences(text, 2), 1, 2), " ")
    # only blank text has no sentence
    return once(joined, lambda j: F.when(j != "", truncate_at_space(j, 512)))


def title(contents: Column) -> Column:
    """First span short enough to be a title; it need not be part of the summary."""
    return F.get(F.filter(F.transform(contents, strip), lambda c: (c != "") & title_like(c)), 0)


def _summary(summary: Column, confidence: Column, method: Column, title_: Column, model: Column, why: Column, meta: Column) -> Column:
    names = ("summary", "confidence", "method", "title", "model", "justification", "metadata")
    return F.struct(*[c.alias(n) for n, c in zip(names, (summary, confidence, method, title_, model, why, meta))])


def heuristic_summaries(documents: DataFrame, contents: str = "contents") -> DataFrame:
    """Summary of documents that hold their span texts in one array column; no shuffle.

    The whole text takes part: only its first two sentences can reach the summary.
    """
    staged = documents.withColumn("_distinct", distinct_contents(F.col(contents)))
    staged = staged.withColumn("_text", F.array_join("_distinct", "\n"))
    none = F.lit(None).cast("string")
    summary = _summary(
        summary_text(F.col("_text")), F.lit(HEURISTIC_CONFIDENCE), F.lit(HEURISTIC), title(F.col("_distinct")), none,
        F.lit(HEURISTIC_JUSTIFICATION), none,
    )
    staged = staged.withColumn("summary", summary).drop("_distinct", "_text")
    return staged.where(F.col("summary.summary").isNotNull())


def summary_input(spans: DataFrame, max_characters: int | None = None) -> DataFrame:
    """Deduplicated text per document from flat spans, for a summarising model.

    First occurrences come from a map-side combined minimum, the text from chunked concatenation.
    """
    bare = spans.select("document_id", "ord", strip_to_null("content").alias("_content")).where("_content IS NOT NULL")
    first = bare.groupBy("document_id", "_content").agg(F.min("ord").alias("ord"))
    joined = ordered_concat(first, ["document_id"], "ord", "_content", "\n", "text")
    return joined.withColumn("text", F.substring("text", 1, max_characters)) if max_characters else joined


def _response_content(response: Column) -> Column:
    """Text of the first choice: message content, choice content, or joined fragments."""
    choice = "$.choices[0]"
    content = F.coalesce(
        F.get_json_object(response, f"{choice}.message.content"), F.get_json_object(response, f"{choice}.content")
    )
    fragments = F.from_json(content, "array<struct<text:string>>")
    joined = F.array_join(F.transform(fragments, lambda f: F.coalesce(f["text"], F.lit(""))), "")
    return F.when(content.startswith("["), joined).otherwise(content)


def model_summary(response: Column, deployment: Column) -> Column:
    """Summary struct of a chat response; null when there is no usable summary text."""
    body = _response_content(response)

    def value(key: str) -> Column:
        return F.get_json_object(body, f"$.{key}")

    metadata = F.when(value("metadata").startswith("{"), value("metadata"))
    summary = _summary(
        strip_to_null(value("summary")),
        F.coalesce(parse_double(value("confidence")), F.lit(MODEL_CONFIDENCE)),
        F.lit(MODEL_METHOD),
        strip_to_null(value("title")),
        F.coalesce(strip_to_null(value("model")), deployment),
        strip_to_null(F.coalesce(truthy(value("justification")), value("reasoning"))),
        metadata,
    )
    return F.when(strip_to_null(value("summary")).isNotNull(), summary)


def summarise(documents: DataFrame, contents: str = "contents", response: str | None = None, deployment: str = "") -> DataFrame:
    """One summary per document with text: the model's where its response is usable, else the heuristic one."""
    heuristic = heuristic_summaries(documents, contents)
    if response is None:
        return heuristic
    return heuristic.withColumn("summary", F.coalesce(model_summary(F.col(response), F.lit(deployment)), F.col("summary")))


def add_summaries(documents: DataFrame) -> DataFrame:
    """Append the heuristic summary to nested canonical documents, in the row."""
    staged = documents.withColumn("_contents", F.transform("text_spans", lambda s: s["content"]))
    staged = staged.withColumn("_distinct", distinct_contents(F.col("_contents")))
    none = F.lit(None).cast("string")
    made = _summary(
        summary_text(F.array_join("_distinct", "\n")), F.lit(HEURISTIC_CONFIDENCE), F.lit(HEURISTIC),
        title(F.col("_distinct")), none, F.lit(HEURISTIC_JUSTIFICATION), none,
    )
    return staged.withColumn("_made", made).withColumn(
        "summaries", F.when(F.col("_made.summary").isNotNull(), F.concat("summaries", F.array("_made"))).otherwise(F.col("summaries"))
    ).drop("_contents", "_distinct", "_made")


__all__ = [
    "add_summaries", "distinct_contents", "heuristic_summaries", "model_summary", "summarise", "summary_input", "summary_text",
    "title",
]
