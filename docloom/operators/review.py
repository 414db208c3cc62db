"""Human review: candidates, queue upsert, state changes, comments and outcome events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.assembly import ordered_array, row_positions
from docloom.functions.text import blank_to_null

DEFAULT_TRIGGER = schemas.REVIEW_TRIGGERS[0]
_PAYLOAD = ("canonical_document", "standardized_output", "insights", "job_id")
KEY = ["document_id", "trigger"]


def candidates_from_rows(rows: DataFrame) -> DataFrame:
    """Candidates of a warehouse table whose JSON columns may be text or bytes."""
    text = {c: F.col(c).cast("string") for c in ("canonical_document", "standardized_output", "insights")}
    return rows.where("review_required").select(
        "document_id", "job_id", F.col("review_trigger").alias("trigger"), "created_at", *[v.alias(k) for k, v in text.items()]
    )


def candidates_from_payloads(results: DataFrame) -> DataFrame:
    """Candidates whose parts are keys of the canonical payload; missing parts are ``{}``."""

    def part(key: str) -> Column:
        return F.get_json_object("canonical_document", f"$.{key}")

    return results.select(
        part("document_id").alias("document_id"),
        part("job_id").alias("job_id"),
        part("review_trigger").alias("trigger"),
        "canonical_document",
        F.coalesce(part("standardized_output"), F.lit("{}")).alias("standardized_output"),
        F.coalesce(part("insights"), F.lit("{}")).alias("insights"),
    )


def newest(candidates: DataFrame, limit: int) -> DataFrame:
    """The most recent candidates, ids breaking ties."""
    return candidates.orderBy(F.desc("created_at"), "document_id").limit(limit)


def sync_reviews(reviews: DataFrame, candidates: DataFrame, now: Column) -> DataFrame:
    """Review table after taking in candidates.

    New ``(document_id, trigger)`` pairs start as pending; known ones get the new payload while status,
    assignee and outcome stay.  A candidate without a title keeps the old one.
    """
    title = F.get_json_object("canonical_document", "$.title")
    incoming = candidates.select(
        "document_id",
        F.coalesce(blank_to_null("trigger"), F.lit(DEFAULT_TRIGGER)).alias("trigger"),
        F.struct(*_PAYLOAD, title.alias("title")).alias("_new"),
    )
    # several candidates of one pair leave one row; the greatest payload makes the choice stable
    incoming = incoming.groupBy(*KEY).agg(F.max("_new").alias("_new"))
    joined = reviews.withColumn("_old", F.lit(True)).join(incoming, KEY, "full_outer")
    known, fresh = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    columns = []
    for name in (c.split()[0] for c in schemas.REVIEW.split(",")):
        current = F.col(name)
        if name in _PAYLOAD:
            value = F.when(fresh, F.col(f"_new.{name}")).otherwise(current)
        elif name == "title":
            value = F.coalesce(F.col("_new.title"), current, F.lit(""))
        elif name == "status":
            value = F.when(known, current).otherwise("pending")
        elif name == "created_at":
            value = F.when(known, current).otherwise(now)
        elif name == "updated_at":
            value = F.when(fresh, now).otherwise(current)
        else:
            value = current
        columns.append(value.alias(name))
    return joined.select(*columns)


def review_states(events: DataFrame) -> DataFrame:
    """State per review after its events.

    ``events``: ``document_id, trigger, event`` (``assign``, ``unassign``, ``complete``), ``user, outcome,
    reviewed_canonical, reviewed_standardized, reviewed_insights, at``.  Every attribute is the last
    value an event gave it, so one map-side combined aggregate is enough.
    """
    event, at = F.col("event"), F.col("at")

    def last(value: Column, given: Column) -> Column:
        return F.max_by(value, F.when(given, at))

    status = F.when(event == "assign", "in_progress").when(event == "unassign", "pending").otherwise("completed")
    assignee = F.when(event != "unassign", F.col("user"))
    done = event == "complete"

    def reviewed(name: str) -> Column:
        return last(F.col(name), done & F.col(name).isNotNull()).alias(name)

    return events.groupBy(*KEY).agg(
        last(status, F.lit(True)).alias("status"),
        last(assignee, F.lit(True)).alias("assigned_to"),
        last(F.col("outcome"), done).alias("outcome"),
        F.max(F.when(event == "assign", at)).alias("assigned_at"),
        F.max(F.when(done, at)).alias("latest_reviewed_at"),
        reviewed("reviewed_canonical"),
        reviewed("reviewed_standardized"),
        reviewed("reviewed_insights"),
    )


def review_queue(
    reviews: DataFrame,
    trigger: str | None = None,
    status: str | None = None,
    unassigned: bool = False,
    mine: str | None = None,
) -> DataFrame:
    """Filters of the review list; each one is optional."""
    if trigger:
        reviews = reviews.where(F.col("trigger") == trigger)
    if status:
        reviews = reviews.where(F.col("status") == status)
    if unassigned:
        reviews = reviews.where(F.col("assigned_to").isNull())
    if mine:
        reviews = reviews.where(F.col("assigned_to") == mine)
    return reviews


def review_page(reviews: DataFrame, page: int, size: int = 25) -> DataFrame:
    """One list page, newest first."""
    order = [F.desc("created_at"), "document_id", "trigger"]
    return reviews.orderBy(*order).offset((page - 1) * size).limit(size)


def facets(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("status", "trigger", "outcome").agg(F.count(F.lit(1)).alias("reviews"))


def comments_in_order(reviews: DataFrame, comments: DataFrame) -> DataFrame:
    """Reviews with their comments by ``position``, a time or any other order; ties by author and text.

    Comments are numbered first, so that a review with most of them is put together in pieces of 1024.
    """
    numbered = row_positions(comments.select(*KEY, "position", "author", "comment"), ["position"], "_place", KEY, ["author", "comment"])
    listed = ordered_array(numbered, KEY, "_place", F.struct("author", "comment"), "comments")
    return reviews.join(listed, KEY, "left").withColumn("comments", F.coalesce("comments", F.array()))


def _effective(reviewed: str, original: str) -> Column:
    return F.coalesce(F.when(~F.col(reviewed).isin("", "{}", "[]"), F.col(reviewed)), F.col(original))


def outcome_events(reviews: DataFrame) -> DataFrame:
    """Outbox events of completed reviews; reviewed payloads replace the originals where given."""
    payload = F.struct(
        "document_id", "job_id", "trigger", "outcome",
        _effective("reviewed_canonical_document", "canonical_document").alias("canonical_document"),
        _effective("reviewed_standardized_output", "standardized_output").alias("standardized_output"),
        _effective("reviewed_insights", "insights").alias("insights"),
    )
    return reviews.where("status = 'completed'").select(
        "document_id", "trigger", F.to_json(payload).alias("payload"), F.lit("pending").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )


def publish_outcomes(events: DataFrame, results: DataFrame) -> DataFrame:
    """Outbox status after publishing: ``results`` holds the key and ``error`` (null when sent)."""
    outcome = results.select(*KEY, F.col("error").alias("_error"), F.lit(True).alias("_tried"))
    joined = events.join(outcome, KEY, "left")
    status = F.when(F.col("_tried").isNull(), F.col("status")).when(F.col("_error").isNull(), "sent").otherwise("failed")
    return joined.withColumns({"status": status, "error_message": F.col("_error")}).drop("_error", "_tried")
