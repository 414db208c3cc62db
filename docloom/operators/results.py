"""Job ledger, results pages and completion notifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.assembly import latest_per_key
from docloom.functions.records import format_wire_time, parse_wire_time

_ENRICHMENTS = "array<struct<name:string,status:string,started_at:string,completed_at:string,detail:string>>"
_NOTIFICATION = "struct<sns_topic_arn:string,webhook_url:string,include_enrichment_events:boolean>"


def submitted_jobs(requests: DataFrame, now: Column) -> DataFrame:
    """First ledger event of submitted requests."""
    return requests.select(
        "job_id", F.lit("queued").alias("status"), now.alias("submitted_at"), now.alias("updated_at"),
        F.to_json("metadata").alias("metadata"), F.to_json("notification_config").alias("notification_config"),
    )


def latest_jobs(events: DataFrame) -> DataFrame:
    """Current ledger row per job: the last update wins."""
    return latest_per_key(events, ["job_id"], ["updated_at", "status"])


def parse_ledger(records: DataFrame) -> DataFrame:
    """Wire-format ledger records with typed times and enrichment progress."""

    def progress(e: Column) -> Column:
        return F.struct(
            e["name"].alias("name"), e["status"].alias("status"), parse_wire_time(e["started_at"]).alias("started_at"),
            parse_wire_time(e["completed_at"]).alias("completed_at"), e["detail"].alias("detail"),
        )

    listed = F.coalesce(F.from_json("enrichments", _ENRICHMENTS), F.array())
    return records.withColumns(
        {
            "submitted_at": parse_wire_time("submitted_at"),
            "updated_at": parse_wire_time("updated_at"),
            "enrichments": F.transform(listed, progress),
        }
    )


def terminal(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("status").isin(*schemas.TERMINAL_STATUSES))


def ready(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("status").isin(*schemas.READY_STATUSES))


def page_size(requested: int | None, configured: int = 50) -> int:
    if requested is None or requested <= 0:
        return configured
    return min(requested, configured)


def results_page(results: DataFrame, jobs: DataFrame, job_id: str, size: int, offset: int = 0) -> DataFrame:
    """One page of a ready job's documents by sequence, with the offset of the next page (null on the last).

    One row more than asked for is looked at to know whether a next page exists.  Offsets re-read what
    lies before them; ``results_after`` does not.
    """
    wanted = results.where(F.col("job_id") == job_id)
    open_jobs = ready(jobs).where(F.col("job_id") == job_id).select("job_id")
    gated = wanted.join(open_jobs, "job_id", "left_semi")
    window = gated.orderBy("sequence").offset(offset).limit(size + 1)
    # at most size + 1 rows from here on
    numbered = window.groupBy("job_id").agg(F.array_sort(F.collect_list(F.struct("sequence", "canonical_document"))).alias("_rows"))
    token = F.when(F.size("_rows") > size, F.lit(offset + size))
    return numbered.select(
        "job_id", F.explode(F.slice("_rows", 1, size)).alias("_row"), token.cast("long").alias("next_offset")
    ).select("job_id", "_row.*", "next_offset")


def results_after(results: DataFrame, jobs: DataFrame, job_id: str, size: int, last_sequence: int | None = None) -> DataFrame:
    """Keyset page: rows behind the last seen sequence; the filter reaches the scan."""
    wanted = results.where(F.col("job_id") == job_id)
    if last_sequence is not None:
        wanted = wanted.where(F.col("sequence") > last_sequence)
    open_jobs = ready(jobs).where(F.col("job_id") == job_id).select("job_id")
    return wanted.join(open_jobs, "job_id", "left_semi").orderBy("sequence").limit(size)


def result_counts(results: DataFrame, jobs: DataFrame) -> DataFrame:
    """Documents and pages every ready job offers."""
    gated = results.join(ready(jobs).select("job_id"), "job_id", "left_semi")
    return gated.groupBy("job_id").agg(F.count(F.lit(1)).alias("documents"), F.max("sequence").alias("last_sequence"))


def notification_outbox(jobs: DataFrame, emitted: DataFrame, published_at: Column) -> DataFrame:
    """One outbox row per ready job with a notification target that was not served before.

    Enrichment progress is left out where the job asked for that.
    """
    parsed = jobs.withColumn("_config", F.from_json("notification_config", _NOTIFICATION))
    due = ready(parsed).where(F.col("_config").isNotNull() & ~F.coalesce("notifications_emitted", F.lit(False)))
    due = due.join(emitted.select("job_id"), "job_id", "left_anti")
    include = F.coalesce(F.col("_config.include_enrichment_events"), F.lit(True))
    listed = F.coalesce(F.col("enrichments"), F.lit("[]"))
    targets = F.filter(
        F.array(
            F.struct(F.lit("sns").alias("kind"), F.col("_config.sns_topic_arn").alias("target")),
            F.struct(F.lit("webhook").alias("kind"), F.col("_config.webhook_url").alias("target")),
        ),
        lambda t: t["target"] != "",
    )
    return due.select(
        "job_id", "status", F.when(include, listed).otherwise("[]").alias("enrichments"),
        format_wire_time(published_at).alias("published_at"), F.explode(targets).alias("_t"),
    ).select("job_id", "status", "enrichments", "published_at", "_t.kind", "_t.target")
