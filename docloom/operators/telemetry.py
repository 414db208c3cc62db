"""Telemetry: metric points, tags, windowed metrics and alarms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WATERMARK = "10 minutes"
# Alarm settings.
QUEUE_DEPTH_THRESHOLD = 100
FAILURE_RATIO_THRESHOLD = 0.2
ALARM_PERIOD_SECONDS = 60
DASHBOARD_PERIOD_SECONDS = 300
ALARM_PERIODS, ALARM_POINTS = 3, 2

NUMERIC_FIELDS = ("latency_ms", "duration_ms", "batch_size", "successes", "failures", "queue_depth", "inflight", "receive_count")


def log_events(rows: DataFrame, name: Column, context: dict[str, str], event_time: Column) -> DataFrame:
    """Event rows; a field of the row beats the same field of the run context."""
    columns = {k: F.coalesce(F.col(k), F.lit(v)) if k in rows.columns else F.lit(v) for k, v in context.items()}
    return rows.withColumns({**columns, "event_name": name, "event_time": event_time})


def metric_points(events: DataFrame) -> DataFrame:
    """One row per metric value of an event, with its unit and queue."""

    def point(name: str, value: Column, unit: str) -> Column:
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"), F.lit(unit).alias("unit"))

    succeeded = F.col("status") == "succeeded"
    points = F.array(
        point("ParserSuccess", F.when(succeeded, 1), "Count"),
        point("ParserLatencyMs", F.when(succeeded, F.col("latency_ms")), "Milliseconds"),
        point("ParserFailure", F.when(F.col("status") == "failed", 1), "Count"),
        point("QueueDepthVisible", F.col("queue_depth"), "Count"),
        point("QueueDepthInFlight", F.col("inflight"), "Count"),
    )
    given = F.filter(points, lambda p: p["value"].isNotNull())
    kept = [c for c in ("event_id", "queue_url", "event_time") if c in events.columns]
    return events.select(*kept, F.explode(given).alias("_p")).select(*kept, "_p.*")


def numeric_fields(events: DataFrame, key: str) -> DataFrame:
    """Numeric event fields as rows."""
    names = [c for c in NUMERIC_FIELDS if c in events.columns]
    wide = events.select(key, *[F.col(c).cast("double").alias(c) for c in names])
    return wide.unpivot([key], names, "name", "value").where("value IS NOT NULL")


def tags(events: DataFrame, key: str) -> DataFrame:
    """All other non-null event fields as text rows."""
    names = [c for c in events.columns if c not in NUMERIC_FIELDS and c != key]
    wide = events.select(key, *[F.col(c).cast("string").alias(c) for c in names])
    return wide.unpivot([key], names, "name", "value").where("value IS NOT NULL")


def windowed_metrics(events: DataFrame, seconds: int) -> DataFrame:
    """Success, failure, mean latency and mean depth per queue and period.

    The same call serves a stream: there the watermark bounds the state.
    """
    if events.isStreaming:
        events = events.withWatermark("event_time", WATERMARK)
    period = F.window("event_time", f"{seconds} seconds")
    grouped = events.groupBy("queue_url", period.alias("period")).agg(
        F.count(F.when(F.col("status") == "succeeded", 1)).alias("successes"),
        F.count(F.when(F.col("status") == "failed", 1)).alias("failures"),
        F.avg("latency_ms").alias("mean_latency_ms"),
        F.avg("queue_depth").alias("mean_queue_depth"),
    )
    total = F.col("successes") + F.col("failures")
    return grouped.select(
        "queue_url", F.col("period.start").alias("period_start"), "successes", "failures", "mean_latency_ms", "mean_queue_depth",
        F.when(total > 0, F.col("failures") / total).otherwise(0.0).alias("failure_ratio"),
    )


def alarms(points: DataFrame, value: Column, threshold: float, period_seconds: int = ALARM_PERIOD_SECONDS) -> DataFrame:
    """``in_alarm`` per queue and period: enough of the last periods above the threshold.

    A missing period does not breach, which a frame over time (not over rows) gives.  The input is one
    row per queue and minute, so the window is small whatever the event volume.
    """
    timed = points.withColumns(
        {"_epoch": F.unix_seconds("period_start"), "breaching": F.coalesce((value > threshold).cast("int"), F.lit(0))}
    )
    frame = Window.partitionBy("queue_url").orderBy("_epoch").rangeBetween(-(ALARM_PERIODS - 1) * period_seconds, 0)
    return timed.withColumn("in_alarm", F.sum("breaching").over(frame) >= ALARM_POINTS).drop("_epoch")


def batch_summary(events: DataFrame) -> DataFrame:
    """Size, successes and failures per micro-batch."""
    return events.groupBy("run_id", "batch_id").agg(
        F.count(F.lit(1)).alias("batch_size"),
        F.count(F.when(F.col("status") == "succeeded", 1)).alias("successes"),
        F.count(F.when(F.col("status") == "failed", 1)).alias("failures"),
    )


def run_summary(batches: DataFrame) -> DataFrame:
    """Messages, batches and failures per run."""
    return batches.groupBy("run_id").agg(
        F.sum("batch_size").alias("messages"), F.count(F.lit(1)).alias("batches"), F.sum("failures").alias("failures")
    )
