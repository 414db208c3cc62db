"""Message ingestion as a structured stream.

Every micro-batch goes parse, split, route, write.  The query's checkpoint takes the place of message
acknowledgement: a batch counts as done only after all its tables are written, and a replayed batch
overwrites its own partitions, so nothing is written twice.  Another run, with another ``run_id``, writes
beside the earlier ones.

No message is too late: there is no watermark.  A delivery is handled once; a message that has succeeded is not
handled again; a failed one is tried again on each new delivery, until it is dead.  ``ledger`` holds what was handled.
Every delivery read is in exactly one of ``metadata`` (accepted), ``failures`` (rejected) and ``duplicates`` (with the
reason why it was not handled).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.config import RoutingConfig
from docloom.operators import routing, telemetry
from docloom.operators.content_routing import ContentAnalysis, route_content
from docloom.session import remove_folder
from docloom.sources import messages as msg
from docloom.streaming import deadletters
from docloom.streaming.ledger import Ledger, compared_deliveries, identified, latest_deliveries

TABLES = ("metadata", "routing", "failures", "duplicates", "dead_letters", "events", "handled")


@dataclass(frozen=True)
class IngestConfig:
    """Where a stream reads its rules from and writes to."""

    output_path: str
    checkpoint_path: str
    run_id: str = "run-0"
    routing: RoutingConfig = field(default_factory=RoutingConfig)
    # read anew in every batch, so rule changes need no restart
    rules: Callable[[SparkSession], DataFrame | None] = lambda spark: None
    # how documents' content is found and profiled; None routes by declared metadata alone
    content: ContentAnalysis | None = None
    max_receives: int = deadletters.MAX_RECEIVES
    # see ledger.Ledger; every so many batches it is compacted, with 0 never
    ledger_buckets: int = 16
    compact_every: int = 100
    # None drains what is there and stops
    interval: str | None = None

    def path(self, table: str) -> str:
        return f"{self.output_path}/{table}"


def write_batch(
    rows: DataFrame, path: str, run_id: str, batch_id: int, *partitions: str, metrics: dict[str, Column] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> dict:
    """Write a micro-batch's rows as the partition of its run and batch; a replay replaces all of it, even by nothing.

    Rebalancing merges the many small shuffle outputs into few files and splits a dominant partition value.  ``finish`` adds
    wide columns behind it, so that neither shuffle nor sort carries them.  ``metrics`` are aggregates observed while
    writing; they come from the last stage, where a retried task counts once.
    """
    rows = rows.hint("rebalance", *partitions)
    if finish:
        rows = finish(rows.sortWithinPartitions(*partitions) if partitions else rows)
    observation = Observation()
    if metrics:
        rows = rows.observe(observation, *[m.alias(n) for n, m in metrics.items()])
    writer = rows.write.mode("overwrite")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(f"{path}/run_id={run_id}/batch_id={batch_id}")
    return observation.get if metrics else {}


def process_batch(batch: DataFrame, batch_id: int, config: IngestConfig) -> None:
    """All writes of one micro-batch, from one written parse and one written routing.

    What several tables are made from is written, not persisted: cached rows keep every partition of the joins they come
    from, and each write would go over all of these, with a shuffle file of its own for each target.
    The handled keys come last: a batch that fails before is handled anew, under the same id, by its replay.
    """
    spark = batch.sparkSession
    ledger = Ledger(spark, config.path("handled"), config.ledger_buckets)
    scratch = f"{config.path('scratch')}/{config.run_id}-{batch_id}"

    def saved(rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{scratch}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{scratch}/{name}")

    try:
        batch = saved(identified(batch), "batch")
        latest, repeats = latest_deliveries(saved(compared_deliveries(batch), "compared"))
        repeats, judged = saved(repeats, "repeats"), saved(ledger.judge(latest, config.run_id, batch_id), "judged")
        fresh = judged.where("reason IS NULL").drop("sent_day", "bucket", "reason")
        # bodies are read again for the routing, which costs less than to write what was read
        read = msg.parse_messages(fresh, flag=config.routing.override_flag)
        parsed = saved(read.drop("doc"), "parsed")
        rules = config.rules(spark)
        if config.content is None:
            routed = routing.route_messages(msg.accepted(read), config.routing, rules)
        else:
            routed = route_content(msg.accepted(read), config.routing, rules, config.content)
        routed = saved(routed.drop("doc", "body"), "routed")
        now = F.current_timestamp()
        # an empty extension is a folder name of its own in the partition layout
        filed = routed.withColumn("file_type", F.coalesce(F.nullif("file_type", F.lit("")), F.lit("none")))
        write_batch(
            filed, config.path("metadata"), config.run_id, batch_id, "file_type",
            finish=lambda rows: routing.message_metadata(rows).withColumn("ingested_at", now),
        )
        write_batch(routed, config.path("routing"), config.run_id, batch_id, finish=routing.routing_record)
        failures = msg.rejected(parsed).withColumn("failed_at", now)
        write_batch(failures, config.path("failures"), config.run_id, batch_id)
        dead = deadletters.dead_messages(parsed, config.max_receives)
        kept = ["message_id", "delivery_key", "queue_url", "stream", "body", "receive_count", "sent_at", "failure_reason"]
        known = judged.where("reason IS NOT NULL").drop("sent_day", "bucket").withColumn("copies", F.lit(1).cast("long"))
        others = repeats.unionByName(known)
        others = others.select("message_id", "delivery_key", "queue_url", "stream", "body", "receive_count", "sent_at", "reason", "copies")
        write_batch(others, config.path("duplicates"), config.run_id, batch_id)
        write_batch(dead.select(*[c for c in kept if c in dead.columns]), config.path("dead_letters"), config.run_id, batch_id)
        status = F.when(F.col("failure_reason").isNull(), "succeeded").otherwise("failed")
        outcome = parsed.select(
            "message_id", "queue_url", F.col("source_path").alias("object_key"), "failure_reason", "receive_count", status.alias("status")
        )
        name = F.when(F.col("status") == "succeeded", "message_processed").otherwise("message_failed")
        events = telemetry.log_events(outcome, name, {"job_name": "message_ingestion", "run_id": config.run_id}, now)
        counts = {
            "batch_size": F.count(F.lit(1)), "successes": F.count(F.when(F.col("status") == "succeeded", 1)),
            "failures": F.count(F.when(F.col("status") == "failed", 1)),
        }
        size = write_batch(events.drop("run_id"), config.path("events"), config.run_id, batch_id, metrics=counts)
        row = spark.range(1).select(*[F.lit(size[c]).cast("long").alias(c) for c in counts], F.lit("completed").alias("status"))
        lifecycle = telemetry.log_events(row, F.lit("batch_processed"), {"job_name": "message_ingestion", "run_id": config.run_id}, now)
        write_batch(lifecycle.drop("run_id"), config.path("lifecycle"), config.run_id, batch_id)
        done = parsed.select("delivery_key", "receive_count", "sent_at", F.col("failure_reason").isNull().alias("succeeded"))
        # an older delivery that arrives later still is not handled either
        older = repeats.where("reason = 'superseded'").select("delivery_key", "receive_count", "sent_at", F.lit(False).alias("succeeded"))
        ledger.record(done.unionByName(older), config.run_id, batch_id)
    finally:
        remove_folder(spark, scratch)
    if config.compact_every and batch_id % config.compact_every == config.compact_every - 1:
        ledger.compact()


def start_ingest(messages: DataFrame, config: IngestConfig) -> StreamingQuery:
    """Start the stream on ``messages`` (see ``sources.messages.stream_messages``)."""
    writer = messages.writeStream.foreachBatch(lambda batch, batch_id: process_batch(batch, batch_id, config))
    writer = writer.option("checkpointLocation", config.checkpoint_path)
    writer = writer.trigger(processingTime=config.interval) if config.interval else writer.trigger(availableNow=True)
    return writer.start()


def lifecycle(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """The run's batch events, one small row for each batch."""
    return spark.read.parquet(config.path("lifecycle")).where(F.col("run_id") == config.run_id)


def run_summary(spark: SparkSession, config: IngestConfig) -> DataFrame:
    """Messages, batches and failures of the run, from its batch events."""
    return telemetry.run_summary(lifecycle(spark, config))


def write_run_summary(spark: SparkSession, config: IngestConfig, queue_url: str) -> None:
    """The run's totals, and its ``completed`` event, once its query has stopped; writing them again replaces them."""
    summary = run_summary(spark, config).drop("run_id").withColumns({"queue_url": F.lit(queue_url), "completed_at": F.current_timestamp()})
    summary.write.mode("overwrite").parquet(f"{config.path('run_summary')}/run_id={config.run_id}")
    context = {"job_name": "message_ingestion", "run_id": config.run_id}
    done = telemetry.log_events(summary.select("messages", "failures", F.lit("succeeded").alias("status")), F.lit("completed"), context, F.current_timestamp())
    done.drop("run_id").write.mode("overwrite").parquet(f"{config.path('run_events')}/run_id={config.run_id}")
