"""Registered queries: the streams, drained over whole tables and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators import telemetry, workflow
from docloom.plans import staging
from docloom.plans.content_queries import _emails
from docloom.plans.routing_queries import MESSAGE_CONFIG, MESSAGE_RULES, _rounded, _rules
from docloom.plans.service_queries import _shown, _stamp, job_events_from
from docloom.session import ensure_checkpoint_dir
from docloom.sources import messages as msg
from docloom.streaming import deadletters, ingest, live


#: Files of a batch where a wave is to be one batch, however many tasks wrote it.
WAVE = (1 << 31) - 1


def _scratch(spark, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _drain(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def _ingested(spark, sf_dir) -> tuple[DataFrame, ingest.IngestConfig]:
    base = _scratch(spark, "ingest")
    config = ingest.IngestConfig(f"{base}/tables", f"{base}/checkpoint", routing=MESSAGE_CONFIG, rules=lambda s: _rules(s, MESSAGE_RULES))
    sent = staging.messages_from(staging.stream_table(spark, sf_dir, "events"))
    _drain(ingest.start_ingest(sent.drop("event_type", "event_id", "k"), config))
    return spark, config


def stream_ingest(spark, sf_dir):
    """Metadata and quarantine tables the stream wrote."""
    spark, config = _ingested(spark, sf_dir)
    good = spark.read.parquet(config.path("metadata")).select(
        "message_id", "source_path", "file_type", "page_count", *_rounded(["layout_density"]), "document_category", "parser_strategy", "overrides_applied",
        F.lit(None).cast("string").alias("failure_reason"),
    )
    bad = spark.read.parquet(config.path("failures")).select("message_id", "failure_reason")
    return good.unionByName(bad, allowMissingColumns=True)


def stream_dead_letters(spark, sf_dir):
    spark, config = _ingested(spark, sf_dir)
    return spark.read.parquet(config.path("dead_letters")).select("message_id", "failure_reason", "receive_count")


def stream_run_summary(spark, sf_dir):
    spark, config = _ingested(spark, sf_dir)
    ingest.write_run_summary(spark, config, "queue-0")
    return spark.read.parquet(config.path("run_summary")).select("run_id", "messages", "failures")


def stream_redelivery(spark, sf_dir):
    """Three waves of deliveries and a replay of the dead letters, drained one after the other: where every row went."""
    base = _scratch(spark, "redelivery")
    source = f"{base}/in"
    config = ingest.IngestConfig(f"{base}/tables", f"{base}/checkpoint", routing=MESSAGE_CONFIG, ledger_buckets=2, compact_every=2)
    for wave in range(4):
        if wave < 3:
            staging.deliveries(spark, sf_dir, wave).write.mode("append").json(source)
        else:
            deadletters.replay(spark.read.parquet(config.path("dead_letters")), source, 1 << 30)
        _drain(ingest.start_ingest(msg.stream_messages(spark, source, WAVE), config))

    def rows(table: str, reason, count, copies) -> DataFrame:
        # the key of a message without id is a hash
        name = F.regexp_replace("message_id", "^body:[0-9a-f]*", "body")
        return spark.read.parquet(config.path(table)).select(
            F.lit(table).alias("destination"), name.alias("message_id"), reason.alias("reason"), count.cast("int").alias("receive_count"),
            copies.cast("long").alias("copies"),
        )

    none, one = F.lit(None), F.lit(1)
    return (
        rows("metadata", F.lit("accepted"), none, one)
        .unionByName(rows("failures", F.col("failure_reason"), F.col("receive_count"), one))
        .unionByName(rows("duplicates", F.col("reason"), F.col("receive_count"), F.col("copies")))
    )


def _state(spark, rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    base = _scratch(spark, name)
    _drain(live.start_updates(rows, f"{base}/table", f"{base}/checkpoint"))
    return live.current_state(spark.read.parquet(f"{base}/table"), keys)


def stream_telemetry(spark, sf_dir):
    events = staging.telemetry_from(staging.stream_table(spark, sf_dir, "events"))
    rows = _state(spark, telemetry.windowed_metrics(events, telemetry.DASHBOARD_PERIOD_SECONDS), ["queue_url", "period_start"], "telemetry")
    return _shown(rows)


def stream_lifecycle(spark, sf_dir):
    """Three waves of deliveries: the events of the batches and of the run, and the rows of the tables they count."""
    base = _scratch(spark, "lifecycle")
    config = ingest.IngestConfig(f"{base}/tables", f"{base}/checkpoint", routing=MESSAGE_CONFIG, ledger_buckets=2)
    for wave in range(3):
        staging.deliveries(spark, sf_dir, wave).write.mode("append").json(f"{base}/in")
        _drain(ingest.start_ingest(msg.stream_messages(spark, f"{base}/in", WAVE), config))
    ingest.write_run_summary(spark, config, "queue-0")
    none = F.lit(None).cast("long")
    batches = ingest.lifecycle(spark, config).select("event_name", F.col("batch_id").cast("long").alias("batch_id"), "batch_size", "successes", "failures")
    run = spark.read.parquet(config.path("run_events")).select(
        "event_name", none.alias("batch_id"), F.col("messages").alias("batch_size"), (F.col("messages") - F.col("failures")).alias("successes"), "failures"
    )
    written = spark.read.parquet(config.path("metadata")).select(F.lit(1).alias("good")).unionByName(spark.read.parquet(config.path("failures")).select(F.lit(0).alias("good")))
    tables = written.agg(
        F.lit("tables").alias("event_name"), F.max(none).alias("batch_id"), F.count(F.lit(1)).alias("batch_size"), F.sum("good").alias("successes"),
        F.sum(1 - F.col("good")).alias("failures"),
    )
    return batches.unionByName(run).unionByName(tables)


def _live(spark, name: str, aggregate: live.Mergeable) -> tuple[live.LiveTable, str]:
    base = _scratch(spark, name)
    return live.LiveTable(spark, f"{base}/table", aggregate), base


def stream_job_status(spark, sf_dir):
    """Job events as a stream of several batches, the latest events first, so that every later batch is late."""
    table, base = _live(spark, "jobs", live.JOBS)
    events = staging.table(spark, sf_dir, "events")
    events.repartitionByRange(4, F.col("ts").desc()).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    _drain(table.start(job_events_from(stream), f"{base}/checkpoint"))
    return table.current().select("job_id", "status", _stamp("updated_at"))


def stream_attempts(spark, sf_dir):
    """Deliveries in three waves, compacted before the last."""
    table, base = _live(spark, "attempts", live.ATTEMPTS)
    for wave in range(3):
        staging.deliveries(spark, sf_dir, wave).repartition(2).write.mode("append").json(f"{base}/in")
        _drain(table.start(msg.stream_messages(spark, f"{base}/in", 1), f"{base}/checkpoint"))
        if wave == 1:
            table.compact()
    return table.current()


def stored_mail(spark, sf_dir):
    """Every message processed into the store, attachments included, then a second pass that finds nothing new."""
    base = f"{_scratch(spark, 'store')}/documents"
    mail = _emails(spark, sf_dir).withColumns({"mime_type": F.lit("message/rfc822"), "metadata": F.lit("{}")})
    done = workflow.process(mail, base, batch="batch-0")
    again = workflow.process(mail, base, batch="batch-1")
    rows = done.rows["doc"].unionByName(again.rows["doc"])
    return rows.select("bundle_id", "part_id", "total_pages", "total_blocks", "status")


def process_versions(spark, sf_dir):
    """Three versions of every document in one batch, some rows twice, then another batch that brings one more: contents."""
    base = f"{_scratch(spark, 'versions')}/documents"
    docs = staging.text_documents(spark, sf_dir).select("document_id", "source_uri", "doc_id", "text")
    quoted = F.concat(F.lit('id,"text, whole"\n'), F.col("doc_id").cast("string"), F.lit(',"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"\n'))

    def version(content, mime: str, uri: str = "") -> DataFrame:
        return docs.select(
            "document_id", F.concat("source_uri", F.lit(uri)).alias("source_uri"), F.encode(content, "UTF-8").alias("content"), F.lit(mime).alias("mime_type"),
            F.lit("{}").alias("metadata"), (F.col("doc_id") % 10 == 0).alias("force"),
        )

    # one line, which no test takes for CSV
    line = F.concat(F.lit("doc "), F.translate("text", "\n", " "))
    plain, table = version(line, "text/html"), version(quoted, "text/csv")
    named = version(F.concat(F.lit("version of "), "document_id"), "text/html")
    first = workflow.process(plain.unionByName(table).unionByName(version(line, "text/html", "#copy")).unionByName(table), base, force="force", batch="batch-0")
    second = workflow.process(plain.unionByName(named), base, force="force", batch="batch-1")
    rows = first.documents.withColumn("batch", F.lit(0)).unionByName(second.documents.withColumn("batch", F.lit(1)))
    cells = F.flatten(F.transform("tables", lambda t: F.transform(t["cells"], lambda c: c["content"])))
    return rows.select(
        "batch", "document_id", "checksum", F.sha2(F.array_join(F.transform("text_spans", lambda s: s["content"]), "|"), 256).alias("text_sha256"),
        F.sha2(F.array_join(cells, "|"), 256).alias("cells_sha256"), F.size(cells).cast("long").alias("cells"), F.col("fields")[0]["name"].alias("field"),
    )


QUERIES = {
    f.__name__: f
    for f in (stream_ingest, stream_dead_letters, stream_redelivery, stream_lifecycle, stream_run_summary, stream_telemetry, stream_job_status, stream_attempts, stored_mail, process_versions)
}
