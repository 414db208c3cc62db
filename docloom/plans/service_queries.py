"""Registered queries: message handling, jobs, results, notifications, review and telemetry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.assembly import dense_ordinal
from docloom.functions.records import format_wire_time
from docloom.operators import results, review, telemetry
from docloom.plans import staging
from docloom.session import scratch_folder
from docloom.sources import messages as msg
from docloom.sources import reviews
from docloom.streaming import deadletters

NOW = "2024-02-01 00:00:00"


def _now():
    return F.to_timestamp(F.lit(NOW))


def _stamp(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


# --- messages ------------------------------------------------------------------------


def _classified(spark, sf_dir) -> DataFrame:
    parsed = msg.parse_messages(staging.messages(spark, sf_dir))
    return parsed.withColumn("status", F.when(F.col("failure_reason").isNull(), "succeeded").otherwise("failed"))


def batch_run_summary(spark, sf_dir):
    batches = telemetry.batch_summary(
        _classified(spark, sf_dir).select(F.col("stream").alias("run_id"), F.floor(F.col("event_id") / 10).alias("batch_id"), "status")
    )
    return telemetry.run_summary(batches)


def batch_counters(spark, sf_dir):
    return telemetry.batch_summary(
        _classified(spark, sf_dir).select(F.col("stream").alias("run_id"), F.floor(F.col("event_id") / 10).alias("batch_id"), "status")
    )


def dead_letters(spark, sf_dir):
    failed = msg.rejected(msg.parse_messages(staging.messages(spark, sf_dir)))
    retry, dead = deadletters.split_attempts(failed)
    both = retry.withColumn("fate", F.lit("retry")).unionByName(dead.withColumn("fate", F.lit("dead")))
    return both.select("message_id", "failure_reason", "receive_count", "fate")


def replay_batch(spark, sf_dir):
    """The 50 oldest dead letters."""
    dead = deadletters.dead_messages(msg.parse_messages(staging.messages(spark, sf_dir)))
    return deadletters.replay_candidates(dead, 50).select("message_id", "body")


def redelivery_dedupe(spark, sf_dir):
    sent = staging.messages(spark, sf_dir)
    return msg.dedupe_redelivered(sent.unionByName(sent)).select("message_id")


def delivery_attempts(spark, sf_dir):
    sent = staging.messages(spark, sf_dir).select("message_id", "receive_count")
    again = sent.where("receive_count < 5").withColumn("receive_count", F.col("receive_count") + 1)
    return msg.attempts(sent.unionByName(again))


def stream_fanout(spark, sf_dir):
    good = msg.accepted(msg.parse_messages(staging.messages(spark, sf_dir)))
    wanted = good.where(F.col("stream") == "invoices")
    return msg.with_suffix(wanted, ".PDF").select("message_id", "source_path")


def submitted_jobs(spark, sf_dir):
    """Orders submitted as jobs: the queue body and the first ledger row."""
    orders = staging.table(spark, sf_dir, "orders")
    requests = orders.select(
        F.col("o_orderkey").cast("string").alias("job_id"), F.concat(F.lit("s3://in/"), F.col("o_orderkey").cast("string")).alias("source_uri"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "high").alias("priority"), F.lit("").alias("checksum"),
        F.col("o_orderstatus").alias("document_type"), F.lit(None).cast("string").alias("mime_type"),
        F.when(F.col("o_orderstatus") == "F", F.create_map(F.lit("cust"), F.col("o_custkey").cast("string")))
        .otherwise(F.from_json(F.lit("{}"), "map<string,string>")).alias("metadata"),
        F.lit(None).cast("struct<webhook_url:string>").alias("notification_config"),
    )
    ledger = results.submitted_jobs(requests, _now()).select("job_id", "status", _stamp("updated_at"))
    return msg.job_message(requests).join(ledger, "job_id")


# --- jobs ----------------------------------------------------------------------------


def _job_events(spark, sf_dir) -> DataFrame:
    return job_events_from(staging.table(spark, sf_dir, "events"))


def job_events_from(events: DataFrame) -> DataFrame:
    """``events`` as status changes of the job ``user_id``."""
    event, kind = F.col("event_id"), F.col("event_type")
    status = (
        F.when(kind == "view", "running").when(kind == "click", "succeeded").when(kind == "signup", "partially_succeeded")
        .when(kind == "purchase", "failed").otherwise("queued")
    )
    config = F.when(
        F.col("user_id") % 2 == 0,
        F.concat(F.lit('{"webhook_url": "http://h/'), F.col("user_id").cast("string"), F.lit('", "sns_topic_arn": "'),
                 F.when(F.col("user_id") % 4 == 0, "topic").otherwise(""), F.lit('", "include_enrichment_events": '),
                 F.when(F.col("user_id") % 3 == 0, "false").otherwise("true"), F.lit("}")),
    )
    return events.select(
        F.col("user_id").cast("string").alias("job_id"), status.alias("status"), F.col("ts").cast("timestamp").alias("updated_at"),
        config.alias("notification_config"), F.concat(F.lit('[{"name": "n'), event.cast("string"), F.lit('", "status": "running"}]')).alias("enrichments"),
        (F.col("user_id") % 7 == 0).alias("notifications_emitted"),
    )


def job_status(spark, sf_dir):
    jobs = results.latest_jobs(_job_events(spark, sf_dir))
    return jobs.select("job_id", "status", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("updated_at"))


def job_terminal(spark, sf_dir):
    return results.terminal(results.latest_jobs(_job_events(spark, sf_dir))).select("job_id", "status")


def job_ledger_parse(spark, sf_dir):
    """Ledger records in wire format parsed back."""
    orders = staging.table(spark, sf_dir, "orders")
    when = F.col("o_orderdate").cast("timestamp")
    entries = F.concat(
        F.lit('[{"name": "kw", "status": "succeeded", "started_at": "'), format_wire_time(when), F.lit('"}, {"name": "cls", "status": "pending", "detail": "'),
        F.col("o_orderpriority"), F.lit('"}]'),
    )
    records = orders.select(
        F.col("o_orderkey").alias("job_id"), F.col("o_orderstatus").alias("status"), format_wire_time(when).alias("submitted_at"),
        format_wire_time(when + F.expr("INTERVAL 90 SECONDS")).alias("updated_at"), F.when(F.col("o_orderstatus") != "P", entries).alias("enrichments"),
    )
    parsed = results.parse_ledger(records)
    return parsed.select(
        "job_id", "status", _stamp("submitted_at"), _stamp("updated_at"), F.size("enrichments").alias("progress"),
        F.date_format(F.get("enrichments", 0)["started_at"], "yyyy-MM-dd").alias("started"), F.get("enrichments", 1)["detail"].alias("detail"),
    )


def _results(spark, sf_dir) -> DataFrame:
    """Orders as result documents of the job ``o_custkey % 50``, in key order."""
    orders = staging.table(spark, sf_dir, "orders")
    rows = orders.select(
        (F.col("o_custkey") % 50).cast("string").alias("job_id"), F.col("o_orderkey"),
        F.to_json(F.struct("o_orderkey", "o_orderpriority")).alias("canonical_document"),
    )
    return dense_ordinal(rows, ["job_id"], "o_orderkey", "sequence").drop("o_orderkey")


def _jobs(spark, sf_dir) -> DataFrame:
    return results.latest_jobs(_job_events(spark, sf_dir))


def _page_inputs(spark, sf_dir):
    """Results, ledger and the first ready job, looked up the way a client would name one."""
    found, jobs = _results(spark, sf_dir), _jobs(spark, sf_dir)
    job = results.result_counts(found, jobs).agg(F.min("job_id")).first()[0]
    return found, jobs, job or ""


def results_page(spark, sf_dir):
    """Third page of 20 of one job."""
    return results.results_page(*_page_inputs(spark, sf_dir), 20, 40)


def results_keyset(spark, sf_dir):
    return results.results_after(*_page_inputs(spark, sf_dir), 20, 39)


def results_gate(spark, sf_dir):
    return results.result_counts(_results(spark, sf_dir), _jobs(spark, sf_dir))


def notification_outbox(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    emitted = staging.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("job_id"))
    return results.notification_outbox(jobs, emitted, _now())


# --- review --------------------------------------------------------------------------


def _candidates(spark, sf_dir) -> DataFrame:
    labels = staging.table(spark, sf_dir, "labels")
    docs = staging.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    joined = labels.join(docs, "doc_id")
    triggers = F.array_compact(F.array(F.when(F.col("quality") == 0, ""), F.when(F.col("toxic") == 1, "fraud_signal")))
    doc = F.col("doc_id").cast("string")
    return joined.select("doc_id", "lang", "source", F.explode(triggers).alias("trigger")).select(
        F.concat(F.lit("d-"), doc).alias("document_id"), "trigger", F.col("source").alias("job_id"),
        F.when(F.col("lang") == "en", F.to_json(F.struct(F.concat(F.lit("T"), doc).alias("title")))).otherwise("{}").alias("canonical_document"),
        F.to_json(F.struct("lang")).alias("standardized_output"), F.lit("{}").alias("insights"),
        F.timestamp_seconds(F.lit(1700000000) + (F.col("doc_id") * 7919) % 86400).alias("created_at"),
    )


def _reviews(spark, sf_dir) -> DataFrame:
    """Stored reviews: every document, one trigger each."""
    docs = staging.table(spark, sf_dir, "documents")
    doc, none = F.col("doc_id").cast("string"), F.lit(None).cast("string")
    number = F.col("doc_id") % 3
    return docs.select(
        F.concat(F.lit("d-"), doc).alias("document_id"), F.lit("low_extraction_quality").alias("trigger"), F.concat(F.lit("old"), doc).alias("title"),
        F.lit("j0").alias("job_id"), F.lit('{"v":0}').alias("canonical_document"), none.alias("standardized_output"), F.lit('{"i":1}').alias("insights"),
        F.when(number == 2, '{"v":9}').alias("reviewed_canonical_document"), F.when(number == 2, "{}").alias("reviewed_standardized_output"),
        none.alias("reviewed_insights"), F.when(number == 0, "pending").when(number == 1, "in_progress").otherwise("completed").alias("status"),
        F.when(number == 2, "corrected").alias("outcome"), F.when(number > 0, F.concat(F.lit("u"), (F.col("doc_id") % 5).cast("string"))).alias("assigned_to"),
        F.lit(None).cast("timestamp").alias("assigned_at"), F.lit(None).cast("timestamp").alias("latest_reviewed_at"),
        F.timestamp_seconds(F.lit(1690000000) + (F.col("doc_id") * 7919) % 86400).alias("created_at"), F.lit(None).cast("timestamp").alias("updated_at"),
    )


def review_sync(spark, sf_dir):
    synced = review.sync_reviews(_reviews(spark, sf_dir), _candidates(spark, sf_dir), _now())
    return synced.select(
        "document_id", "trigger", "title", "job_id", "canonical_document", "standardized_output", "insights", "status", "outcome",
        "assigned_to", _stamp("created_at"), _stamp("updated_at"),
    )


def review_queue(spark, sf_dir):
    rows = _reviews(spark, sf_dir)
    parts = {
        "open": review.review_queue(rows, status="pending"),
        "free": review.review_queue(rows, trigger="low_extraction_quality", unassigned=True),
        "mine": review.review_queue(rows, mine="u1"),
    }
    out = None
    for name, frame in parts.items():
        frame = frame.select(F.lit(name).alias("list"), "document_id")
        out = frame if out is None else out.unionByName(frame)
    return out


def review_page(spark, sf_dir):
    return review.review_page(_reviews(spark, sf_dir), 2).select("document_id")


def review_candidates(spark, sf_dir):
    """The 40 newest candidates."""
    return review.newest(_candidates(spark, sf_dir), 40).select("document_id", _stamp("created_at"))


def review_scan(spark, sf_dir):
    """Candidates of two sources chosen by name: candidate files, of which only those to review are read, and payloads."""
    docs = staging.table(spark, sf_dir, "documents")
    doc = F.concat(F.lit("d-"), F.col("doc_id").cast("string"))
    rows = docs.select(
        doc.alias("document_id"), F.lit("j").alias("job_id"), F.lit("manual").alias("review_trigger"), (F.col("lang") == "en").alias("review_required"),
        F.lit(None).cast("timestamp").alias("created_at"), F.encode(F.to_json(F.struct("source")), "UTF-8").alias("canonical_document"),
        F.lit(None).cast("binary").alias("standardized_output"), F.lit("{}").alias("insights"),
    )
    base = scratch_folder(spark, "candidates")
    reviews.write_candidates(rows, f"{base}/files")
    warehouse = reviews.candidates(spark, "files", path=f"{base}/files").drop("created_at")
    payload = F.to_json(F.struct(doc.alias("document_id"), F.col("source").alias("job_id"), F.struct("lang").alias("insights"), F.when(F.col("lang") == "fr", "fraud_signal").alias("review_trigger")))
    docs.select(payload.alias("canonical_document")).write.parquet(f"{base}/results")
    stored = reviews.candidates(spark, "payloads", path=f"{base}/results").drop("canonical_document")
    return warehouse.unionByName(stored, allowMissingColumns=True).select(
        "document_id", "job_id", "trigger", "standardized_output", "insights", F.get_json_object("canonical_document", "$.source").alias("source")
    )


def review_outcomes(spark, sf_dir):
    events = review.outcome_events(_reviews(spark, sf_dir))
    labels = staging.table(spark, sf_dir, "labels")
    tried = labels.select(
        F.concat(F.lit("d-"), F.col("doc_id").cast("string")).alias("document_id"), F.lit("low_extraction_quality").alias("trigger"),
        F.when(F.col("toxic") == 1, "timeout").alias("error"),
    )
    published = review.publish_outcomes(events, tried)
    value = lambda k: F.get_json_object("payload", f"$.{k}")
    return published.select(
        "document_id", "status", "error_message", value("outcome").alias("outcome"), value("canonical_document").alias("canonical"),
        value("standardized_output").alias("standardized"), value("insights").alias("insights"),
    )


def review_counts(spark, sf_dir):
    return review.facets(_reviews(spark, sf_dir))


def _review_events(spark, sf_dir) -> DataFrame:
    event = F.col("event_type")
    kind = F.when(event.isin("click", "signup"), "assign").when(event.isin("view", "error"), "unassign").otherwise("complete")
    none = F.lit(None).cast("string")
    return staging.table(spark, sf_dir, "events").select(
        (F.col("user_id")).cast("string").alias("document_id"), F.lit("manual").alias("trigger"), kind.alias("event"),
        F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("user"), F.when(kind == "complete", "approved").alias("outcome"),
        F.when((kind == "complete") & (F.col("event_id") % 2 == 0), F.concat(F.lit("c"), F.col("event_id").cast("string"))).alias("reviewed_canonical"),
        none.alias("reviewed_standardized"), none.alias("reviewed_insights"), F.col("ts").cast("timestamp").alias("at"),
    )


def review_state(spark, sf_dir):
    states = review.review_states(_review_events(spark, sf_dir))
    return states.select("document_id", "status", "assigned_to", "outcome", "reviewed_canonical", _stamp("assigned_at"), _stamp("latest_reviewed_at"))


def review_comments(spark, sf_dir):
    """Conversations as reviews, turns as comments."""
    turns = staging.table(spark, sf_dir, "conversations")
    key = F.col("conv_id").cast("string").alias("document_id")
    reviews = turns.select(key, F.lit("manual").alias("trigger")).distinct()
    comments = turns.select(key, F.lit("manual").alias("trigger"), F.col("turn").alias("position"), F.col("role").alias("author"), F.col("text").alias("comment"))
    rows = review.comments_in_order(reviews, comments)
    joined = F.array_join(F.transform("comments", lambda c: F.concat(c["author"], F.lit(":"), c["comment"])), "|")
    return rows.select("document_id", F.size("comments").alias("comments"), F.sha2(joined, 256).alias("checksum"))


# --- telemetry -----------------------------------------------------------------------


def _events(spark, sf_dir) -> DataFrame:
    return staging.telemetry(spark, sf_dir)


def telemetry_points(spark, sf_dir):
    return telemetry.metric_points(_events(spark, sf_dir)).drop("event_time")


def telemetry_tags(spark, sf_dir):
    events = telemetry.log_events(
        _events(spark, sf_dir).drop("event_time", "event_name"), F.lit("message"), {"region": "local", "job_name": "unused"}, _now()
    )
    return telemetry.tags(events.drop("event_time"), "event_id")


def telemetry_numbers(spark, sf_dir):
    return telemetry.numeric_fields(_events(spark, sf_dir), "event_id")


def _shown(rows: DataFrame) -> DataFrame:
    doubles = [c for c in ("mean_latency_ms", "mean_queue_depth", "failure_ratio") if c in rows.columns]
    return rows.withColumns({**{c: F.round(c, 6) for c in doubles}, "period_start": F.date_format("period_start", "yyyy-MM-dd HH:mm:ss")})


def telemetry_5m(spark, sf_dir):
    return _shown(telemetry.windowed_metrics(_events(spark, sf_dir), telemetry.DASHBOARD_PERIOD_SECONDS))


def failure_ratio_1m(spark, sf_dir):
    rows = telemetry.windowed_metrics(_events(spark, sf_dir), telemetry.ALARM_PERIOD_SECONDS)
    return _shown(rows.select("queue_url", "period_start", "failure_ratio"))


def failure_alarm(spark, sf_dir):
    """Hourly periods, as the test events are too sparse for minutes."""
    rows = telemetry.windowed_metrics(_events(spark, sf_dir), 3600)
    rows = telemetry.alarms(rows, F.col("failure_ratio"), telemetry.FAILURE_RATIO_THRESHOLD, 3600)
    return _shown(rows.select("queue_url", "period_start", "breaching", "in_alarm"))


def queue_depth_alarm(spark, sf_dir):
    rows = telemetry.windowed_metrics(_events(spark, sf_dir), telemetry.ALARM_PERIOD_SECONDS)
    rows = telemetry.alarms(rows, F.col("mean_queue_depth"), 50)
    return _shown(rows.select("queue_url", "period_start", "breaching", "in_alarm"))


QUERIES = {
    f.__name__: f
    for f in (
        batch_run_summary, batch_counters, dead_letters, replay_batch, redelivery_dedupe, delivery_attempts, stream_fanout,
        submitted_jobs, job_status, job_terminal, job_ledger_parse, results_page, results_keyset, results_gate,
        notification_outbox, review_sync, review_queue, review_page, review_candidates, review_scan, review_outcomes,
        review_counts, review_state, review_comments, telemetry_points, telemetry_tags, telemetry_numbers, telemetry_5m,
        failure_ratio_1m, failure_alarm, queue_depth_alarm,
    )
}
