"""Streams equal their batch counterparts and replays write nothing twice."""

import json
import time

from pyspark.sql import functions as F

from docloom import schemas
from docloom.operators import telemetry
from docloom.sources import content
from docloom.sources import messages as msg
from docloom.streaming import deadletters, ingest, live

SENT = [
    ("m1", {"object_key": "a.pdf", "documentMetadata": {"pageCount": 2}}, 1), ("m2", "{broken", 5), ("m3", {"x": 1}, 2), ("m1", {"object_key": "a.pdf"}, 2),
    ("m4", {"object_key": "no-extension"}, 1),
]


def _write(folder, name, sent):
    lines = [
        json.dumps({"message_id": m, "queue_url": "q", "stream": "s", "body": b if isinstance(b, str) else json.dumps(b), "receive_count": n, "sent_at": "2024-01-01T00:00:00Z"})
        for m, b, n in sent
    ]
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines))


def test_ingest_replay_and_dead_letters(spark, tmp_path):
    source = tmp_path / "in"
    _write(source, "a.json", SENT)
    config = ingest.IngestConfig(str(tmp_path / "out"), str(tmp_path / "cp"))
    ingest.start_ingest(msg.stream_messages(spark, str(source)), config).awaitTermination()
    metadata = spark.read.parquet(config.path("metadata"))
    assert sorted((r.message_id, r.file_type, r.page_count) for r in metadata.collect() if r.message_id != "m1") == [("m4", "none", 1)]
    assert metadata.count() == 2
    failures = {r.message_id: r.failure_reason for r in spark.read.parquet(config.path("failures")).collect()}
    assert failures == {"m2": "invalid_json", "m3": "missing_object_key"}
    dead = spark.read.parquet(config.path("dead_letters"))
    assert [r.message_id for r in dead.collect()] == ["m2"]
    summary = ingest.run_summary(spark, config).collect()[0]
    assert (summary.messages, summary.batches, summary.failures) == (4, 1, 2)
    # a replayed micro-batch replaces its own partitions
    batch = msg.dedupe_redelivered(msg.read_messages(spark, str(source)))
    ingest.process_batch(batch, 0, config)
    assert spark.read.parquet(config.path("metadata")).count() == 2 and spark.read.parquet(config.path("failures")).count() == 2
    # dead letters go back to the input only when asked to
    dead = spark.read.parquet(config.path("dead_letters"))
    assert deadletters.replay(dead, str(source), 10, dry_run=True).count() == 1
    deadletters.replay(dead, str(source), 10)
    assert spark.read.schema(schemas.MESSAGE).json(str(source)).where("message_id = 'm2/replay-1' AND receive_count = 1").count() == 1


def test_windowed_metrics_over_gaps(spark):
    rows = [("q", "2024-01-01 00:00:10", 150), ("q", "2024-01-01 00:01:10", 50), ("q", "2024-01-01 00:02:10", 150), ("q", "2024-01-01 00:05:00", 150), ("q", "2024-01-01 00:06:00", 150)]
    events = spark.createDataFrame(rows, "queue_url string, t string, queue_depth long").select(
        "queue_url", F.to_timestamp("t").alias("event_time"), "queue_depth", F.lit("succeeded").alias("status"), F.lit(1).cast("long").alias("latency_ms")
    )
    points = telemetry.windowed_metrics(events, 60)
    got = telemetry.alarms(points, F.col("mean_queue_depth"), telemetry.QUEUE_DEPTH_THRESHOLD).orderBy("period_start").collect()
    assert [r.in_alarm for r in got] == [False, False, True, False, True]


def test_content_resolution(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"hello world")
    files = content.read_files(spark, str(tmp_path), "*.txt")
    docs = spark.createDataFrame([(f"file:{tmp_path}/a.txt", None), ("file:/missing", None), ("file:/missing", "inline")], "source_uri string, inline string")
    docs = docs.withColumn("inline", F.encode("inline", "UTF-8"))
    resolved = content.resolve_content(docs, [("inline", None), ("content", lambda d: content.attach_content(d, files))], output="content")
    assert sorted((bytes(r.content) if r.content else b"") for r in resolved.collect()) == [b"", b"hello world", b"inline"]
    assert content.read_files(spark, str(tmp_path), max_bytes=5).collect()[0].content == b"hello"


def test_live_table_merges_late_and_replayed_parts(spark, tmp_path):
    source, table = tmp_path / "in", live.LiveTable(spark, str(tmp_path / "table"), live.ATTEMPTS)
    waves = [[("a", {}, 2), ("b", {}, 1), ("a", {}, 2)], [("a", {}, 1)], [("b", {}, 3), ("c", {}, None)]]

    def drain():
        query = table.start(msg.stream_messages(spark, str(source), 1), str(tmp_path / "cp"))
        query.awaitTermination()
        # no state is kept between batches
        assert all(not p["stateOperators"] for p in query.recentProgress)

    for i, wave in enumerate(waves):
        _write(source, f"{i}.json", wave)
        drain()
        if i < 2:
            assert table.compact() == i
    want = [("a", 2, 3), ("b", 3, 2), ("c", 1, 1)]
    assert sorted(tuple(r) for r in table.current().collect()) == want
    assert table.parts().count() == 4
    # a replay of a compacted batch, and of one that is not, changes nothing
    for batch, wave in ((0, waves[0]), (2, waves[2])):
        rows = spark.createDataFrame([(m, n) for m, _, n in wave], "message_id string, receive_count int")
        ingest.write_batch(live.ATTEMPTS.of(rows), f"{table.path}/parts", "run-0", batch)
    assert sorted(tuple(r) for r in table.current().collect()) == want
    assert table.compact() == 2 and table.parts().count() == 3
    assert sorted(tuple(r) for r in table.current().collect()) == want


def test_run_events_come_from_progress(spark, tmp_path):
    seen = []
    listener = live.RunEvents(lambda kind, query, details: seen.append((kind, details)))
    spark.streams.addListener(listener)
    try:
        _write(tmp_path / "in", "a.json", SENT)
        rows = msg.stream_messages(spark, str(tmp_path / "in")).observe("sizes", F.count(F.lit(1)).alias("messages"))
        query = live.LiveTable(spark, str(tmp_path / "t"), live.ATTEMPTS).start(rows, str(tmp_path / "cp"))
        query.awaitTermination()
        for _ in range(100):
            if seen and seen[-1][0] == "terminated":
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    kinds = [k for k, _ in seen]
    assert kinds[0] == "started" and kinds[-1] == "terminated" and seen[-1][1]["error"] is None
    [batch] = [d for k, d in seen if k == "batch" and d["rows"]]
    assert batch["batch_id"] == 0 and batch["rows"] == 5 and batch["observed"] == {"sizes": {"messages": 5}}


def test_empty_batch_has_its_event(spark, tmp_path):
    config = ingest.IngestConfig(str(tmp_path / "out"), str(tmp_path / "cp"))
    ingest.process_batch(_deliveries(spark, [("a", "{}", 1, "2024-01-01 00:00:00")]).where("message_id = 'none'"), 0, config)
    [row] = ingest.lifecycle(spark, config).collect()
    assert (row.batch_size, row.successes, row.failures) == (0, 0, 0)


def test_idle_listener_reports(spark):
    seen = []
    listener = live.IdleEvents(lambda query, at: seen.append((query, at)))
    event = type("Event", (), {"id": "q1", "timestamp": "t"})()
    listener.onQueryIdle(event)
    listener.onQueryStarted(event)
    assert seen == [("q1", "t")]


def _deliveries(spark, rows):
    return spark.createDataFrame([(m, "q", "s", b, n, t) for m, b, n, t in rows], "message_id string, queue_url string, stream string, body string, receive_count int, t string").select(
        "message_id", "queue_url", "stream", "body", "receive_count", F.to_timestamp("t").alias("sent_at")
    )


def _where(spark, config):
    found = []
    for table, reason, copies in (("metadata", F.lit("accepted"), F.lit(1)), ("failures", F.col("failure_reason"), F.lit(1)), ("duplicates", F.col("reason"), F.col("copies"))):
        rows = spark.read.parquet(config.path(table)).select("message_id", reason.alias("r"), copies.alias("n")).collect()
        found += [(r.message_id, r.r, r.n) for r in rows]
    return sorted(found, key=repr)


def test_no_delivery_is_lost(spark, tmp_path):
    good, day = json.dumps({"object_key": "a.pdf"}), "2024-01-01 00:00:00"
    config = ingest.IngestConfig(str(tmp_path / "out"), str(tmp_path / "cp"), ledger_buckets=2, compact_every=0)
    first = [
        (None, good, 1, day), (None, "{broken", 1, day), (None, good, 1, "2024-01-02 00:00:00"), ("a", good, None, day), ("a", "{older", None, "2023-12-31 00:00:00"),
        ("b", good, None, None), ("c", "{x", 1, day), ("c", "{x", 2, day), ("c", "{x", 2, day), (" ", good, 1, None),
    ]
    ingest.process_batch(_deliveries(spark, first), 0, config)
    want = [
        (None, "accepted", 1), (None, "accepted", 1), (None, "invalid_json", 1), ("a", "accepted", 1), ("a", "superseded", 1), ("b", "accepted", 1),
        ("c", "invalid_json", 1), ("c", "superseded", 1), ("c", "repeated", 1), (" ", "accepted", 1),
    ]
    assert _where(spark, config) == sorted(want, key=repr)
    # later: the same again, an older delivery, a new one of a failed message, one of a message that succeeded
    second = [(None, good, 1, day), ("c", "{x", 1, day), ("d", good, 1, "1999-01-01 00:00:00"), ("a", good, 2, day), ("b", good, None, None)]
    ingest.process_batch(_deliveries(spark, second), 1, config)
    more = [(None, "handled_before", 1), ("c", "handled_before", 1), ("d", "accepted", 1), ("a", "message_succeeded", 1), ("b", "handled_before", 1)]
    assert _where(spark, config) == sorted(want + more, key=repr)
    # a replay of the second batch decides as before, also after compaction, which keeps runs and batches apart
    ledger = ingest.Ledger(spark, config.path("handled"), 2)
    before = sorted((r.delivery_key, r.receive_count, r.batch_id) for r in ledger.deliveries().collect())
    assert ledger.compact() == 0
    assert sorted((r.delivery_key, r.receive_count, r.batch_id) for r in ledger.deliveries().collect()) == before
    ingest.process_batch(_deliveries(spark, second), 1, config)
    assert _where(spark, config) == sorted(want + more, key=repr)
    ingest.process_batch(_deliveries(spark, [("c", "{x", 5, day), ("c", "{x", 2, day)]), 2, config)
    assert ledger.compact() == 1
    ledger.vacuum()
    assert ledger.generation() == 1
    ingest.process_batch(_deliveries(spark, [("c", "{x", 5, day), ("d", good, 2, "1999-01-01 00:00:00"), ("e", good, 1, day)]), 3, config)
    last = [("c", "invalid_json", 1), ("c", "superseded", 1), ("c", "handled_before", 1), ("d", "message_succeeded", 1), ("e", "accepted", 1)]
    assert _where(spark, config) == sorted(want + more + last, key=repr)


def test_new_keys_do_not_meet_the_ledger(spark, tmp_path):
    config = ingest.IngestConfig(str(tmp_path / "out"), str(tmp_path / "cp"))
    ledger = ingest.Ledger(spark, config.path("handled"), 4)
    rows = [(f"m{i}", "x", 1, "2024-01-01 00:00:00") for i in range(500)]
    known = ingest.identified(_deliveries(spark, rows)).withColumn("succeeded", F.lit(True))
    ledger.record(known, "run-0", 0)
    asked = ingest.identified(_deliveries(spark, rows[:20] + [(f"n{i}", "x", 1, "2024-01-01 00:00:00") for i in range(1000)] + [("m3", "x", 1, "2024-02-01 00:00:00")]))
    marked = {r.delivery_key: r.suspect for r in ledger.marked(asked).where("sent_day < '2024-02-01'").collect()}
    assert all(marked[f"m{i}"] for i in range(20)) and sum(marked[f"n{i}"] for i in range(1000)) < 30
    assert not ledger.marked(asked).where("sent_day >= '2024-02-01'").first().suspect
    assert ledger.judge(asked, "run-0", 1).where("reason IS NULL").count() == 1001


def test_tables_of_a_batch_do_not_go_over_the_partitions_of_its_joins(spark, tmp_path, monkeypatch):
    parts, write = {}, ingest.write_batch

    def counted(rows, path, *given, **named):
        parts[path.rsplit("/", 1)[1]] = rows.rdd.getNumPartitions()
        return write(rows, path, *given, **named)

    monkeypatch.setattr(ingest, "write_batch", counted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "96")
    try:
        config = ingest.IngestConfig(str(tmp_path / "out"), str(tmp_path / "cp"))
        sent = [(f"m{i % 40}", json.dumps({"object_key": f"{i}.pdf"}) if i % 3 else "{broken", i % 2, "2024-01-01 00:00:00") for i in range(60)]
        ingest.process_batch(_deliveries(spark, sent), 0, config)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(parts.values()) < 96, parts
    assert not list((tmp_path / "out" / "scratch").iterdir())
