from oracle.common import MESSAGES

_JOBS = """
job_events AS (
  SELECT CAST(user_id AS VARCHAR) AS job_id, user_id, event_id, ts,
         CASE event_type WHEN 'view' THEN 'running' WHEN 'click' THEN 'succeeded' WHEN 'signup' THEN 'partially_succeeded'
              WHEN 'purchase' THEN 'failed' ELSE 'queued' END AS status FROM events),
jobs AS (SELECT * FROM job_events QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY ts DESC, status DESC) = 1)
"""
_RESULTS = _JOBS + """,
res AS (SELECT CAST(o_custkey % 50 AS VARCHAR) AS job_id, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) - 1 AS sequence,
        '{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS canonical_document FROM orders),
open_res AS (SELECT res.* FROM res JOIN jobs USING (job_id) WHERE status IN ('succeeded', 'partially_succeeded'))
"""
_REVIEWS = """
reviews AS (SELECT 'd-' || doc_id AS document_id, doc_id, doc_id % 3 AS n,
    CASE doc_id % 3 WHEN 0 THEN 'pending' WHEN 1 THEN 'in_progress' ELSE 'completed' END AS status,
    CASE WHEN doc_id % 3 > 0 THEN 'u' || (doc_id % 5) END AS assigned_to, CASE WHEN doc_id % 3 = 2 THEN 'corrected' END AS outcome,
    to_timestamp(1690000000 + (doc_id * 7919) % 86400) AT TIME ZONE 'UTC' AS created_at
  FROM documents),
cand0 AS (SELECT doc_id, lang, source, unnest(list_filter([CASE WHEN quality = 0 THEN '' END, CASE WHEN toxic = 1 THEN 'fraud_signal' END], lambda t: t IS NOT NULL)) AS t
  FROM labels JOIN documents USING (doc_id)),
cand AS (SELECT 'd-' || doc_id AS document_id, doc_id, CASE WHEN t = '' THEN 'low_extraction_quality' ELSE t END AS trigger, source AS job_id,
    CASE WHEN lang = 'en' THEN 'T' || doc_id END AS title, '{"lang":"' || lang || '"}' AS standardized_output,
    to_timestamp(1700000000 + (doc_id * 7919) % 86400) AT TIME ZONE 'UTC' AS created_at FROM cand0)
"""
_TELEMETRY = """
tel AS (SELECT event_id, event_type, 'queue-' || (user_id % 4) AS queue_url, 'run-' || (user_id % 7) AS run_id, ts,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status,
    CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) END AS latency_ms, CAST(props->>'k' AS BIGINT) AS queue_depth,
    CASE WHEN event_type = 'view' THEN CAST(props->>'k' AS BIGINT) % 5 END AS inflight FROM events)
"""


def _windowed(seconds):
    return _TELEMETRY + f""",
win AS (SELECT queue_url, time_bucket(INTERVAL '{seconds} seconds', ts) AS p, count(*) FILTER (status = 'succeeded') AS successes,
    count(*) FILTER (status = 'failed') AS failures, round(avg(latency_ms), 6) AS mean_latency_ms, avg(queue_depth) AS depth FROM tel GROUP BY 1, 2),
ratio AS (SELECT *, failures / (successes + failures)::DOUBLE AS failure_ratio, strftime(p, '%Y-%m-%d %H:%M:%S') AS period_start FROM win)"""


def _alarm(seconds, test):
    return f"""WITH {_windowed(seconds)}, b AS (SELECT *, CASE WHEN {test} THEN 1 ELSE 0 END AS breaching FROM ratio)
        SELECT queue_url, period_start, breaching, sum(breaching) OVER (PARTITION BY queue_url ORDER BY p
          RANGE BETWEEN INTERVAL '{2 * seconds} seconds' PRECEDING AND CURRENT ROW) >= 2 AS in_alarm FROM b"""


_NUMBERS = """SELECT event_id, 'latency_ms' AS name, latency_ms::DOUBLE AS value FROM tel WHERE latency_ms IS NOT NULL
        UNION ALL SELECT event_id, 'queue_depth', queue_depth FROM tel UNION ALL SELECT event_id, 'inflight', inflight FROM tel WHERE inflight IS NOT NULL"""

SQL = {
    "batch_run_summary": f"""WITH {MESSAGES} SELECT stream AS run_id, count(*) AS messages, count(DISTINCT event_id // 10) AS batches,
        count(failure_reason) AS failures FROM messages GROUP BY 1""",
    "batch_counters": f"""WITH {MESSAGES} SELECT stream AS run_id, event_id // 10 AS batch_id, count(*) AS batch_size,
        count(*) - count(failure_reason) AS successes, count(failure_reason) AS failures FROM messages GROUP BY 1, 2""",
    "dead_letters": f"""WITH {MESSAGES} SELECT message_id, failure_reason, receive_count, CASE WHEN receive_count >= 5 THEN 'dead' ELSE 'retry' END AS fate
        FROM messages WHERE failure_reason IS NOT NULL""",
    "replay_batch": f"""WITH {MESSAGES} SELECT message_id, CASE event_type WHEN 'error' THEN '{{"documentMetadata": {{"pageCount": 3' ELSE '{{"documentMetadata": {{"pageCount": "7"}}}}' END AS body
        FROM messages WHERE failure_reason IS NOT NULL AND receive_count >= 5 ORDER BY sent_at, message_id LIMIT 50""",
    "redelivery_dedupe": f"WITH {MESSAGES} SELECT message_id FROM messages",
    "delivery_attempts": f"""WITH {MESSAGES} SELECT message_id, CASE WHEN receive_count < 5 THEN receive_count + 1 ELSE receive_count END AS receive_count,
        CASE WHEN receive_count < 5 THEN 2 ELSE 1 END AS deliveries FROM messages""",
    "stream_fanout": f"""WITH {MESSAGES} SELECT message_id, source_path FROM messages WHERE stream = 'invoices' AND source_path LIKE '%.PDF'""",
    "submitted_jobs": """SELECT CAST(o_orderkey AS VARCHAR) AS job_id, 'queued' AS status, '2024-02-01 00:00:00' AS updated_at,
        '{"job_id":"' || o_orderkey || '","source_uri":"s3://in/' || o_orderkey || '","priority":"' || CASE WHEN o_orderpriority = '1-URGENT' THEN 'high' ELSE 'normal' END
        || '","schema_version":"1.1","document_type":"' || o_orderstatus || '"' || CASE WHEN o_orderstatus = 'F' THEN ',"metadata":{"cust":"' || o_custkey || '"}' ELSE '' END || '}' AS body FROM orders""",
    "job_status": f"WITH {_JOBS} SELECT job_id, status, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS updated_at FROM jobs",
    "job_terminal": f"WITH {_JOBS} SELECT job_id, status FROM jobs WHERE status IN ('succeeded', 'failed', 'partially_succeeded', 'cancelled')",
    "job_ledger_parse": """SELECT o_orderkey AS job_id, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS submitted_at,
        strftime(o_orderdate + INTERVAL 90 SECONDS, '%Y-%m-%d %H:%M:%S') AS updated_at, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 2 END AS progress,
        CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END AS started, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS detail FROM orders""",
    "results_page": f"""WITH {_RESULTS} SELECT *, CASE WHEN (SELECT count(*) FROM open_res WHERE job_id = (SELECT min(job_id) FROM open_res)) > 60 THEN 60 END AS next_offset
        FROM open_res WHERE job_id = (SELECT min(job_id) FROM open_res) AND sequence >= 40 AND sequence < 60""",
    "results_keyset": f"WITH {_RESULTS} SELECT * FROM open_res WHERE job_id = (SELECT min(job_id) FROM open_res) AND sequence >= 40 AND sequence < 60",
    "results_gate": f"WITH {_RESULTS} SELECT job_id, count(*) AS documents, max(sequence) AS last_sequence FROM open_res GROUP BY 1",
    "notification_outbox": f"""WITH {_JOBS}, due AS (SELECT * FROM jobs WHERE status IN ('succeeded', 'partially_succeeded') AND user_id % 2 = 0 AND user_id % 7 <> 0 AND user_id NOT IN (SELECT doc_id FROM labels)),
        t AS (SELECT *, 'webhook' AS kind, 'http://h/' || user_id AS target FROM due UNION ALL SELECT *, 'sns', 'topic' FROM due WHERE user_id % 4 = 0)
        SELECT job_id, status, CASE WHEN user_id % 3 = 0 THEN '[]' ELSE '[{{"name": "n' || event_id || '", "status": "running"}}]' END AS enrichments,
        '2024-02-01T00:00:00.000000Z' AS published_at, kind, target FROM t""",
    "review_sync": f"""WITH {_REVIEWS} SELECT coalesce(r.document_id, c.document_id) AS document_id, coalesce(c.trigger, 'low_extraction_quality') AS trigger,
        coalesce(c.title, 'old' || r.doc_id, '') AS title, CASE WHEN c.doc_id IS NOT NULL THEN c.job_id ELSE 'j0' END AS job_id,
        CASE WHEN c.doc_id IS NULL THEN '{{"v":0}}' WHEN c.title IS NULL THEN '{{}}' ELSE '{{"title":"' || c.title || '"}}' END AS canonical_document,
        c.standardized_output, CASE WHEN c.doc_id IS NULL THEN '{{"i":1}}' ELSE '{{}}' END AS insights, coalesce(r.status, 'pending') AS status,
        r.outcome, r.assigned_to, strftime(coalesce(r.created_at, TIMESTAMP '2024-02-01'), '%Y-%m-%d %H:%M:%S') AS created_at,
        CASE WHEN c.doc_id IS NOT NULL THEN '2024-02-01 00:00:00' END AS updated_at
        FROM reviews r FULL JOIN cand c ON r.doc_id = c.doc_id AND c.trigger = 'low_extraction_quality'""",
    "review_queue": f"""WITH {_REVIEWS} SELECT 'open' AS list, document_id FROM reviews WHERE status = 'pending'
        UNION ALL SELECT 'free', document_id FROM reviews WHERE assigned_to IS NULL UNION ALL SELECT 'mine', document_id FROM reviews WHERE assigned_to = 'u1'""",
    "review_page": f"WITH {_REVIEWS} SELECT document_id FROM reviews ORDER BY created_at DESC, document_id LIMIT 25 OFFSET 25",
    "review_candidates": f"""WITH {_REVIEWS} SELECT document_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM cand
        ORDER BY cand.created_at DESC, document_id LIMIT 40""",
    "review_scan": """SELECT 'd-' || doc_id AS document_id, 'j' AS job_id, 'manual' AS trigger, NULL AS standardized_output, '{}' AS insights, source FROM documents WHERE lang = 'en'
        UNION ALL SELECT 'd-' || doc_id, source, CASE WHEN lang = 'fr' THEN 'fraud_signal' END, '{}', '{"lang":"' || lang || '"}', NULL FROM documents""",
    "review_outcomes": f"""WITH {_REVIEWS} SELECT document_id, CASE WHEN toxic IS NULL THEN 'pending' WHEN toxic = 1 THEN 'failed' ELSE 'sent' END AS status,
        CASE WHEN toxic = 1 THEN 'timeout' END AS error_message, outcome, '{{"v":9}}' AS canonical, NULL AS standardized, '{{"i":1}}' AS insights
        FROM reviews LEFT JOIN labels USING (doc_id) WHERE status = 'completed'""",
    "review_counts": f"""WITH {_REVIEWS} SELECT status, 'low_extraction_quality' AS trigger, outcome, count(*) AS reviews FROM reviews GROUP BY ALL""",
    "review_state": """WITH e AS (SELECT *, CASE WHEN event_type IN ('click', 'signup') THEN 'assign' WHEN event_type IN ('view', 'error') THEN 'unassign' ELSE 'complete' END AS event
          FROM events)
        SELECT CAST(user_id AS VARCHAR) AS document_id,
          CASE arg_max(event, ts) WHEN 'assign' THEN 'in_progress' WHEN 'unassign' THEN 'pending' ELSE 'completed' END AS status,
          CASE WHEN arg_max(event, ts) <> 'unassign' THEN 'u' || arg_max(event_id, ts) END AS assigned_to,
          max(CASE WHEN event = 'complete' THEN 'approved' END) AS outcome,
          'c' || arg_max(event_id, ts) FILTER (event = 'complete' AND event_id % 2 = 0) AS reviewed_canonical,
          strftime(max(ts) FILTER (event = 'assign'), '%Y-%m-%d %H:%M:%S') AS assigned_at,
          strftime(max(ts) FILTER (event = 'complete'), '%Y-%m-%d %H:%M:%S') AS latest_reviewed_at FROM e GROUP BY user_id""",
    "review_comments": """SELECT CAST(conv_id AS VARCHAR) AS document_id, CAST(count(*) AS INTEGER) AS comments,
        sha256(string_agg(role || ':' || text, '|' ORDER BY turn)) AS checksum FROM conversations GROUP BY 1""",
    "telemetry_points": f"""WITH {_TELEMETRY} SELECT event_id, queue_url, 'ParserSuccess' AS metric, 1.0::DOUBLE AS value, 'Count' AS unit FROM tel WHERE status = 'succeeded'
        UNION ALL SELECT event_id, queue_url, 'ParserLatencyMs', latency_ms, 'Milliseconds' FROM tel WHERE latency_ms IS NOT NULL
        UNION ALL SELECT event_id, queue_url, 'ParserFailure', 1, 'Count' FROM tel WHERE status = 'failed'
        UNION ALL SELECT event_id, queue_url, 'QueueDepthVisible', queue_depth, 'Count' FROM tel
        UNION ALL SELECT event_id, queue_url, 'QueueDepthInFlight', inflight, 'Count' FROM tel WHERE inflight IS NOT NULL""",
    "telemetry_tags": f"""WITH {_TELEMETRY} SELECT event_id, unnest(['job_name', 'run_id', 'queue_url', 'status', 'source_type', 'region', 'event_name']) AS name,
        unnest(['ingestion', run_id, queue_url, status, event_type, 'local', 'message']) AS value FROM tel""",
    "telemetry_numbers": f"WITH {_TELEMETRY} {_NUMBERS}",
    "telemetry_5m": f"""WITH {_windowed(300)} SELECT queue_url, period_start, successes, failures, mean_latency_ms, round(depth, 6) AS mean_queue_depth,
        round(failure_ratio, 6) AS failure_ratio FROM ratio""",
    "failure_ratio_1m": f"WITH {_windowed(60)} SELECT queue_url, period_start, round(failure_ratio, 6) AS failure_ratio FROM ratio",
    "failure_alarm": _alarm(3600, "failure_ratio > 0.2"),
    "queue_depth_alarm": _alarm(60, "depth > 50"),
}
