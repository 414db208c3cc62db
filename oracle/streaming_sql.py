from oracle.common import MESSAGE_PAGES, MESSAGES
from oracle.content_sql import _COLLAPSED, _MAIL
from oracle.service_sql import _JOBS, SQL as _BATCH

_CSV = "(regexp_matches(hx, '^(..)*2C') AND regexp_matches(hx, '^(..)*0A'))"

#: Every delivery of the three waves; a message without id is known by its body, queue and time.
_WAVES = f"""{MESSAGES},
sent AS (SELECT 0 AS wave, *, 1 AS cnt, CASE WHEN event_id % 7 = 0 THEN 2 ELSE 1 END AS n FROM messages WHERE event_id % 5 <> 0
  UNION ALL SELECT 1, *, 1, 1 FROM messages WHERE event_id % 5 = 0 OR event_id % 17 = 0
  UNION ALL SELECT 1, *, 2, 1 FROM messages WHERE event_id % 5 <> 0 AND event_id % 3 = 0
  UNION ALL SELECT 1, *, 3, 1 FROM messages WHERE event_id % 5 <> 0 AND event_id % 4 = 0
  UNION ALL SELECT 2, *, 5, 1 FROM messages WHERE failure_reason IS NOT NULL),
keyed AS (SELECT *, CASE WHEN event_id % 11 <> 0 THEN message_id END AS id,
    coalesce(id, concat_ws('/', coalesce(source_path, event_type), queue_url, stream, date_trunc('milliseconds', sent_at))) AS key FROM sent),
grouped AS (SELECT wave, key, cnt, any_value(id) AS id, any_value(failure_reason) AS failure, sum(n) AS n FROM keyed GROUP BY wave, key, cnt),
judged AS (SELECT *, cnt = max(cnt) OVER (PARTITION BY wave, key) AS top, min(wave) OVER (PARTITION BY key, cnt) < wave AS again,
    failure IS NULL AND min(wave) OVER (PARTITION BY key) < wave AS done FROM grouped),
placed AS (SELECT *, CASE WHEN again OR done THEN 'duplicates' WHEN failure IS NULL THEN 'metadata' ELSE 'failures' END AS destination,
    CASE WHEN again THEN 'handled_before' WHEN done THEN 'message_succeeded' ELSE coalesce(failure, 'accepted') END AS reason FROM judged)"""

SQL = {
    "stream_lifecycle": f"""WITH {_WAVES}, sized AS (SELECT wave::BIGINT AS batch_id, count(*) AS batch_size, count(*) FILTER (destination = 'metadata') AS successes,
          count(*) FILTER (destination = 'failures') AS failures FROM placed WHERE top AND destination <> 'duplicates' GROUP BY wave),
        total AS (SELECT sum(batch_size)::BIGINT AS n, sum(successes)::BIGINT AS good, sum(failures)::BIGINT AS bad FROM sized)
        SELECT 'batch_processed' AS event_name, batch_id, batch_size, successes, failures FROM sized
        UNION ALL SELECT 'completed', NULL, n, good, bad FROM total UNION ALL SELECT 'tables', NULL, n, good, bad FROM total""",
    "stream_redelivery": f"""WITH {_WAVES}
        SELECT destination, id AS message_id, reason, CASE WHEN destination <> 'metadata' THEN cnt END::INT AS receive_count, 1::BIGINT AS copies FROM placed WHERE top
        UNION ALL SELECT 'duplicates', id, 'repeated', cnt, n - 1 FROM placed WHERE top AND n > 1
        UNION ALL SELECT 'duplicates', id, 'superseded', cnt, n FROM placed WHERE NOT top
        UNION ALL SELECT 'failures', coalesce(id, 'body') || '/replay-1', reason, 1, 1 FROM placed WHERE top AND destination = 'failures' AND cnt = 5""",
    "stream_ingest": f"""WITH {MESSAGE_PAGES} SELECT message_id, source_path, CASE event_type WHEN 'click' THEN 'PDF' WHEN 'signup' THEN 'eml' ELSE 'tiff' END AS file_type,
        page_count, round(average_text_density, 6) AS layout_density, document_category, parser_strategy, overrides_applied, NULL AS failure_reason FROM message_routed
        UNION ALL SELECT message_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, failure_reason FROM messages WHERE failure_reason IS NOT NULL""",
    "stream_dead_letters": f"""WITH {MESSAGES} SELECT message_id, failure_reason, receive_count FROM messages WHERE failure_reason IS NOT NULL AND receive_count >= 5""",
    "stream_run_summary": f"""WITH {MESSAGES} SELECT 'run-0' AS run_id, count(*) AS messages, count(failure_reason) AS failures FROM messages""",
    "stream_telemetry": _BATCH["telemetry_5m"],
    "stream_job_status": f"WITH {_JOBS} SELECT job_id, status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS updated_at FROM jobs",
    "stored_mail": f"""WITH {_MAIL}, t AS (SELECT *, substr(hex(encode(text)), 1, 200) AS hx FROM mail)
        SELECT document_id AS bundle_id, NULL AS part_id, 1::BIGINT AS total_pages, 5::BIGINT AS total_blocks, 'succeeded' AS status FROM t
        UNION ALL SELECT document_id, 'root.attachment-1', 1, CASE WHEN {_CSV} AND NOT starts_with(text, chr(10)) THEN 3 ELSE 2 END, 'succeeded' FROM t""",
    "stream_attempts": f"WITH {_WAVES} SELECT id AS message_id, max(cnt)::INT AS receive_count, sum(n)::BIGINT AS deliveries FROM keyed GROUP BY id",
    "process_versions": f"""WITH d AS (SELECT 'd-' || doc_id AS document_id, doc_id, text AS original, 'doc ' || replace(text, chr(10), ' ') AS text FROM documents),
        v AS (SELECT *, 'id,"text, whole"' || chr(10) || doc_id || ',"' || replace(original, '"', '""') || '"' || chr(10) AS quoted, 'version of ' || document_id AS named FROM d),
        plain AS (SELECT document_id, sha256(text) AS checksum, sha256({_COLLAPSED}) AS text_sha256, sha256('') AS cells_sha256, 0::BIGINT AS cells, 'CharacterCount' AS field, doc_id FROM v)
        SELECT 0 AS batch, * EXCLUDE (doc_id) FROM plain
        UNION ALL SELECT 0, document_id, sha256(quoted), sha256('id, text, whole'), sha256('id|text, whole|' || doc_id || '|' || original), 4, 'RowCount' FROM v
        UNION ALL SELECT 1, * EXCLUDE (doc_id) FROM plain WHERE doc_id % 10 = 0
        UNION ALL SELECT 1, document_id, sha256(named), sha256(named), sha256(''), 0, 'CharacterCount' FROM v""",
}
