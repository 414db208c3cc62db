from oracle.common import MESSAGE_PAGES, MESSAGES, PAGE_METRICS

_SHARES = "table_page_ratio scanned_page_ratio checkbox_page_ratio radio_button_page_ratio form_page_ratio".split()


def _rounded(names):
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_STRATEGY = """
  CASE overrides_applied WHEN 'request' THEN request_override WHEN 'pattern:(?i)URGENT' THEN 'urgent_parser'
       WHEN 'pattern:^2-high/.*9[.]pdf$' THEN 'high_nine' WHEN 'pattern:high' THEN 'high_parser'
       WHEN 'threshold_redirect' THEN 'fallback_parser'
       ELSE CASE document_category WHEN 'short_form' THEN 'general_short' WHEN 'long_form' THEN 'long_form_parser'
            WHEN 'table_heavy' THEN 'table_extractor' WHEN 'form_heavy' THEN 'form_parser'
            WHEN 'scanned' THEN 'vision_parser' ELSE 'fallback_parser' END END AS parser_strategy,
  CASE overrides_applied WHEN 'request' THEN 'request_override' WHEN 'threshold_redirect' THEN 'page_threshold_exceeded'
       WHEN 'category_default' THEN 'category_default' ELSE 'config_pattern_override' END AS strategy_reason,
  CASE overrides_applied WHEN 'pattern:(?i)URGENT' THEN 'urgent-v1' WHEN 'threshold_redirect' THEN 'fallback-v1'
       WHEN 'category_default' THEN CASE document_category WHEN 'short_form' THEN 'prebuilt-read' WHEN 'long_form' THEN 'prebuilt-layout'
            WHEN 'scanned' THEN 'vision-v2' WHEN 'unknown' THEN 'fallback-v1' END END AS parser_model,
  CASE overrides_applied WHEN 'pattern:(?i)URGENT' THEN 25
       WHEN 'threshold_redirect' THEN CASE document_category WHEN 'short_form' THEN 2 WHEN 'long_form' THEN 8 ELSE 4 END
       WHEN 'category_default' THEN CASE WHEN document_category = 'long_form' THEN 500 END END AS strategy_max_pages
"""

SQL = {
    "layout_profile": f"""WITH {PAGE_METRICS} SELECT document_id, page_count,
        {_rounded(["average_text_density", "average_image_density", *_SHARES])},
        total_tables, total_checkboxes, total_radio_buttons FROM profile""",
    "route_documents": f"""WITH {PAGE_METRICS} SELECT source_path, page_count,
        {_rounded(["average_text_density", "average_image_density"])}, document_category, {_STRATEGY},
        overrides_applied, request_override FROM decided""",
    "route_documents_static": f"""WITH {PAGE_METRICS}, s AS (
        SELECT coalesce(CASE matched WHEN 'request' THEN request_override WHEN 'pattern:(?i)URGENT' THEN 'urgent_parser'
                 WHEN 'pattern:^2-high/.*9[.]pdf$' THEN 'high_nine' WHEN 'pattern:high' THEN 'high_parser' END, 'one_parser') AS parser_strategy,
               CASE WHEN matched = 'request' THEN 'request_override' WHEN matched IS NULL THEN 'config_static'
                    ELSE 'config_pattern_override' END AS strategy_reason,
               CASE WHEN matched IS NULL THEN 'one-v1' WHEN matched = 'pattern:(?i)URGENT' THEN 'urgent-v1' END AS parser_model,
               CASE WHEN matched IS NULL THEN 40 WHEN matched = 'pattern:(?i)URGENT' THEN 25 END AS strategy_max_pages
        FROM decided)
        SELECT *, count(*) AS documents FROM s GROUP BY ALL""",
    "category_mix": f"""WITH {PAGE_METRICS} SELECT document_category, count(*) AS documents, CAST(sum(page_count) AS BIGINT) AS pages
        FROM decided GROUP BY 1""",
    "override_precedence": f"""WITH {PAGE_METRICS}, a AS (SELECT source_path, request_override,
          CASE WHEN regexp_matches(source_path, '7[.]pdf$') THEN 1 WHEN contains(source_path, 'urgent') THEN 2
               WHEN contains(source_path, 'not specified') THEN 3 WHEN contains(source_path, 'low') THEN 4 ELSE 5 END AS hit FROM keys)
        SELECT source_path, coalesce(request_override, ['secret_layer', 'table_layer', 'table_layer_pattern', 'env_layer', 'env_rest'][hit]) AS strategy,
          CASE WHEN request_override IS NOT NULL THEN 'request'
               ELSE 'pattern:' || ['7[.]pdf$', 'urgent', 'not specified', 'low', '[.]pdf'][hit] END AS applied FROM a""",
    "override_many": """WITH k AS (SELECT o_orderkey AS k, lower(o_orderpriority) || '/' || o_orderkey || '.pdf' AS source_path, o_orderpriority AS p FROM orders),
      c AS (SELECT k.*, p1.p_partkey AS part,
              least(CASE WHEN k >= 10 THEN c1.c_custkey END, c2.c_custkey) AS cust,
              (SELECT min(n_nationkey) FROM nation WHERE p = '3-MEDIUM' AND ends_with(k::VARCHAR, n_nationkey::VARCHAR)) AS ending,
              CASE WHEN p = '4-NOT SPECIFIED' THEN (SELECT min(n_nationkey) FROM nation WHERE n_nationkey + 1 = length(k::VARCHAR)) END AS digits
            FROM k LEFT JOIN part p1 ON p1.p_partkey * 7 = k AND p IN ('1-URGENT', '2-HIGH')
                   LEFT JOIN customer c1 ON c1.c_custkey = k // 10 AND p = '5-LOW' LEFT JOIN customer c2 ON c2.c_custkey = k AND p = '5-LOW')
      SELECT source_path, CASE WHEN part IS NOT NULL THEN 'part-' || part % 10 WHEN cust IS NOT NULL THEN 'customer-' || cust % 10
               WHEN ending IS NOT NULL THEN 'ending-' || ending WHEN digits IS NOT NULL THEN 'digits-' || digits END AS strategy,
             CASE WHEN part IS NOT NULL THEN 'model-' || part % 3 END AS model, CASE WHEN part IS NOT NULL THEN part % 50 END::INT AS max_pages,
             CASE WHEN part IS NOT NULL THEN 'pattern:^[12]-[a-z]*/' || part * 7 || '[.]pdf$'
                  WHEN cust IS NOT NULL THEN 'pattern:(?i)LOW/' || cust || '[0-9]?[.]PDF$'
                  WHEN ending IS NOT NULL THEN 'pattern:3-medium/.*' || ending || '[.]pdf'
                  WHEN digits IS NOT NULL THEN 'pattern:^[4]\\W\\w+\\W\\w+[/]\\d{' || digits + 1 || '}\\W' END AS applied FROM c""",
    "override_sources": """WITH n AS (SELECT *, n_nationkey % 4 AS kind, lower(n_name) AS name FROM nation)
        SELECT n_nationkey, 0::BIGINT AS position, name || '/.*' AS pattern, 's' || n_regionkey AS strategy, n_nationkey AS max_pages FROM n WHERE kind IN (0, 2)
        UNION ALL SELECT n_nationkey, 1, name || '-doc', 't' || n_nationkey, NULL FROM n WHERE kind = 0
        UNION ALL SELECT n_nationkey, 0, name || '-doc', 't' || n_nationkey, NULL FROM n WHERE kind = 1
        UNION ALL SELECT n_nationkey, 1, name || '/.*', 's' || n_regionkey, n_nationkey FROM n WHERE kind = 1""",
    "message_parse": f"WITH {MESSAGES} SELECT message_id, source_path, failure_reason, receive_count FROM messages",
    "message_quarantine": f"""WITH {MESSAGES} SELECT message_id, queue_url, failure_reason, receive_count, source_path
        FROM messages WHERE failure_reason IS NOT NULL""",
    "failure_breakdown": f"""WITH {MESSAGES} SELECT failure_reason, count(*) AS failures FROM messages
        WHERE failure_reason IS NOT NULL GROUP BY 1""",
    "message_descriptors": f"""WITH {MESSAGES} SELECT message_id,
        CASE WHEN event_type = 'purchase' THEN 'b' || (user_id % 4) END AS bucket,
        CASE WHEN event_type = 'purchase' THEN 's3://b' || (user_id % 4) || '/' || source_path END AS source_uri,
        CASE event_type WHEN 'click' THEN 'PDF' WHEN 'signup' THEN 'eml' ELSE 'tiff' END AS file_type,
        CASE WHEN event_type = 'purchase' THEN 'topic-' || (user_id % 3) END AS sns_topic,
        CASE event_type WHEN 'click' THEN 'application/pdf' WHEN 'signup' THEN 'message/rfc822' ELSE 'image/tiff' END AS mime_type,
        CASE WHEN event_type = 'purchase' AND k % 10 = 0 THEN 'manual_review' END AS request_override
        FROM messages WHERE failure_reason IS NULL""",
    "ingestion_metadata": f"""WITH {MESSAGE_PAGES} SELECT source_path,
        CASE event_type WHEN 'click' THEN 'PDF' WHEN 'signup' THEN 'eml' ELSE 'tiff' END AS file_type, message_id,
        CASE WHEN event_type = 'purchase' THEN 'topic-' || (user_id % 3) END AS sns_topic, queue_url,
        CASE event_type WHEN 'click' THEN 'application/pdf' WHEN 'signup' THEN 'message/rfc822' ELSE 'image/tiff' END AS mime_type,
        page_count, round(average_text_density, 6) AS layout_density, round(average_image_density, 6) AS image_density,
        {_rounded(_SHARES)}, total_tables, total_checkboxes, document_category, parser_strategy, strategy_reason, parser_model,
        strategy_max_pages, overrides_applied, request_override, CAST(page_count AS INTEGER) AS listed_pages FROM message_routed""",
    "routing_records": f"""WITH {MESSAGE_PAGES} SELECT source_path, document_category AS category, parser_strategy AS strategy,
        overrides_applied AS override, round(average_text_density, 6) AS average_text_density, 0 AS first_page FROM message_routed""",
    "page_payloads": f"""WITH {MESSAGE_PAGES} SELECT message_id, "index", round(text_density, 6) AS text_density,
        round(image_density, 6) AS image_density, round(table_density, 6) AS table_density, table_count, checkbox_count FROM message_pages""",
    "synthetic_pages": f"""WITH {MESSAGES} SELECT message_id, greatest(k, 1) AS pages, CAST(greatest(k, 1) - 1 AS INTEGER) AS last_index
        FROM messages WHERE event_type IN ('click', 'purchase')""",
    "document_pages_json": f"""WITH {PAGE_METRICS} SELECT document_id, count(*) AS pages, CAST(sum(char_count) AS BIGINT) AS chars
        FROM page_metrics GROUP BY 1""",
}
