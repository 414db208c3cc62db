from oracle.common import WS, strip

_RAW = """
raw AS (SELECT 'd-' || doc_id AS document_id, text, 's3://docs/' || source || '/' || doc_id || '.txt' AS uri FROM documents
        UNION ALL SELECT 'p-' || page_id, html, 's3://web/' || page_id || '.bin' FROM pages),
bytes AS (SELECT *, hex(encode(text)) AS hx FROM raw)
"""
_COLLAPSED = f"trim(regexp_replace(text, '{WS}+', ' ', 'g'), ' ')"
_STRIPPED_LINES = f"list_filter(list_transform(string_split(text, chr(10)), lambda l: {strip('l')}), lambda l: l <> '')"
_SUMMARY = f"""
sl AS (SELECT *, {_STRIPPED_LINES} AS ls FROM documents),
dl AS (SELECT * EXCLUDE (ls), list_filter(ls, lambda l, i: list_position(ls, l) = i) AS ls FROM sl),
st AS (SELECT *, list_filter(list_transform(string_split(regexp_replace(array_to_string(ls, chr(10)), '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)),
              lambda s: {strip('s')}), lambda s: s <> '') AS ss FROM dl),
sj AS (SELECT *, array_to_string(ss[1:2], ' ') AS j FROM st WHERE len(ls) > 0),
summ AS (SELECT *, CASE WHEN length(j) > 512 THEN regexp_replace(substr(j, 1, 512), ' [^ ]*$', '') ELSE j END AS summary,
         list_filter(ls, lambda l: length(l) <= 120 AND length(l) - length(replace(l, ' ', '')) <= 15)[1] AS title FROM sj)
"""
_TOKENS = f"list_filter(regexp_split_to_array(text, '{WS}+'), lambda w: w <> '')"
_PUNCT = "'!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~'"
_PAYLOADS = """
payloads AS (SELECT doc_id, lang AS document_id, sha256(text) AS checksum FROM documents),
stored AS (SELECT document_id, checksum FROM payloads WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)),
fresh AS (SELECT DISTINCT document_id, checksum FROM payloads EXCEPT SELECT document_id, checksum FROM stored)
"""
# the entities the web pages use
_DECODED = "{x}"
for _name, _code in (("lt", 60), ("gt", 62), ("quot", 34), ("#39", 39), ("nbsp", 160), ("copy", 169), ("middot", 183), ("amp", 38)):
    _DECODED = f"replace({_DECODED}, '&{_name};', chr({_code}))"
_HTML_COUNTS = f"""
a AS (SELECT page_id, url, regexp_replace(replace(html, 'var t="</p>"', 'var t="@/p@"'), '<!--.*?-->', '', 'gs') AS h FROM pages),
b AS (SELECT page_id, url, h, {_DECODED.format(x="regexp_replace(h, '<[^>]*>', '', 'g')")} AS t FROM a),
c AS (SELECT page_id, url, length({strip('t')}) AS char_count, len(regexp_extract_all(h, '(?i)<table[ >]')) AS table_count,
        len(regexp_extract_all(h, '(?i)<img[ >/]')) AS image_count, len(regexp_extract_all(h, '(?i)<input[^>]*checkbox')) AS checkbox_count,
        len(regexp_extract_all(h, '(?i)<input[^>]*radio')) AS radio_button_count FROM b),
html_parts AS (SELECT *, round(least(char_count / 4000.0::DOUBLE, 1.0), 6) AS text_density, least(image_count * 0.1::DOUBLE, 1.0) AS image_density,
        least(table_count * 0.25::DOUBLE, 1.0) AS table_density FROM c)
"""
# a page's address and the page itself as two parts of a message
_PAGE_PARTS = f"""{_HTML_COUNTS},
page_parts AS (SELECT *, least(char_count / 4000.0::DOUBLE, 1.0) AS html_density, least(length({strip('url')}) / 3000.0::DOUBLE, 1.0) AS url_density FROM html_parts)
"""
_PAGE_PROFILE = """round((html_density + url_density) / 2, 6) AS average_text_density, round((image_density + 0.05::DOUBLE) / 2, 6) AS average_image_density,
        CASE WHEN table_density >= 0.5 OR table_count > 0 THEN 0.5 ELSE 0 END::DOUBLE AS table_page_ratio,
        CASE WHEN checkbox_count > 0 OR radio_button_count > 0 THEN 0.5 ELSE 0 END::DOUBLE AS form_page_ratio"""
_MAIL = """
mail AS (SELECT 'm-' || conv_id || '.' || turn AS document_id, conv_id || '.' || turn AS name, role, text FROM conversations)
"""

SQL = {
    "text_documents": f"""WITH {_RAW}, c AS (SELECT document_id, coalesce(nullif({_COLLAPSED}, ''), '(empty document)') AS paragraph FROM raw)
        SELECT document_id, paragraph, length(paragraph) AS character_count FROM c""",
    "format_dispatch": f"""WITH {_RAW}, f AS (SELECT document_id, CASE WHEN starts_with(hx, hex('From:')) OR
            regexp_matches(substr(hx, 1, 400), '^(..)*' || hex('Content-Type: multipart')) THEN 'email' END AS mail,
          regexp_matches(substr(hx, 1, 200), '^(..)*2C') AND regexp_matches(substr(hx, 1, 200), '^(..)*0A') AS csv,
          CASE WHEN starts_with(hx, hex('PK')) THEN 'excel' WHEN starts_with(hx, hex('%PDF')) THEN 'pdf' ELSE 'text' END AS rest FROM bytes)
        SELECT document_id, coalesce(mail, CASE WHEN csv THEN 'csv' END, rest) AS format, coalesce(mail, rest) AS strict_format FROM f""",
    "mime_sniff": f"""WITH {_RAW}, s AS (SELECT document_id, uri, text, lower({strip('text')}) AS head,
            regexp_extract_all(substr(hx, 1, 256), '..') AS b FROM bytes),
        a AS (SELECT *, len(list_filter(b, lambda x: (x >= '20' AND x <= '7E') OR x IN ('09', '0A', '0D'))) / len(b)::DOUBLE AS share FROM s)
        SELECT document_id, coalesce(CASE WHEN starts_with(head, '<!doctype html') OR starts_with(head, '<html') OR contains(substr(head, 1, 200), '<html') THEN 'text/html'
                 WHEN starts_with(head, '<?xml') THEN 'application/xml' WHEN starts_with(head, 'from:') OR starts_with(head, 'received:') THEN 'message/rfc822'
                 WHEN share > 0.9 THEN 'text/plain' WHEN uri LIKE '%.txt' THEN 'text/plain' WHEN uri LIKE '%.bin' THEN 'application/octet-stream' END) AS mime_type,
               round(share, 6) AS ascii_share, sha256(text) AS checksum FROM a""",
    "inline_payloads": """SELECT 'd-' || doc_id AS document_id, sha256(text) AS checksum, CAST(strlen(text) AS INTEGER) AS size FROM documents""",
    "csv_documents": """WITH d AS (SELECT 'd-' || doc_id AS document_id, doc_id, text FROM documents)
        SELECT document_id, 0 AS row_index, 0 AS column_index, 'id' AS content FROM d UNION ALL SELECT document_id, 0, 1, 'text, whole' FROM d
        UNION ALL SELECT document_id, 1, 0, CAST(doc_id AS VARCHAR) FROM d UNION ALL SELECT document_id, 1, 1, text FROM d""",
    "csv_headers": "SELECT 'd-' || doc_id AS document_id, 'id, text, whole' AS paragraph, 2::BIGINT AS row_count FROM documents",
    "file_content": """WITH s AS (SELECT source, count(*) AS documents, string_agg(text || chr(10), '' ORDER BY doc_id) AS whole FROM documents GROUP BY source)
        SELECT source, documents, strlen(whole)::BIGINT AS size, sha256(whole) AS checksum FROM s UNION ALL SELECT source, documents, NULL, NULL FROM s""",
    "email_documents": f"""WITH {_MAIL} SELECT document_id, text AS body, 'Turn ' || name AS subject, role || '@example.com' AS sender,
        'desk@example.com' AS recipient, 'turn.txt' AS attachment_names FROM mail""",
    "email_parts": f"""WITH {_MAIL} SELECT document_id, 'turn.txt' AS file_name, 'text/plain' AS mime_type, sha256(text) AS checksum,
        CAST(strlen(text) AS BIGINT) AS size_bytes, '<c1>' AS content_id, '3' AS attachment_id, document_id || '::attachment-3' AS child_document_id,
        'root.attachment-1' AS part_id, 's3://mail/' || name || '#attachment/turn.txt' AS source_uri FROM mail""",
    "email_layout": f"""WITH {_MAIL}, {_PAGE_PARTS}
      SELECT document_id, 2::BIGINT AS page_count, round(least(length({strip('text')}) / 3000.0::DOUBLE, 1.0), 6) AS average_text_density,
        0.05::DOUBLE AS average_image_density, 0.0::DOUBLE AS table_page_ratio, 0.0::DOUBLE AS form_page_ratio, 0::BIGINT AS total_tables, 0::BIGINT AS total_checkboxes FROM mail
      UNION ALL SELECT 'p-' || page_id, 2, {_PAGE_PROFILE}, table_count, checkbox_count FROM page_parts""",
    "route_content": f"""WITH {_PAGE_PARTS}, profiled AS (
      SELECT 'mail/' || page_id || '.eml' AS source_path, 2::BIGINT AS page_count, {_PAGE_PROFILE}, table_count AS total_tables,
        CASE WHEN page_id % 3 > 0 AND page_id % 10 = 7 THEN 'OSError: store is down' END AS error FROM page_parts WHERE page_id % 3 < 2
      UNION ALL SELECT 'mail/' || page_id || '.eml', 2, 0.25, 0.75, 0, 0, 0, CASE WHEN page_id % 10 = 7 THEN 'OSError: store is down' END FROM pages WHERE page_id % 3 = 2
      UNION ALL SELECT 'text/' || doc_id || '.txt', 2, CASE WHEN doc_id % 10 = 0 THEN 0.5 ELSE 0.25 END, CASE WHEN doc_id % 10 = 0 THEN 0.5 ELSE 0.75 END,
        CASE WHEN doc_id % 10 = 0 THEN 0.5 ELSE 0 END, 0, CASE WHEN doc_id % 10 = 0 THEN 1 ELSE 0 END, NULL FROM documents),
      scanned AS (SELECT *, CASE WHEN source_path LIKE 'text/%0.txt' THEN 0.5 WHEN source_path LIKE 'text/%' OR regexp_extract(source_path, '[0-9]+')::BIGINT % 3 = 2 THEN 1.0
          ELSE (SELECT CASE WHEN image_density >= 0.6 OR image_count > 2 THEN 0.5 ELSE 0.0 END FROM page_parts q WHERE 'mail/' || q.page_id || '.eml' = source_path) END AS scan FROM profiled),
      routed AS (SELECT *, CASE WHEN scan >= 0.5 THEN 'scanned' WHEN table_page_ratio >= 0.3 THEN 'table_heavy' WHEN form_page_ratio >= 0.25 THEN 'form_heavy'
          WHEN page_count <= 3 AND round(average_text_density, 9) >= 0.3 THEN 'short_form' ELSE 'unknown' END AS document_category FROM scanned)
      SELECT source_path, page_count, average_text_density::DOUBLE AS average_text_density, average_image_density::DOUBLE AS average_image_density,
        table_page_ratio::DOUBLE AS table_page_ratio, form_page_ratio::DOUBLE AS form_page_ratio, total_tables, document_category,
        CASE document_category WHEN 'scanned' THEN 'vision' WHEN 'table_heavy' THEN 'tables' WHEN 'form_heavy' THEN 'forms' WHEN 'short_form' THEN 'short' ELSE 'rest' END AS parser_strategy,
        error FROM routed""",
    "html_layout": f"""WITH {_HTML_COUNTS}
        SELECT page_id, char_count, table_count, image_count, checkbox_count, radio_button_count,
               text_density, image_density, table_density FROM html_parts""",
    "html_text": f"""WITH t AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '{WS}+', ' ', 'g'), ' ') AS s FROM pages)
        SELECT page_id, CAST(length(s) AS INTEGER) AS chars, sha256(s) AS checksum FROM t""",
    "text_part_metrics": f"""SELECT 'd-' || doc_id AS document_id, length({strip('text')}) AS char_count,
        round(least(length({strip('text')}) / 3000.0::DOUBLE, 1.0), 6) AS text_density, 0.05::DOUBLE AS image_density FROM documents""",
    "page_block_metrics": """WITH b AS (SELECT *, CASE WHEN l_returnflag = 'A' THEN 'text' WHEN l_returnflag = 'N' THEN 'image' WHEN l_linestatus = 'O' THEN 'table'
                 WHEN l_linenumber < 4 THEN 'checkbox' ELSE 'radio' END AS kind, greatest(l_quantity - 5, 0) * 6 AS area FROM lineitem)
        SELECT l_orderkey, l_linenumber, round(least(sum(CASE WHEN kind = 'text' THEN area ELSE 0 END) / 200.0, 1.0), 6) AS text_density,
          round(least(sum(CASE WHEN kind = 'image' THEN area ELSE 0 END) / 200.0, 1.0), 6) AS image_density,
          round(least(sum(CASE WHEN kind = 'table' THEN area ELSE 0 END) / 200.0, 1.0), 6) AS table_density,
          CAST(coalesce(sum(l_partkey) FILTER (kind = 'text'), 0) AS BIGINT) AS char_count, count(*) FILTER (kind = 'table') AS table_count,
          count(*) FILTER (kind = 'image') AS image_count, count(*) FILTER (kind = 'checkbox') AS checkbox_count,
          count(*) FILTER (kind = 'radio') AS radio_button_count FROM b GROUP BY 1, 2""",
    "heuristic_summary": f"""WITH {_SUMMARY} SELECT 'd-' || doc_id AS document_id, summary, title, 0.3::DOUBLE AS confidence,
        'heuristic_leading_sentences' AS method FROM summ""",
    "summary_input": f"""WITH {_SUMMARY} SELECT 'd-' || doc_id AS document_id, array_to_string(ls, chr(10)) AS text FROM dl WHERE len(ls) > 0""",
    "model_summary": f"""WITH {_SUMMARY}, m AS (SELECT *, doc_id % 4 AS shape FROM summ)
        SELECT 'd-' || doc_id AS document_id, CASE WHEN shape < 2 THEN {strip('text')} ELSE summary END AS summary,
          CASE shape WHEN 0 THEN lang WHEN 1 THEN NULL ELSE title END AS title,
          CASE shape WHEN 0 THEN 0.85::DOUBLE WHEN 1 THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END AS confidence,
          CASE WHEN shape < 2 THEN 'azure_openai' ELSE 'heuristic_leading_sentences' END AS method,
          CASE shape WHEN 0 THEN 'summarizer' WHEN 1 THEN 'own-model' END AS model,
          CASE shape WHEN 0 THEN 'why' WHEN 1 THEN 'because' ELSE 'Generated via deterministic leading-sentence heuristic fallback.' END AS justification,
          CASE shape WHEN 0 THEN source END AS source FROM m""",
    "keyword_enrichment": f"""WITH k AS (SELECT doc_id, list_transform(list_filter(list_transform({_TOKENS}, lambda w: trim(w, {_PUNCT})),
          lambda w: length(w) >= 6), lambda w: lower(w)) AS ks FROM documents)
        SELECT 'd-' || doc_id AS document_id, coalesce(array_to_string(list_filter(ks, lambda w, i: list_position(ks, w) = i)[1:5], ','), '') AS keywords FROM k""",
    "keyword_insights": f"""WITH k AS (SELECT doc_id, text, list_sort(list_distinct(list_transform(regexp_extract_all(text, '[A-Za-z]{{6,}}'), lambda w: lower(w)))) AS ks FROM documents)
        SELECT 'd-' || doc_id AS document_id, coalesce(array_to_string(ks[1:10], ','), '') AS keywords, coalesce(array_to_string(ks[1:6], ','), '') AS short_keywords,
          CAST(len({_TOKENS}) AS INTEGER) AS token_count FROM k""",
    "enrichment_batches": "SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 8 AS batch FROM documents",
    "enrichment_merge": f"""SELECT 'd-' || doc_id AS document_id, 3 AS entries, 'words,keyword_insights,keyword_extraction' AS providers,
        CAST(len({_TOKENS}) AS INTEGER) AS words, 7 AS duration_ms, 0.9::DOUBLE AS confidence, CAST(len({_TOKENS}) AS INTEGER) AS token_count FROM documents""",
    "enrichment_normalise": """WITH l AS (SELECT *, 'd-' || doc_id AS document_id FROM labels)
        SELECT document_id, 0::BIGINT AS ord, 'a' AS enrichment_type, 'p' AS provider, '{"q":' || quality || '}' AS content,
               CAST('0.' || toxic || '5' AS DOUBLE) AS confidence, NULL AS model, 12::BIGINT AS duration_ms, '1' AS duration_in_metadata FROM l
        UNION ALL SELECT document_id, 3, 'c', 'p', '{"d":"' || doc_id || '"}', NULL, 'm', 12, '12' FROM l
        UNION ALL SELECT document_id, 4, 'd', 'p', '{}', NULL, NULL, 12, '12' FROM l""",
    "idempotent_append": f"WITH {_PAYLOADS} SELECT * FROM fresh",
    "idempotent_force": f"""WITH {_PAYLOADS}, u AS (SELECT document_id FROM fresh WHERE document_id <> 'en' UNION ALL SELECT document_id FROM payloads WHERE document_id = 'en')
        SELECT document_id, count(*) AS payloads FROM u GROUP BY 1""",
    "skipped_documents": f"""WITH {_PAYLOADS} SELECT doc_id, (document_id, checksum) IN (SELECT (document_id, checksum) FROM stored) AS skipped FROM payloads""",
}
