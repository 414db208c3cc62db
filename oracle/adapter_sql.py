from oracle.content_sql import _SUMMARY

_LINES = """
lines AS (SELECT doc_id, 'd-' || doc_id AS document_id, lang, source, n_chars, unnest(string_split(text, chr(10))) AS content,
          generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
full_lines AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS ord FROM lines WHERE content <> '')
"""

SQL = {
    "analyze_adapter": f"""WITH {_LINES} SELECT document_id, ord, content, CASE WHEN lang <> 'de' AND i % 2 = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS confidence,
        CASE WHEN lang = 'de' THEN 2 ELSE CAST(1 + i // 10 AS INTEGER) END AS page,
        CASE WHEN lang = 'de' THEN 'page-2-line-' || i WHEN i % 3 = 0 THEN 'para-' || i ELSE CAST(i AS VARCHAR) END AS span_id,
        CASE WHEN lang = 'de' THEN 'line' ELSE 'paragraph' END AS method, CASE WHEN lang <> 'de' THEN 4 END AS points FROM full_lines""",
    "analyze_adapter_fields": """SELECT 'd-' || doc_id AS document_id, 'Language' AS name, lang AS value, 'string' AS value_type, 0.9::DOUBLE AS confidence, NULL AS page FROM documents
        UNION ALL SELECT 'd-' || doc_id, 'Size', CAST(n_chars AS VARCHAR), 'number', 1.0, NULL FROM documents""",
    "analyze_adapter_tables": """SELECT 'd-' || doc_id AS document_id, 'facts' AS table_id, 0 AS row_index, unnest([0, 1, 2]) AS column_index,
        unnest([lang, source, CAST(n_chars AS VARCHAR)]) AS content, 2 AS column_span, 1 AS page FROM documents""",
    "analyze_adapter_segments": f"""WITH {_LINES} SELECT DISTINCT document_id, CAST(1 + i // 10 AS INTEGER) AS page_number, 'inferred' AS method, NULL::DOUBLE AS confidence,
          'azure_document_intelligence' AS parser FROM full_lines WHERE lang <> 'de'
        UNION ALL SELECT 'd-' || doc_id, 2, 'layout', 0.75, 'azure_document_intelligence' FROM documents WHERE lang = 'de'
        UNION ALL SELECT 'd-' || doc_id, 1, 'analysis', NULL, 'azure_document_intelligence' FROM documents WHERE lang <> 'de' AND doc_id NOT IN (SELECT doc_id FROM full_lines)""",
    "vision_adapter": f"""WITH {_LINES} SELECT document_id, ord, content, CASE WHEN i % 2 = 0 THEN CAST(i + 1 AS INTEGER) END AS page, 'span-' || i AS span_id FROM full_lines
        UNION ALL SELECT 'd-' || doc_id, -1, source, NULL, 'databricks_llm_image' FROM documents""",
    "page_payload_adapter": f"""WITH {_LINES} SELECT document_id, ord, content, CAST(1 + i // 5 AS INTEGER) AS page, 'p' || (1 + i // 5) || '-span-' || (i % 5) AS span_id,
        0.5::DOUBLE AS confidence FROM full_lines""",
    "page_payload_fields": """WITH p AS (SELECT doc_id, lang, (len(string_split(text, chr(10))) - 1) // 5 AS last FROM documents), q AS (SELECT *, unnest(range(last + 1)) AS n FROM p)
        SELECT 'd-' || doc_id AS document_id, n AS ord, 'Lang' AS name, lang AS value, CAST(CASE WHEN n = 0 THEN 1 ELSE n END AS INTEGER) AS page FROM q
        UNION ALL SELECT 'd-' || p.doc_id, last + 1, '0', CASE WHEN n_chars <> 0 THEN CAST(n_chars AS VARCHAR) END, 1 FROM p JOIN documents USING (doc_id)""",
    "email_adapter": """SELECT 'd-' || doc_id AS document_id, 'email' AS document_type, 'message/rfc822' AS mime_type, source AS subject, text AS body, 3 AS fields,
        'size' AS entity, CAST(n_chars AS VARCHAR) AS entity_value, 1 AS attachments, 'attachment-0' AS attachment_id FROM documents""",
    "merge_parsers": f"""WITH {_LINES} SELECT 'd-' || d.doc_id AS document_id, 'document' AS document_type, d.source AS mime_type,
        '["pymupdf","databricks_llm_image"]' AS parsers_used, d.lang, CAST((SELECT count(*) FROM full_lines f WHERE f.doc_id = d.doc_id) + 1 AS INTEGER) AS spans, text AS last_span,
        CAST((len(string_split(text, chr(10))) - 1) // 5 + 2 AS INTEGER) AS segments, CAST((len(string_split(text, chr(10))) - 1) // 5 + 1 AS INTEGER) AS fields FROM documents d""",
    "bad_confidence": """SELECT 'd-' || doc_id AS document_id, CASE WHEN n_chars % 2 = 1 THEN 'confidence values must be numeric' END AS adapter_error FROM documents""",
    "canonical_json": f"""WITH {_LINES} SELECT 'd-' || d.doc_id AS document_id, '1.1' AS schema_version, 'azure_document_intelligence' AS provider, false AS has_summaries,
        true AS has_tables, CAST((SELECT count(*) FROM full_lines f WHERE f.doc_id = d.doc_id) AS INTEGER) AS spans, 'note' AS footnote FROM documents d""",
    "reassembled_documents": f"""WITH {_LINES} SELECT document_id, CAST(count(*) AS INTEGER) AS spans, 2 AS fields, sha256(string_agg(content, chr(10) ORDER BY ord)) AS checksum FROM full_lines GROUP BY 1""",
    "process_documents": f"""WITH {_LINES}, {_SUMMARY} SELECT 'paragraph' AS block_type, count(*) AS rows, count(DISTINCT doc_id) AS documents FROM full_lines
        UNION ALL SELECT 'table', count(*), count(*) FROM documents UNION ALL SELECT 'kv_pair', 2 * count(*), count(*) FROM documents
        UNION ALL SELECT 'extraction', 2 * count(*), count(*) FROM documents UNION ALL SELECT 'summary', count(*), count(*) FROM summ""",
    "page_selection": f"""WITH {_LINES} SELECT 'list' AS how, document_id, i AS ord FROM full_lines WHERE i // 5 IN (0, 2)
        UNION ALL SELECT 'column', document_id, i FROM full_lines WHERE i % 2 = 1 OR i // 5 = 1""",
    "page_tables": """SELECT l_partkey AS document_id, 'pdf-table-' || l_linenumber || '-0' AS table_id, 'cap' AS caption, l_linenumber AS row_index, 0 AS column_index,
        l_returnflag AS content, 1 AS points FROM lineitem
        UNION ALL SELECT l_partkey, 'pdf-table-' || l_linenumber || '-0', 'cap', l_linenumber, 0, l_linestatus || ' x', 0 FROM lineitem""",
}
