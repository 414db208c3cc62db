from oracle.common import MESSAGES, WS, strip

_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_SENTENCES = f"""s AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)),
    lambda x: {strip('x')}), lambda x: x <> '') AS ss FROM documents)"""


def _cut(n):
    return f"CASE WHEN length(text) > {n} THEN regexp_replace(substr(text, 1, {n}), ' [^ ]*$', '') ELSE text END"


SQL = {
    "fn_whitespace": f"""SELECT doc_id, sha256(trim(regexp_replace(text, '{WS}+', ' ', 'g'), ' ')) AS collapsed, sha256({strip('text')}) AS stripped,
        lang <> 'en' OR {strip('text')} = '' AS blank FROM documents""",
    "fn_sentences": f"WITH {_SENTENCES} SELECT doc_id, CAST(len(ss) AS INTEGER) AS sentences, ss[1] AS first, sha256(array_to_string(ss, '|')) AS checksum FROM s",
    "fn_truncate": f"SELECT doc_id, {_cut(512)} AS short, {_cut(40)} AS shorter FROM documents",
    "fn_titles": """WITH l AS (SELECT 'd-' || doc_id AS document_id, unnest(string_split(text, chr(10))) AS c, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ord FROM documents)
        SELECT document_id, ord, length(c) <= 120 AND length(c) - length(replace(c, ' ', '')) <= 15 AS fits FROM l WHERE c <> ''""",
    "fn_lines": f"""WITH j AS (SELECT doc_id, list_filter(regexp_split_to_array(text || chr(10) || chr(10) || lang || chr(10) || source, '{_BREAK}'), lambda l: {strip('l')} <> '') AS ls FROM documents)
        SELECT doc_id, CAST(len(ls) AS INTEGER) AS lines, sha256(array_to_string(ls, '|')) AS checksum FROM j""",
    "fn_paths": r"""SELECT page_id, regexp_extract(url, '(?s)(?:^|/)\.*[^./][^/]*\.([^./]*)$', 1) AS extension, '' AS hidden, 'gz' AS last,
        CASE WHEN page_id % 2 = 0 THEN 's3://bucket/' || url END AS uri, url || '#attachment/f.txt' AS attachment FROM pages""",
    "fn_mime_by_path": """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'application/pdf' WHEN '2-HIGH' THEN 'text/csv' WHEN '3-MEDIUM' THEN 'application/x-tar'
        WHEN '5-LOW' THEN 'text/html' END AS mime_type FROM orders""",
    "fn_json": f"""WITH {MESSAGES} SELECT message_id, event_type <> 'error' AS valid, false AS valid_with_tail, event_type = 'purchase' AND k % 10 = 0 AS has_routing,
        CASE WHEN event_type = 'view' THEN '7' WHEN event_type IN ('click', 'purchase') AND k > 0 THEN CAST(k AS VARCHAR) WHEN event_type = 'error' THEN NULL END AS page_count FROM messages""",
    "fn_metadata_merge": """SELECT o_orderkey, 'p' AS provider, o_orderstatus AS status, CASE WHEN o_orderstatus = 'F' THEN 'caller' ELSE o_orderpriority END AS priority FROM orders""",
    "fn_arrays": """SELECT l_orderkey, l_linenumber, 2 AS distinct_values, least(l_linenumber, 2.5)::DOUBLE AS least FROM lineitem""",
    "fn_rectangles": """SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_returnflag = 'A' THEN least(q, n) WHEN l_linestatus = 'O' THEN q ELSE 0 END AS x, CASE WHEN l_returnflag = 'A' THEN least(q, n) WHEN l_linestatus = 'O' THEN n ELSE 0 END AS y,
        CASE WHEN l_returnflag = 'A' THEN abs(q - n) WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS w, CASE WHEN l_returnflag = 'A' THEN abs(q - n) WHEN l_linestatus = 'O' THEN 3 ELSE 0 END AS h,
        CASE WHEN l_returnflag = 'A' THEN greatest(n - q, 0) * greatest(q - n, 0) ELSE 0 END AS area
        FROM (SELECT *, l_quantity AS q, l_linenumber::DOUBLE AS n FROM lineitem)""",
    "fn_numbers": """WITH o AS (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN o_custkey * 10.0 WHEN '3-MEDIUM' THEN o_custkey * 10.0 WHEN '5-LOW' THEN o_custkey + 0.5 END::DOUBLE AS number FROM orders)
        SELECT o_orderkey, number, CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_custkey * 10 END AS whole, CAST(trunc(number) AS BIGINT) AS count,
        CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE 1.0::DOUBLE END AS confidence, number IS NULL AS bad FROM o""",
    "fn_iso_time": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS shown, true AS same, epoch_us(ts) // 1000 AS millis, true AS bad_is_null FROM events",
    "fn_base64": """WITH d AS (SELECT doc_id, lang, text, CAST(strlen(text) AS INTEGER) AS n, CAST(strlen(to_base64(encode(text))) AS INTEGER) AS c FROM documents)
        SELECT doc_id, n AS decoded, c + 1 AS with_newline, c + 3 AS shifted, CAST(strlen(lang) AS INTEGER) AS lang_bytes, sha256(text) AS checksum FROM d""",
    "fn_utf8": """WITH b AS (SELECT doc_id, text, regexp_extract_all(substr(hex(encode(text)), 1, 256), '..') AS b FROM documents)
        SELECT doc_id, sha256(text) AS checksum, round(len(list_filter(b, lambda x: (x >= '20' AND x <= '7E') OR x IN ('09', '0A', '0D'))) / len(b)::DOUBLE, 6) AS ascii_share FROM b""",
    "fn_key_match": """SELECT lower(o_orderpriority) || '/' || o_orderkey || '.pdf' AS source_path, o_orderpriority = '1-URGENT' AND CAST(o_orderkey AS VARCHAR) LIKE '1%' AS first,
        o_orderkey % 2 = 0 AS second FROM orders""",
    "fn_block_ids": f"""SELECT conv_id, turn, CASE WHEN turn > 0 THEN 'root.attachment-' || turn END AS part_id,
        CASE WHEN turn > 0 THEN 'root.attachment-' || turn ELSE 'root' END || '-span-' || (turn + 1) AS block_id,
        {strip("role || ': ' || CASE WHEN turn > 1 THEN text ELSE '' END")} AS pair FROM conversations""",
}
