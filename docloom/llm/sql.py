"""Expected results of the corpus queries as SQL, where SQL can express them."""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Base32 of a SHA-1: five hexadecimal digits make four letters.
_DIGEST = f"""array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: substr('{_BASE32}', 1 + ((('0x' || substr(hex, 1 + 5 * g, 5))::BIGINT >> s) & 31), 1)), '')), '')"""



def _part(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE octet_length(encode(({value})::VARCHAR)) || ':' || {value} END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_part(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


#: CRC-32 of a decimal, bit by bit: each character, then eight shifts (-1).
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END), 4294967295::BIGINT)"""

#: Terms of a text, only A-Z lower-cased.
_TERMS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), [])"""


def _tree(name: str, leaves: str) -> str:
    """Nodes of the trees of ``leaves`` (tree, idx, digest, n), and per node what stands before and behind it in its run."""
    return f"""{name} AS (
    SELECT tree, 0 AS lvl, idx, digest, n FROM {leaves}
    UNION ALL
    SELECT tree, lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY tree, lvl, idx // 3, n),
{name}_runs AS (
    SELECT a.tree, a.lvl, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
           coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS behind
    FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.lvl = b.lvl AND a.idx // 3 = b.idx // 3 WHERE a.n > 1 GROUP BY a.tree, a.lvl, a.idx),
{name}_root AS (SELECT tree, digest FROM {name} WHERE n = 1)"""


def _fold(name: str, nodes: str, start: str) -> str:
    """Digest of each (id, tree, idx, digest) of ``start`` folded to its root, with the proof."""
    return f"""{name} AS (
    SELECT id, tree, 0 AS lvl, idx, digest, '' AS proof FROM {start}
    UNION ALL
    SELECT f.id, f.tree, f.lvl + 1, f.idx // 3, sha256(r.before || f.digest || r.behind), f.proof || r.before || r.behind
    FROM {name} f JOIN {nodes}_runs r ON r.tree = f.tree AND r.lvl = f.lvl AND r.idx = f.idx),
{name}_end AS (SELECT id, arg_max(digest, lvl) AS digest, arg_max(proof, lvl) AS proof FROM {name} GROUP BY id)"""


SQL: dict[str, str] = {
    "op3_warc_salvage": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     h AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, {_DIGEST} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE rows AS (
    SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf('text')} AS leaf,
           {_leaf(f"CASE WHEN ({_CRC}) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS claim FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n, leaf AS digest FROM rows),
{_tree('nodes', 'leaves')},
sources AS (SELECT '' AS tree, tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes_root),
{_tree('tops', 'sources')},
claims AS (SELECT doc_id AS id, tree, idx, claim AS digest FROM leaves),
{_fold('folded', 'nodes', 'claims')},
ends AS (SELECT l.doc_id AS id, '' AS tree, s.idx, f.digest FROM leaves l JOIN folded_end f ON f.id = l.doc_id JOIN sources s ON s.name = l.tree),
{_fold('above', 'tops', 'ends')}
SELECT l.doc_id, l.leaf, s.digest AS subroot, t.digest AS root, sha256(f.proof || a.proof) AS proof_sha256, a.digest AS folded_root, a.digest = t.digest AS verified
FROM leaves l JOIN sources s ON s.name = l.tree JOIN folded_end f ON f.id = l.doc_id JOIN above_end a ON a.id = l.doc_id CROSS JOIN tops_root t""",
    "op12_topk_search": """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
           FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op13_ranked_search": rf"""
WITH docs AS (SELECT doc_id, {_TERMS} AS t FROM documents),
     totals AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, sum(len(t)) AS n_words FROM docs),
     wanted AS (SELECT DISTINCT item_id, unnest(t) AS term FROM (SELECT item_id, {_TERMS} AS t FROM benchmark)),
     held AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM docs),
     tfs AS (SELECT doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL),
     weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
                 FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), totals),
     scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_words)))))::BIGINT AS score
                FROM wanted JOIN tfs USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id),
     placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50""",
}
