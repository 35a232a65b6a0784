"""DuckDB statements for the queries of this package that SQL can express."""

from __future__ import annotations

#: Smallest id that each id reaches over ``links`` (a, b in both directions).
_REACH = """reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)"""

_NGRAM_JOIN = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common c JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE c.n * 5 >= 4 * (p.n + q.n - c.n)),
{_REACH}
SELECT d.doc_id, (SELECT count(*) FROM links WHERE a = d.doc_id) AS n_links,
  least(d.doc_id, coalesce((SELECT min(b) FROM reach WHERE a = d.doc_id), d.doc_id)) AS component_id
FROM documents d"""

_EMBEDDINGS = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
lengths AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM vectors WHERE list_dot_product(e, e) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM lengths x JOIN lengths y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.98),
{_REACH},
result AS (
  SELECT v.vec_id, (SELECT count(*) FROM links WHERE a = v.vec_id) AS n_links,
    least(v.vec_id, coalesce((SELECT min(b) FROM reach WHERE a = v.vec_id), v.vec_id)) AS component_id FROM embeddings v)
SELECT *, vec_id = component_id AS kept FROM result"""

_WARC = """
WITH payloads AS (SELECT page_id, url, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
ranked AS (
  SELECT *, first_value(page_id) OVER w AS first, n >= 100 AND row_number() OVER w > 1 AS again FROM payloads
  WINDOW w AS (PARTITION BY d ORDER BY page_id NULLS LAST, url NULLS LAST))
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN first END AS refers_to FROM ranked"""

_NEGATIVES = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""

_MERKLE = """
WITH RECURSIVE raw AS (
  SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') AS i, coalesce(strlen(source) || ':' || source, '-') AS s,
    coalesce(strlen(lang) || ':' || lang, '-') AS l, n_chars, coalesce(strlen(text) || ':' || text, '-') AS t, crc32_of.tampered
  FROM documents d LEFT JOIN (SELECT doc_id AS tampered_id, true AS tampered FROM (
    SELECT doc_id, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
      lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
        lambda v, z: xor(v >> 1, (v & 1) * 3988292384::UBIGINT))) AS crc FROM documents)
    WHERE xor(crc, 4294967295::UBIGINT) % 7 = 0) crc32_of ON d.doc_id = crc32_of.tampered_id),
leaves AS (
  SELECT doc_id, lang, sha256(i || s || l || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') || t) AS leaf,
    CASE WHEN tampered THEN sha256(i || s || l || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1)::VARCHAR, '-') || t) END AS present FROM raw),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaves),
nodes(lv, lang, p, d, n) AS (
  SELECT 0, lang, p, leaf, count(*) OVER (PARTITION BY lang) FROM placed
  UNION ALL
  SELECT lv + 1, lang, p // 2, h, (n + 1) // 2 FROM (
    SELECT lv, lang, p, n, sha256(d || coalesce(lead(d) OVER (PARTITION BY lang ORDER BY p), '')) AS h FROM nodes WHERE n > 1) WHERE p % 2 = 0),
subroots AS (SELECT lang, d AS subroot, lv AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p FROM nodes WHERE n = 1),
crown(lv, p, d, n) AS (
  SELECT 0, p, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT lv + 1, p // 2, h, (n + 1) // 2 FROM (
    SELECT lv, p, n, sha256(d || coalesce(lead(d) OVER (ORDER BY p), '')) AS h FROM crown WHERE n > 1) WHERE p % 2 = 0),
steps AS (
  SELECT r.doc_id, r.leaf, x.lv, (r.p >> x.lv) % 2 AS side, o.d AS other
  FROM placed r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang JOIN nodes x ON x.lang IS NOT DISTINCT FROM r.lang AND x.p = r.p >> x.lv AND x.lv < s.height
    LEFT JOIN nodes o ON o.lang IS NOT DISTINCT FROM r.lang AND o.lv = x.lv AND o.p = xor(r.p >> x.lv, 1)
  UNION ALL
  SELECT r.doc_id, r.leaf, s.height + x.lv, (s.p >> x.lv) % 2, o.d
  FROM placed r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang JOIN crown x ON x.p = s.p >> x.lv AND x.n > 1
    LEFT JOIN crown o ON o.lv = x.lv AND o.p = xor(s.p >> x.lv, 1)),
paths AS (
  SELECT doc_id, leaf, list({'side': side, 'other': other} ORDER BY lv) AS path, sha256(coalesce(string_agg(other, '' ORDER BY lv), '')) AS proof_sha256
  FROM steps GROUP BY doc_id, leaf),
folds(doc_id, leaf, k, d) AS (
  SELECT doc_id, leaf, 0, coalesce(present, leaf) FROM placed
  UNION ALL
  SELECT f.doc_id, f.leaf, k + 1, sha256(CASE WHEN path[k + 1].side = 1 THEN path[k + 1].other || d ELSE d || coalesce(path[k + 1].other, '') END)
  FROM folds f JOIN paths USING (doc_id, leaf) WHERE k < len(path)),
folded AS (SELECT doc_id, leaf, arg_max(d, k) AS folded_root FROM folds GROUP BY doc_id, leaf)
SELECT r.doc_id, r.leaf, s.subroot, c.d AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = c.d AS verified
FROM placed r JOIN subroots s ON r.lang IS NOT DISTINCT FROM s.lang JOIN (SELECT d FROM crown WHERE n = 1) c ON true
  LEFT JOIN paths q ON q.doc_id = r.doc_id AND q.leaf = r.leaf JOIN folded f ON f.doc_id = r.doc_id AND f.leaf = r.leaf"""

_ORACLES = {"op5_ngram_join": _NGRAM_JOIN, "op10_embedding_near_duplicates": _EMBEDDINGS, "op11_warc": _WARC, "op12_hard_negatives": _NEGATIVES, "op13_merkle_manifest": _MERKLE}


def llm_oracles() -> dict[str, str]:
    return dict(_ORACLES)
