"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from opinio.llm import bpe, geometric, importance, lattice, learned_partitions, link_trust, merkle, mixing, shards, simhash, token_files, va_file, wrappers

QUERIES = {
    "op1_va_file_top_k": va_file.op1,
    "op2_learned_partitions": learned_partitions.op2,
    "op3_importance_resampling": importance.op3,
    "op4_fair_queue_mix": mixing.op4,
    "op5_subword_lattice": lattice.op5,
    "op8_word_bpe_round_trip": bpe.op8,
    "op9_link_trust": link_trust.op9,
    "op10_token_files": token_files.op10,
    "op6_host_wrappers": wrappers.op6,
    "op7_simhash_near_duplicates": simhash.op7,
    "op11_geometric_blocks": geometric.op11,
    "op12_hypergeometric_shards": shards.op12,
    "op13_merkle_manifest": merkle.op13,
}

# Operators that SQL can state.
OP1_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0) s) r
WHERE rank <= 5"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP13_SQL = f"""
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY i) AS t
  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i) x),
digests AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf, {_leaf(_LOWERED)} AS lowered,
    xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS crc
  FROM documents, crc_table),
leaves AS (
  SELECT doc_id, lang, leaf, CASE WHEN crc % 3 = 0 THEN lowered ELSE leaf END AS claimed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, row_number() OVER () AS id
  FROM digests),
nodes AS (
  SELECT lang, 0 AS level, p, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, level + 1, p // 8, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 7) // 8 FROM nodes WHERE n > 1 GROUP BY lang, level, p // 8),
tops AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p FROM nodes WHERE n = 1),
over_nodes AS (
  SELECT 0 AS level, p, subroot AS h, count(*) OVER () AS n FROM tops
  UNION ALL
  SELECT level + 1, p // 8, sha256(string_agg(h, '' ORDER BY p)), (any_value(n) + 7) // 8 FROM over_nodes WHERE n > 1 GROUP BY level, p // 8),
up AS (
  SELECT id, lang, 0 AS level, p, claimed AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT u.id, any_value(u.lang), any_value(u.level) + 1, any_value(u.p) // 8, sha256(string_agg(CASE WHEN x.p = u.p THEN u.h ELSE x.h END, '' ORDER BY x.p)),
    any_value(u.proof) || coalesce(string_agg(x.h, '' ORDER BY x.p) FILTER (WHERE x.p <> u.p), '')
  FROM up u JOIN nodes x ON x.lang IS NOT DISTINCT FROM u.lang AND x.level = u.level AND x.p // 8 = u.p // 8 AND x.n > 1 GROUP BY u.id),
at_top AS (
  SELECT u.id, t.p, u.h, u.proof, t.subroot FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY level DESC) AS r FROM up) u JOIN tops t ON t.lang IS NOT DISTINCT FROM u.lang WHERE r = 1),
over_up AS (
  SELECT id, 0 AS level, p, h, proof FROM at_top
  UNION ALL
  SELECT u.id, any_value(u.level) + 1, any_value(u.p) // 8, sha256(string_agg(CASE WHEN x.p = u.p THEN u.h ELSE x.h END, '' ORDER BY x.p)),
    any_value(u.proof) || coalesce(string_agg(x.h, '' ORDER BY x.p) FILTER (WHERE x.p <> u.p), '')
  FROM over_up u JOIN over_nodes x ON x.level = u.level AND x.p // 8 = u.p // 8 AND x.n > 1 GROUP BY u.id)
SELECT doc_id, leaf, subroot, root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM leaves JOIN at_top USING (id) JOIN (SELECT *, row_number() OVER (PARTITION BY id ORDER BY level DESC) AS r FROM over_up) f USING (id),
  (SELECT h AS root FROM over_nodes WHERE n = 1) r
WHERE f.r = 1"""

OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(t) AS term, len(t) AS n, row FROM (
    SELECT doc_id, row_number() OVER () AS row,
      regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents) x),
c AS (SELECT count(DISTINCT row) AS docs, count(*) AS words FROM d),
p AS (SELECT row, term, any_value(doc_id) AS doc_id, any_value(n) AS n, count(*) AS tf FROM d GROUP BY row, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, docs),
q AS (
  SELECT DISTINCT item_id, text, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM benchmark),
s AS (
  SELECT q.item_id, q.text, p.row, any_value(p.doc_id) AS doc_id,
    CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words)))) AS BIGINT) AS score
  FROM (SELECT item_id, text, unnest(t) AS term FROM q) q JOIN p USING (term) JOIN w USING (term), c
  GROUP BY q.item_id, q.text, p.row)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) r
WHERE rank <= 20"""

SQL: dict[str, str] = {"op1_va_file_top_k": OP1_SQL, "op11_geometric_blocks": OP11_SQL, "op13_merkle_manifest": OP13_SQL}
