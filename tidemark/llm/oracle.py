"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.queries import URL_RULES
from tidemark.llm.sharding import BASE_SHARDS, SLOT_ROWS, Leaf, plain_tree

ORACLE: dict[str, str] = {}

ORACLE["op4_uniform_threshold_topk"] = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""


def _least(level: str, children: dict[int, float]) -> str:
    """The child of the smallest draw, as in the operator."""
    draws = [
        f"struct_pack(draw := -ln((CAST('0x' || substr(md5('{level}/{name}/' || k), 1, 13) AS BIGINT) + 1) / {float(2**52 + 1)!r}) / {weight!r}, name := {name})"
        for name, weight in sorted(children.items())
    ]
    return f"least({', '.join(draws)}).name" if len(draws) > 1 else str(next(iter(children)))


def _descended(tree: list[Leaf]) -> str:
    """SQL for the leaf of key k."""
    regions = sorted({r for r, _, _, _ in tree})
    weight = {r: sum(w for a, _, _, w in tree if a == r) for r in regions}
    by_region = []
    for r in regions:
        racks = sorted({k for a, k, _, _ in tree if a == r})
        rack_weight = {k: sum(w for a, b, _, w in tree if (a, b) == (r, k)) for k in racks}
        by_rack = " ".join(
            f"WHEN {k} THEN {_least(f'shard/{r}/{k}', {s: w for a, b, s, w in tree if (a, b) == (r, k)})}" for k in racks
        )
        by_region.append(f"WHEN {r} THEN CASE {_least(f'rack/{r}', rack_weight)} {by_rack} END")
    return f"CASE {_least('region', weight)} {' '.join(by_region)} END"


ORACLE["op6_hash_tree_shards"] = f"""
WITH RECURSIVE bits AS (
  SELECT i AS n, i AS v, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT n, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(v ORDER BY n) AS t FROM bits WHERE k = 8
), b AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, hex(encode(coalesce(text, ''))) AS h FROM documents
), placed AS (
  SELECT doc_id, CAST(length(h) // 2 + 1 AS BIGINT) AS size,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(0, length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
           lambda a, x: xor(crc.t[xor(a, x) % 256 + 1], a >> 8))) AS text_crc32,
         CAST({_descended(plain_tree(BASE_SHARDS))} AS INTEGER) AS shard,
         CAST({_descended(plain_tree(BASE_SHARDS + 1))} AS INTEGER) AS grown_shard,
         CAST('0x' || substr(md5(concat_ws('/', k, size, text_crc32, grown_shard)), 20, 13) AS BIGINT)
           % ((SELECT count(*) FROM documents) // {SLOT_ROWS} + 1) AS bucket
  FROM b, crc
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, size, text_crc32, grown_shard) - 1 AS slot
FROM placed
"""

_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

ORACLE["op8_digest_array_urls"] = f"""
WITH rules(h, p, v) AS (VALUES {_RULES}), u AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), fit AS (
  SELECT u.*, h || p AS rule, v, row_number() OVER (PARTITION BY u.page_id ORDER BY length(h || p) DESC NULLS LAST) AS n
  FROM u LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM fit WHERE n = 1
"""

ORACLE["op9_difference_cover_dedup"] = """
WITH b AS (SELECT doc_id, encode(coalesce(text, '')) AS t FROM documents),
w AS (SELECT doc_id, i, t[i + 1 : i + 50] AS s FROM (SELECT doc_id, t, unnest(range(octet_length(t) - 49)) AS i FROM b WHERE octet_length(t) >= 50)),
least AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
hit AS (SELECT doc_id, i FROM w JOIN least USING (s) WHERE doc_id > first),
island AS (
  SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS n
  FROM (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM hit)
),
gone AS (SELECT doc_id, n, min(i) AS a, max(i) + 50 AS z FROM island GROUP BY doc_id, n),
cuts AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM gone
  UNION ALL SELECT b.doc_id, coalesce(max(z), 0), octet_length(any_value(t)) FROM b LEFT JOIN gone USING (doc_id) GROUP BY b.doc_id
),
kept AS (SELECT doc_id, string_agg(CASE WHEN a < z THEN hex(t[a + 1 : z]) ELSE '' END, '' ORDER BY a, z) AS h FROM cuts JOIN b USING (doc_id) GROUP BY doc_id)
SELECT b.doc_id, octet_length(t) AS n_bytes, coalesce(sum(z - a), 0)::BIGINT AS n_removed, count(n) AS n_spans,
       sha256(unhex(any_value(h))) AS kept_sha256
FROM b LEFT JOIN gone USING (doc_id) JOIN kept USING (doc_id) GROUP BY b.doc_id, octet_length(t)
"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLE["op12_k2_treap_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
held AS (SELECT r, doc_id, terms, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
facts AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM held),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM held) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, facts GROUP BY term, docs),
asked AS (
  SELECT DISTINCT i, item_id, term FROM (
    SELECT i, item_id, unnest({_TERMS}) AS term FROM (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))
  )
),
scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // l)))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term), facts GROUP BY i, item_id, r, doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS n FROM scored WHERE score > 0)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM ranked WHERE n <= 10
"""

ORACLE["op13_subspace_pigeonhole"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(c AS DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9),
reach AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM least LEFT JOIN counts USING (vec_id)
"""
