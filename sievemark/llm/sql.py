"""DuckDB SQL for those corpus queries that SQL can express."""

from __future__ import annotations

from . import secrets, url_filter

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def url_rules() -> str:
    rules = ", ".join(f"({_text(h + p)}, {_text(h)}, {_text(p)}, {_text(v)})" for v, h, p in url_filter.RULES)
    return f"""
WITH rules(rule, h, p, v) AS (VALUES {rules}),
cut AS (SELECT page_id, coalesce(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END, '') AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fit AS (SELECT page_id, max({{'n': length(rule), 'rule': rule, 'v': v}}) AS best FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM parts LEFT JOIN fit USING (page_id)
"""


def secret_spans() -> str:
    def spans(rank: int, r: secrets.Rule) -> str:
        p = _text(r.pattern)
        return f"""SELECT doc_id, {rank} AS rank, {_text(r.kind)} AS kind, unnest(list_filter(list_transform(range(1, len(m) + 1), lambda i: {{
  'a': (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0))::BIGINT,
  'n': length(m[i]), 'k': length(k[i])}}), lambda x: x.k >= {r.least})) AS s
FROM (SELECT doc_id, regexp_extract_all(t, {p}) AS m, regexp_extract_all(t, {p}, {r.group}) AS k, regexp_split_to_array(t, {p}) AS g FROM texts WHERE regexp_matches(t, {p}))"""

    every = " UNION ALL ".join(spans(i, r) for i, r in enumerate(secrets.RULES))
    base = [r.kind for r in secrets.BASE]
    names = ", ".join(map(_text, base))
    counts = ", ".join(f"count(kind) FILTER (kind = {_text(k)}) AS n_{k}" for k in base)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({every}),
shown AS (SELECT doc_id, kind, rank, s.a AS a, kind || ':' || s.a || ':' || (s.a + s.n) AS x FROM spans)
SELECT doc_id, {counts}, sha256(coalesce(string_agg(x, ',' ORDER BY a, rank) FILTER (kind IN ({names})), '')) AS base_sha256, coalesce(string_agg(x, ',' ORDER BY a, rank), '') AS spans
FROM texts LEFT JOIN shown USING (doc_id) GROUP BY doc_id
"""


def near_documents(width: int = 2, similar: int = 80) -> str:
    shingle = " || ' ' || ".join(f"w[i + {j}]" for j in range(width))
    return f"""
WITH RECURSIVE words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= {width} THEN list_distinct(list_transform(range(1, len(w) - {width} + 2), lambda i: {shingle})) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
sizes AS (SELECT doc_id, len(s)::BIGINT AS n FROM sets),
items AS MATERIALIZED (SELECT doc_id, unnest(s) AS x FROM sets),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes m ON m.doc_id = a JOIN sizes o ON o.doc_id = b WHERE 100 * c >= {similar} * (m.n + o.n - c)),
ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, root) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT ways.b, reach.root FROM reach JOIN ways ON ways.a = reach.node),
least AS (SELECT node AS doc_id, min(root) AS component_id FROM reach GROUP BY 1)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN least USING (doc_id)
"""


def near_vectors(cosine: float = 0.95) -> str:
    return f"""
WITH RECURSIVE doubles AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
valid AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM doubles
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(e, lambda x: x * x)) > 0),
ways AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {cosine}),
reach(node, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT ways.b, reach.root FROM reach JOIN ways ON ways.a = reach.node),
least AS (SELECT node AS vec_id, min(root) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a AS vec_id, count(*) AS n FROM ways GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM least LEFT JOIN counts USING (vec_id)
"""
