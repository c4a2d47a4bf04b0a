"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from sparkinfer.llm import secrets
from sparkinfer.llm.queries import SHARDS, URL_RULES

_STEP = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
_TABLE = "range(256)"
for _ in range(8):  # the published table of crc32, one bit at a time
    _TABLE = f"list_transform({_TABLE}, lambda c: {_STEP.format('c')})"
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(strlen(t)),
            lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
          lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295::BIGINT)"""

# The jump hash with 128-bit arithmetic; a walk up to SHARDS + 1 gives both shard numbers.
OP1 = f"""
WITH RECURSIVE jump(doc_id, key, here, target) AS (
  SELECT DISTINCT doc_id,
         CASE WHEN coalesce(doc_id, 0) < 0 THEN coalesce(doc_id, 0)::HUGEINT + 18446744073709551616
              ELSE coalesce(doc_id, 0)::HUGEINT END, -1::BIGINT, 0::BIGINT FROM documents
  UNION ALL
  SELECT doc_id, (key * 2862933555777941757 + 1) % 18446744073709551616, target,
         floor((target + 1)::DOUBLE * (2147483648.0::DOUBLE /
           (((key * 2862933555777941757 + 1) % 18446744073709551616 // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM jump WHERE target < {SHARDS + 1}),
placed AS (SELECT doc_id, max(here) FILTER (here < {SHARDS}) AS shard, max(here) AS grown_shard FROM jump
           WHERE here >= 0 GROUP BY doc_id),
crcs AS (SELECT t, {_CRC} AS crc
         FROM (SELECT DISTINCT coalesce(text, '') AS t, hex(coalesce(text, '')) AS h, {_TABLE} AS tab FROM documents))
SELECT d.doc_id, coalesce(strlen(d.text), 0)::BIGINT + 16 AS size, c.crc AS text_crc32, 'key' AS law,
       p.shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY p.shard ORDER BY d.doc_id) - 1 AS slot, p.grown_shard::INTEGER AS grown_shard
FROM documents d JOIN placed p ON d.doc_id IS NOT DISTINCT FROM p.doc_id
JOIN crcs c ON c.t = coalesce(d.text, '')
"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
OP4 = rf"""
WITH rules(verdict, host, path) AS (VALUES {_RULES}),
parts AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') ELSE '' END
           AS raw,
         CASE WHEN contains(url, '://')
              THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
         row_number() OVER () AS n FROM pages),
hosts AS (SELECT *, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM parts)
SELECT any_value(h.page_id) AS page_id, any_value(h.host) AS host, any_value(h.path) AS path,
       max_by(r.host || r.path, length(r.host || r.path)) AS rule,
       coalesce(max_by(r.verdict, length(r.host || r.path)), 'allow') AS verdict
FROM hosts h LEFT JOIN rules r
  ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)
GROUP BY h.n
"""

# Windows as hexadecimal text, compared by their md5; runs of windows merge into spans.
OP3 = """
WITH b AS (SELECT doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n FROM documents),
win AS (SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 400)) AS s
        FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM b WHERE n >= 200)),
hit AS (SELECT doc_id, i FROM win WHERE s IN (SELECT s FROM win GROUP BY s HAVING count(*) > 1)),
marked AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200 THEN 0 ELSE 1 END AS first FROM hit),
grouped AS (SELECT *, sum(first) OVER (PARTITION BY doc_id ORDER BY i) AS grp FROM marked),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS b FROM grouped GROUP BY doc_id, grp),
ahead AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_ FROM spans),
cut AS (SELECT s.doc_id, sum(s.b - s.a) AS removed, count(*) AS spans, max(s.b) AS last,
        string_agg(substr(d.h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS kept
        FROM ahead s JOIN b d USING (doc_id) GROUP BY s.doc_id)
SELECT b.doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN removed IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM b LEFT JOIN cut USING (doc_id)
"""

def _near(k: int, percent: int, kept: bool) -> str:
    """Every pair of documents that share a shingle, then the smallest id along links."""
    shingle = " || ' ' || ".join(f"ws[i + {j}]" if j else "ws[i]" for j in range(k))
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) < {k} THEN CASE WHEN len(ws) = 0 THEN [] ELSE [array_to_string(ws, ' ')] END
             ELSE list_distinct(list_transform(range(1, len(ws) - {k - 2}), lambda i: {shingle})) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS x FROM s),
link AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
         GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
both_ AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(d, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.d, both_.b FROM reach JOIN both_ ON reach.r = both_.a)
SELECT s.doc_id, len(sh)::BIGINT AS n_shingles, c.component_id{", s.doc_id = c.component_id AS kept" if kept else ""}
FROM s JOIN (SELECT d, min(r) AS component_id FROM reach GROUP BY d) c ON s.doc_id = c.d
"""


OP9 = _near(2, 80, True)
OP11 = _near(3, 90, False)

OP10 = """
WITH g AS (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(g.t) AS text_sha256
FROM documents d JOIN g ON coalesce(d.text, '') = g.t
"""


# Prefixes as lists of (role, text); subtree sums by spreading every node over its ancestors.
OP13 = f"""
WITH RECURSIVE turns AS (
  SELECT conv_id AS c, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS said, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(said ORDER BY i) AS s FROM turns GROUP BY c),
hashed AS (SELECT c, s, {_CRC} % 6 AS h FROM (SELECT c, s, c::VARCHAR AS t, hex(c::VARCHAR) AS h, {_TABLE} AS tab FROM own)),
built AS (SELECT a.c, list_concat(coalesce(b.s, [])[1:a.h], a.s[a.h + 1:]) AS s FROM hashed a LEFT JOIN own b ON b.c = a.c - a.c % 100),
prefix AS (SELECT c, d, s[1:d] AS p, d = len(s) AS ends FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM built)),
node AS (SELECT p, d, min(c) AS conv_id, count(*) AS n, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends) AS ids
         FROM prefix GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS k FROM node WHERE d > 0 GROUP BY 1),
full_ AS (SELECT node.*, coalesce(k, 0) AS k, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * length(p[d].t) END AS w
          FROM node LEFT JOIN kids USING (p)),
up AS (SELECT p[1:a] AS p, sum((k = 0)::INT) AS leaves, sum(w) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_) GROUP BY 1)
SELECT f.conv_id, f.d::BIGINT AS depth, q.conv_id AS parent_conv_id, f.n AS n_convs, f.k AS n_children,
       up.leaves::BIGINT AS n_leaves, up.saved::BIGINT AS saved_tokens, sha256(coalesce(f.ids, '')) AS ends_sha256
FROM full_ f JOIN up ON up.p = f.p LEFT JOIN full_ q ON f.d > 0 AND q.p = f.p[1:f.d - 1]
"""


def _op6() -> str:
    """Spans from the matches and the gaps between them, by DuckDB's own expressions."""
    parts = []
    for order, rule in enumerate(secrets.BASE_RULES + secrets.MORE_RULES):
        # RE2 has no lookbehind; a greedy run needs none
        pattern = rule.pattern.replace("(?<![0-9a-f])", "").replace("'", "''")
        keep = f"regexp_matches(hit, '{rule.holds.replace(chr(39), chr(39) * 2)}')" if rule.holds else "true"
        parts.append(f"""
  SELECT n, '{rule.kind}' AS kind, {order} AS ord, hits[i] AS hit,
         list_sum([length(x) for x in gaps[1:i]]) + coalesce(list_sum([length(x) for x in hits[1:i - 1]]), 0) AS start
  FROM (SELECT n, gaps, hits, unnest(range(1, len(hits) + 1)) AS i FROM (
          SELECT n, regexp_extract_all(t, '{pattern}') AS hits, string_split_regex(t, '{pattern}') AS gaps FROM docs))
  WHERE {keep}""")
    base = len(secrets.BASE_RULES)
    label = "kind || ':' || start::BIGINT || ':' || (start + length(hit))::BIGINT"
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE_RULES)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(parts)})
SELECT any_value(d.doc_id) AS doc_id, {counts},
       sha256(coalesce(string_agg({label}, ',' ORDER BY start, ord) FILTER (ord < {base}), '')) AS base_sha256,
       coalesce(string_agg({label}, ',' ORDER BY start, ord) FILTER (kind IS NOT NULL), '') AS spans
FROM docs d LEFT JOIN spans s USING (n) GROUP BY n
"""


def build() -> dict[str, str]:
    return {"op1_jump_shards": OP1, "op3_interval_expansion": OP3, "op9_super_minhash": OP9, "op4_url_rules": OP4, "op6_secret_spans": _op6(), "op10_exact_dedup": OP10,
            "op11_token_combinations": OP11, "op13_prefix_trie": OP13}
