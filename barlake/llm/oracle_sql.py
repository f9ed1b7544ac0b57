"""DuckDB SQL of the queries that SQL can express, in its own forms: no Bloom filter, no
index, no buckets.  The others are tested against brute force in ``tests/llm``."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# ------------------------------------------------------------------ secrets
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?"""
_VALUE = "[A-Za-z0-9+/_.=-]+"


def _spans(kind: str, number: int, pattern: str, value: str, least: int) -> str:
    """start, end and value of each match: gaps and matches alternate along the text."""
    gap = "coalesce(list_sum(list_transform(gaps[:i], lambda x: length(x))), 0)"
    return f"""SELECT rid, '{kind}' AS kind, {number} AS k, v,
           CAST({gap} + coalesce(list_sum(list_transform(found[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
           CAST({gap} + coalesce(list_sum(list_transform(found[:i], lambda x: length(x))), 0) AS BIGINT) AS e
    FROM (SELECT rid, gaps, found, unnest(range(1, len(found) + 1)) AS i, unnest({value}) AS v
          FROM (SELECT rid, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS found
                FROM d WHERE regexp_matches(text, '{pattern}')))
    WHERE length(v) >= {least}"""


_ASSIGN_VALUE = f"list_transform(found, lambda x: regexp_replace(x, '^{_ASSIGN}', ''))"

OP1 = rf"""WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, chr(1)) AS owner,
         coalesce(source, '') || '/' || coalesce(lang, '') AS repo FROM documents),
base AS MATERIALIZED (
  {_spans("assign", 0, _ASSIGN + _VALUE, _ASSIGN_VALUE, 8)}
  UNION ALL {_spans("access", 1, "AKIA[A-Z0-9]+", "found", 16)}
  UNION ALL {_spans("hex", 2, "[0-9a-f]+", "found", 32)}),
opaque AS (
  SELECT rid, 'opaque' AS kind, 3 AS k, w AS v, s, s + length(w) AS e
  FROM (SELECT rid, s, regexp_extract(v, '^[A-Za-z0-9+/_-]{{20,}}=?=?') AS w
        FROM ({_spans("run", 3, "[A-Za-z0-9+/_=-]+", "found", 20)}))
  WHERE length(w) >= 20 AND regexp_matches(w, '[0-9]') AND regexp_matches(w, '[a-z]') AND regexp_matches(w, '[A-Z]')
    AND len(list_distinct(string_split(w, ''))) >= 10),
found AS MATERIALIZED (
  SELECT rid, kind, k, v, s, e FROM base
  UNION ALL SELECT o.rid, o.kind, o.k, o.v, o.s, o.e FROM opaque o
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = o.rid AND b.s < o.e AND o.s < b.e)),
known AS (
  SELECT f.v, count(DISTINCT d.owner) AS owners
  FROM found f JOIN d USING (rid) GROUP BY f.v),
judged AS (
  SELECT f.*, owners = 1 AS live, owners >= 2 AS copied FROM found f JOIN known USING (v)),
per AS (
  SELECT rid, count(*) FILTER (WHERE k = 0) AS a, count(*) FILTER (WHERE k = 1) AS b, count(*) FILTER (WHERE k = 2) AS c,
         string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, k) FILTER (WHERE k < 3) AS plain,
         string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, k) FILTER (WHERE k < 3 OR live) AS whole,
         count(*) FILTER (WHERE live) AS live, count(*) FILTER (WHERE copied) AS copied,
         count(*) FILTER (WHERE k = 3 AND live) AS o
  FROM judged GROUP BY rid)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
       sha256(coalesce(plain, '')) AS base_sha256, coalesce(whole, '') AS spans,
       coalesce(live, 0) AS n_live, coalesce(copied, 0) AS n_copied, coalesce(o, 0) AS n_opaque
FROM d LEFT JOIN per USING (rid)"""

# -------------------------------------------------------------- URL filters
OP3 = rf"""WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, {_LOWER.format("regexp_extract(r, '^([^/?#]*)', 1)")} AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
named AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '')
            || regexp_replace(regexp_replace(path, '\.html\z', ''), '/+\z', '') END AS name FROM parts),
listed AS (SELECT DISTINCT name FROM named WHERE regexp_matches(host, '(^|\.)(casino-win|free-bets)\.')),
ruled AS (
  SELECT *, CASE WHEN '.' || host LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
                 WHEN '.' || host LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
                 WHEN '.' || host LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
                 WHEN '.' || host LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/'
                 WHEN '.' || host LIKE '%.org' AND path LIKE '/%' THEN 'org/' END AS rule,
         coalesce(name IN (SELECT name FROM listed), false) AS listed
  FROM named)
SELECT page_id, host, path, rule, listed,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled"""

# -------------------------------------------------------------------- scores
_SPACED = r"[^\x20\x09-\x0D]+"
OP7 = rf"""WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_SPACED}') AS w FROM documents),
p AS MATERIALIZED (
  SELECT rid, i, w[i] AS w1, CASE WHEN i > 1 THEN w[i - 1:i] END AS w2, CASE WHEN i > 2 THEN w[i - 2:i] END AS w3
  FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
c1 AS MATERIALIZED (SELECT w1, count(*) AS n FROM p GROUP BY w1),
c2 AS MATERIALIZED (SELECT w2, count(*) AS n FROM p WHERE w2 IS NOT NULL GROUP BY w2),
c3 AS MATERIALIZED (SELECT w3, count(*) AS n FROM p WHERE w3 IS NOT NULL GROUP BY w3),
per AS (
  SELECT p.rid, p.i, CASE WHEN c3.n >= 2 THEN 3 WHEN c2.n >= 2 THEN 2 ELSE 1 END AS took,
         CASE WHEN c3.n >= 2 THEN ln(c3.n / before2.n)
              ELSE CASE WHEN p.i > 2 THEN ln(0.4) ELSE 0 END
                 + CASE WHEN c2.n >= 2 THEN ln(c2.n / before1.n)
                        ELSE CASE WHEN p.i > 1 THEN ln(0.4) ELSE 0 END + ln(c1.n / (SELECT sum(n) FROM c1)) END END AS s
  FROM p JOIN c1 ON c1.w1 = p.w1
  LEFT JOIN c2 ON c2.w2 = p.w2 LEFT JOIN c3 ON c3.w3 = p.w3
  LEFT JOIN c1 before1 ON before1.w1 = p.w2[1] LEFT JOIN c2 before2 ON before2.w2 = p.w3[1:2]),
tot AS (
  SELECT rid, count(*) FILTER (WHERE took = 3) AS m, count(*) FILTER (WHERE took = 1) AS u, sum(s) AS s FROM per GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(m, 0) AS n_matched, coalesce(u, 0) AS n_unigrams,
       round(coalesce(s, 0), 6) AS log_score, round(coalesce(s, 0) / greatest(len(w), 1), 6) AS mean_score
FROM d LEFT JOIN tot USING (rid)"""

# ------------------------------------------------------------ decontamination
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP8 = rf"""WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark),
q AS MATERIALIZED (
  SELECT DISTINCT item, w[i:i + 9] AS win FROM (
    SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
pos AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d),
sizes AS (SELECT DISTINCT len(win) AS n FROM q),
hit AS MATERIALIZED (
  SELECT x.rid, x.i, x.n, q.item
  FROM (SELECT rid, i, n, w[i:i + n - 1] AS win FROM pos, sizes WHERE i + n - 1 <= len(w)) x JOIN q USING (win)),
words AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM hit) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS l FROM hit GROUP BY rid),
often AS MATERIALIZED (SELECT w[i] AS term, count(*) AS n FROM pos GROUP BY term),
-- every start within 3 words of a place of the window's least frequent word, with its first word there
seed AS (
  SELECT win, any_value(item) AS one, min_by(j, struct_pack(n := coalesce(n, 0), j := j)) AS j
  FROM (SELECT DISTINCT win, item, unnest(range(0, len(win))) AS j FROM q) x LEFT JOIN often ON term = win[j + 1] GROUP BY win),
begun AS (
  SELECT DISTINCT rid, w, win, i - j + unnest(range(-3, 4)) AS s FROM pos JOIN seed ON w[i] = win[j + 1]),
close AS (
  SELECT DISTINCT rid, win FROM begun
  WHERE s >= 1 AND w[s] = win[1] AND len(list_filter(range(0, len(win)), lambda j: s + j + 3 >= 1
            AND list_contains(w[greatest(s + j - 3, 1):s + j + 3], win[j + 1]))) = len(win)),
near AS (SELECT rid, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS l FROM close JOIN q USING (win) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.l, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated,
       coalesce(near.n, 0) AS n_near, sha256(coalesce(near.l, '')) AS near_sha256
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid) LEFT JOIN near USING (rid)"""

ORACLE_SQL = {
    "op1_secrets": OP1,
    "op3_url_filters": OP3,
    "op7_lm_scores": OP7,
    "op8_decontamination": OP8,
    "op8_near_matches": OP8,
}

_FINITE = "len(list_filter({v}, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _round(n: int) -> str:
    """Assignments to the centroids of round ``n``."""
    return f"""
near{n} AS (
    SELECT k.n, k.vec_id, k.v, min(struct_pack(
               d := list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT,
               c := c.cluster)) AS best
    FROM kept k CROSS JOIN c{n} c GROUP BY ALL)"""


def _centroids(n: int) -> str:
    return f"""
parts{n} AS (SELECT best.c AS cluster, unnest(v) AS x, unnest(range(64)) AS dim FROM near{n}),
means{n} AS (SELECT cluster, dim, (sum(x) - (((sum(x) % count(*)) + count(*)) % count(*))) // count(*) AS mean
             FROM parts{n} GROUP BY cluster, dim),
c{n + 1} AS (
    SELECT c.cluster, coalesce(m.v, c.v) AS v
    FROM c{n} c LEFT JOIN (SELECT cluster, list(mean::BIGINT ORDER BY dim) AS v FROM means{n} GROUP BY cluster) m
    USING (cluster))"""


ORACLE_SQL["op11_centroid_clustering"] = f"""
WITH kept AS (
    SELECT row_number() OVER () AS n, vec_id,
           list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = 64 AND {_FINITE.format(v="embedding")}),
c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, v)::INTEGER - 1 AS cluster, v
    FROM kept QUALIFY cluster < 16),
{",".join(_round(n) + "," + _centroids(n) for n in range(3))},
{_round(3)}
SELECT vec_id, best.c AS cluster, best.d AS distance,
       (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM near3 JOIN c3 ON c3.cluster = best.c
"""

ORACLE_SQL["op12_hard_negatives"] = f"""
WITH kept AS (
    SELECT row_number() OVER () AS n, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {_FINITE.format(v="embedding")}),
scored AS (
    SELECT a.n AS anchor, a.vec_id AS anchor_id, b.n AS other, b.vec_id, a.label = b.label AS same,
           coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
    FROM kept a JOIN kept b ON a.vec_id % 50 = 0 AND a.n <> b.n),
positives AS (
    SELECT anchor, anchor_id, other AS positive, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, other) <= 5)
SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id, s.other)::INTEGER AS rank
FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
     AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
