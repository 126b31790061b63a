"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_BENCH_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP6 = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {_AZ}), {_BENCH_WORD}) AS w
  FROM documents),
post AS MATERIALIZED (
  SELECT r, unnest(w) AS term, unnest(range(len(w))) AS pos FROM d),
b AS MATERIALIZED (
  SELECT row_number() OVER () AS item, item_id, w, least(len(w), 13) AS n FROM (
    SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item_id,
           regexp_extract_all(translate(coalesce(text, ''), {_AZ}), {_BENCH_WORD}) AS w
    FROM benchmark) WHERE len(w) > 0),
win AS MATERIALIZED (
  SELECT item, item_id, n, s, w[s + 1:s + n] AS words
  FROM (SELECT *, unnest(range(len(w) - n + 1)) AS s FROM b)),
widths AS (SELECT DISTINCT n FROM b),
dwin AS (
  SELECT r, n, p, array_to_string(w[p + 1:p + n], ' ') AS k
  FROM (SELECT r, n, w, unnest(range(len(w) - n + 1)) AS p FROM d, widths WHERE len(w) >= n)),
exact AS MATERIALIZED (
  SELECT DISTINCT r, item, item_id, n, p
  FROM dwin JOIN (SELECT *, array_to_string(words, ' ') AS k FROM win) USING (n, k)),
hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM exact) GROUP BY r),
ids AS (SELECT r, count(DISTINCT item_id) AS n_items,
               array_to_string(list_sort(list(DISTINCT item_id)), ',') AS s FROM exact GROUP BY r),
df AS (SELECT term, count(*) AS df FROM post GROUP BY term),
wt AS MATERIALIZED (
  SELECT item, s, term, min(i) AS i FROM (SELECT item, s, unnest(words) AS term, unnest(range(n)) AS i FROM win)
  GROUP BY item, s, term),
rarest AS (
  SELECT item, s, count(*) AS need, arg_min(term, (coalesce(df, 0), i)) AS term
  FROM wt LEFT JOIN df USING (term) GROUP BY item, s),
anchor AS (
  SELECT item, s, need, r, pos FROM rarest JOIN post USING (term)
  WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.r = post.r AND e.item = rarest.item)),
near AS (
  SELECT r, count(DISTINCT item) AS n_near FROM (
    SELECT a.r, a.item FROM anchor a JOIN wt ON wt.item = a.item AND wt.s = a.s
    JOIN post p ON p.r = a.r AND p.term = wt.term AND abs(p.pos - a.pos) <= 25
    GROUP BY a.r, a.item, a.s, a.pos, a.need HAVING count(DISTINCT p.term) = a.need) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated,
       coalesce(n_near, 0)::BIGINT AS n_near
FROM d LEFT JOIN hit USING (r) LEFT JOIN ids USING (r) LEFT JOIN near USING (r)
"""

# The words of a text that is null or blank: none.
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP8 = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
win AS MATERIALIZED (
  SELECT r, p, array_to_string(w[p + 1:p + 35], ' ') AS k
  FROM (SELECT r, w, unnest(range(len(w) - 34)) AS p FROM d WHERE len(w) >= 35)),
twice AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS MATERIALIZED (
  SELECT DISTINCT r, unnest(range(p, p + 35)) AS q FROM win SEMI JOIN twice USING (k)),
lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r),
word AS (SELECT r, unnest(w) AS x, unnest(range(len(w))) AS q FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY q) AS t FROM word ANTI JOIN gone USING (r, q) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""

OP3 = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         {_WORDS.replace("coalesce(text, '')", f"translate(coalesce(text, ''), {_AZ})")} AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[p + 1:p + 4], ' ') AS k FROM (
    SELECT r, w, unnest(range(greatest(len(w) - 3, 1))) AS p FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
link AS MATERIALIZED (
  SELECT x, y FROM (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.r <> b.r GROUP BY a.r, b.r)
  JOIN n p ON p.r = x JOIN n q ON q.r = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
g AS (SELECT x AS r, min(doc_id) AS component_id FROM reach JOIN d ON d.r = reach.y GROUP BY x),
same AS (SELECT list(k ORDER BY k) AS ks, r FROM s GROUP BY r),
copies AS (SELECT r, count(*) OVER (PARTITION BY ks) AS n_same FROM same)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(n_same, 1)::BIGINT AS n_same
FROM d LEFT JOIN n USING (r) LEFT JOIN g USING (r) LEFT JOIN copies USING (r)
"""

OP9 = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.e) = len(c.e)),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM k WHERE rank <= 5
"""

# Costs and places as the contract fixes them: 0 start, 1 after s, 2 after u, 3 after a.
OP11 = r"""
WITH RECURSIVE
tab AS MATERIALIZED (
  SELECT list(list_reduce(range(8)::UBIGINT[], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END,
                          i::UBIGINT) ORDER BY i) AS t FROM range(256) r(i)),
d AS MATERIALIZED (
  SELECT coalesce('=' || conv_id, '') AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
f AS MATERIALIZED (
  SELECT d.*, xor(list_reduce(list_transform(string_split(k, ''), lambda x: ascii(x)::UBIGINT),
                              lambda a, b: xor(t[(xor(a, b) % 256)::BIGINT + 1], a >> 8), 4294967295::UBIGINT), 4294967295::UBIGINT) % 20 AS fate
  FROM d, tab),
g AS (
  SELECT c, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM f),
h AS MATERIALIZED (
  SELECT c, turn, role, text, regexp_replace(text, '[ 	-
]+$', '') AS core, substr(role, 1, 1) AS o,
         row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(role || ':' || text)) AS i FROM g),
r AS MATERIALIZED (
  SELECT *, CASE WHEN core = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(o) OVER (PARTITION BY c ORDER BY i) || o AS pair FROM h),
step(p, o, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins AS (
  SELECT p, p AS q, 0 AS cost, '' AS e FROM range(4) x(p)
  UNION ALL SELECT p, q, 5, 'I' FROM step WHERE o <> 's'
  UNION ALL SELECT a.p, b.q, 10, 'II' FROM step a JOIN step b ON a.q = b.p WHERE a.o <> 's' AND b.o <> 's' AND a.p <> b.q),
best AS (
  SELECT c, 0::BIGINT AS i, ins.q, ins.cost::BIGINT AS cost, ins.e AS audit FROM (SELECT DISTINCT c FROM d), ins WHERE p = 0
  UNION ALL
  SELECT c, i, q, min(cost), arg_min(audit, (cost, audit)) FROM (
    SELECT b.c, r.i, n.q, b.cost + e.cost + n.cost AS cost, b.audit || e.e || n.e AS audit
    FROM best b JOIN r ON r.c = b.c AND r.i = b.i + 1
    JOIN (SELECT p AS p, p AS q, 2 AS cost, 'D' AS e, NULL AS o FROM range(4) x(p)
          UNION ALL SELECT p, q, 0, 'K', o FROM step
          UNION ALL SELECT p, q, 1, 'R', o FROM step WHERE o <> 's') e0
      ON e0.p = b.q AND (e0.e = 'D' OR r.fault NOT IN ('blank', 'duplicate')) AND (e0.e <> 'K' OR e0.o = r.o)
    CROSS JOIN LATERAL (SELECT e0.cost + CASE WHEN e0.e <> 'D' AND r.fault = 'truncated' THEN 5 ELSE 0 END AS cost, e0.e AS e, e0.q AS q) e
    JOIN ins n ON n.p = e.q) GROUP BY c, i, q),
ends AS (SELECT c, max(i) AS i FROM best GROUP BY c),
won AS MATERIALIZED (
  SELECT c, min(cost) AS cost, arg_min(audit, (cost, audit)) AS audit FROM best JOIN ends USING (c, i) WHERE q IN (0, 3) GROUP BY c),
e AS (SELECT c, k, audit[k] AS e, length(replace(audit[:k], 'I', '')) AS i, length(replace(audit[:k], 'D', '')) AS j
      FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS k FROM won)),
sys AS (SELECT c, bool_or(j = 1 AND e.e = 'K' AND r.o = 's') AS s FROM e JOIN r USING (c, i) GROUP BY c),
line AS (
  SELECT c, k, CASE WHEN e.e = 'K' THEN r.role WHEN (j - CASE WHEN s THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
         || ':' || CASE WHEN e.e = 'I' THEN '' ELSE r.text END AS x
  FROM e LEFT JOIN r USING (c, i) LEFT JOIN sys USING (c) WHERE e.e <> 'D'),
fixed AS (SELECT c, string_agg(x, chr(10) ORDER BY k) AS x FROM line GROUP BY c),
n AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, won.cost::BIGINT AS cost, audit,
       sha256(coalesce(x, '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM d) JOIN won USING (c) LEFT JOIN n USING (c) LEFT JOIN fixed USING (c)
"""

OP12 = """
WITH RECURSIVE v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e,
         embedding IS NOT NULL AND len(embedding) > 0
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS fit FROM embeddings),
link AS MATERIALIZED (
  SELECT a.r AS x, b.r AS y FROM v a JOIN v b ON a.fit AND b.fit AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
n AS (SELECT x AS r, count(*) AS n FROM link GROUP BY x),
reach AS (SELECT r AS x, r AS y FROM v UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y),
g AS (SELECT x AS r, min(vec_id) AS component_id FROM reach JOIN v ON v.r = reach.y GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v LEFT JOIN n USING (r) LEFT JOIN g USING (r)
"""

ORACLE_SQL = {"op12_embedding_dedup": OP12, "op11_conversation_repair": OP11, "op9_vp_tree_neighbours": OP9, "op3_ngram_jaccard_join": OP3, "op8_substring_dedup": OP8, "op6_benchmark_decontamination": OP6}
