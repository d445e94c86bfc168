"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS w FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS rn FROM sources),
levels AS (  -- with the first k sources at their limits
  SELECT k.k, (SELECT sum(source_size) FROM sources) AS total,
         coalesce((SELECT sum(3.0 * source_size) FROM ranked WHERE rn <= k.k), 0) AS fixed,
         (SELECT sum(w) FROM ranked WHERE rn > k.k) AS weight
  FROM (SELECT 0 AS k UNION ALL SELECT rn FROM ranked) k),
level AS (
  SELECT CAST(total - fixed AS DOUBLE) / weight AS level FROM levels
  WHERE weight > 0 AND CAST(total - fixed AS DOUBLE) / weight * (SELECT w FROM ranked WHERE rn = k + 1)
        <= 3.0 * (SELECT source_size FROM ranked WHERE rn = k + 1)
  ORDER BY k LIMIT 1),
targets AS (
  SELECT source, source_size, least(w * coalesce((SELECT level FROM level), 0), 3.0 * source_size)::DOUBLE AS target FROM sources),
rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0 END AS rate,
         CAST(('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '~') || ':' || coalesce(md5(text), '~')), 1, 13)) AS BIGINT)
           / 4503599627370496.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"
OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS words FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS words FROM benchmark),
w AS (SELECT DISTINCT item_id, least(10, len(words)) AS n,
             array_to_string(words[s:s + least(10, len(words)) - 1], ' ') AS win
      FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS s FROM i WHERE len(words) > 0)),
lens AS (SELECT DISTINCT n FROM w),
dw AS (SELECT rid, n, s, array_to_string(words[s:s + n - 1], ' ') AS win
       FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS s FROM d, lens WHERE len(words) >= n)),
hit AS (SELECT DISTINCT rid, dw.n, s, item_id FROM dw JOIN w ON w.win = dw.win AND w.n = dw.n),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT rid, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""

OP12 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
usable AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len([c for c in e if c IS NULL OR NOT isfinite(c)]) = 0
    AND len([c for c in e if c <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
least_id AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, least(vec_id, coalesce(least_id.b, vec_id)) AS component_id,
       vec_id <= coalesce(least_id.b, vec_id) AS kept
FROM v LEFT JOIN counted ON counted.a = vec_id LEFT JOIN least_id ON least_id.a = vec_id
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
marked AS (
  SELECT part, (CASE WHEN len(words) < 50 THEN 1 ELSE 0 END)
      + (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END)
      + (CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) THEN 4 ELSE 0 END)
      + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
      + (CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 16 ELSE 0 END) AS mask,
    coalesce((SELECT bool_or(quality = 1) FROM labels l WHERE l.doc_id = d.doc_id), false) AS good,
    coalesce((SELECT bool_or(toxic = 1) FROM labels l WHERE l.doc_id = d.doc_id), false) AS toxic FROM d),
masks AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM marked GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, bits[s] AS bit, CAST(list_sum(bits[:s]) - bits[s] AS INTEGER) AS earlier
  FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS s FROM orders)),
counts AS (
  SELECT part, filter_order, step, bit,
    CAST(coalesce(sum(n) FILTER (mask & (earlier | bit) = 0), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (mask & earlier > 0 AND mask & bit > 0), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (mask = bit), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (mask & earlier = 0 AND mask & bit > 0), 0) AS BIGINT) AS toxic_lost
  FROM masks, steps GROUP BY part, filter_order, step, bit)
SELECT * EXCLUDE (bit), CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM counts
"""

ORACLES = {"op3_mixing": OP3, "op4_decontamination": OP4, "op12_embedding_dedup": OP12, "op13_filter_audit": OP13}
