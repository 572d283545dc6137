"""DuckDB twins of the operators that SQL can express, over whole tables.

The rest has none: the ids of a tokenizer (op1, op2, op4), learned models and
bounds (op5, op9), sketches (op7), a hash that DuckDB lacks (op12), eigenvectors
(op13), and byte strings that start at every byte of
a text (op3, too slow in SQL).  Tests hold those against brute force.
"""

from __future__ import annotations

# Fixed value: what separates words is 20 and 09-0D.
WORDS = r"[^\x20\x09-\x0D]+"

#: The windows of 20 words that also start earlier, then the words no such window covers.
OP8 = rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words FROM documents
),
places AS (
  SELECT doc_id, len(words) AS n, unnest(range(1, len(words) + 1)) AS k,
    unnest(words) AS word, words FROM texts
),
windows AS (
  SELECT doc_id, n, k, word,
    CASE WHEN k + 19 <= n THEN sha256(array_to_string(words[k:k + 19], ' ')) END AS content
  FROM places
),
judged AS (
  SELECT doc_id, k, word,
    content IS NOT NULL AND row_number() OVER (PARTITION BY content ORDER BY doc_id, k) > 1 AS again
  FROM windows
),
covered AS (
  SELECT doc_id, k, word, bool_or(again) OVER (
    PARTITION BY doc_id ORDER BY k ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM judged
),
kept AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY k) FILTER (NOT gone) AS kept
  FROM covered GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

#: Equal sets are one class; classes that share a shingle are compared; links are followed to the end.
OP6 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS words
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(
    range(1, greatest(len(words) - 3, 2)),
    lambda k: md5(array_to_string(words[k:k + 4], ' '))))) END AS own
  FROM texts
),
named AS (
  SELECT cls, min(rep) AS rep, any_value(own) AS own FROM (
    SELECT md5(array_to_string(own, '')) AS cls, doc_id AS rep, own FROM sets WHERE len(own) > 0)
  GROUP BY cls
),
shingles AS (SELECT rep, len(own) AS n, unnest(own) AS shingle FROM named),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM shingles a JOIN shingles b
    ON a.shingle = b.shingle AND a.rep <> b.rep AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reached AS (
  SELECT rep AS node, rep AS top FROM named
  UNION
  SELECT links.b, reached.top FROM reached JOIN links ON reached.node = links.a
),
tops AS (SELECT node, min(top) AS top FROM reached GROUP BY node)
SELECT s.doc_id, CAST(len(s.own) AS BIGINT) AS n_shingles, coalesce(top, s.doc_id) AS component_id
FROM sets s LEFT JOIN named ON len(s.own) > 0 AND cls = md5(array_to_string(s.own, ''))
LEFT JOIN tops ON node = rep
"""

#: Five hexadecimal digits of a digest are four of base32.
OP10 = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages
),
ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS first_id FROM payloads
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(digest, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT)
      >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM ranked
"""

#: Documents by mask, masks by order, orders by step.
OP11 = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words FROM documents
),
flags AS (
  SELECT doc_id, max(CAST(quality = 1 AS BIGINT)) AS good, max(CAST(toxic = 1 AS BIGINT)) AS toxic FROM labels GROUP BY doc_id
),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, MAP {{
    'A': len(words) < 100,
    'B': 100 * len(list_distinct(words)) < 80 * len(words),
    'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)}} AS fails
  FROM texts t LEFT JOIN flags f ON t.doc_id = f.doc_id
),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
orders AS (
  SELECT '' AS filter_order
  UNION ALL
  SELECT filter_order || letter FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter)
  WHERE NOT contains(filter_order, letter)
),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS own, filter_order[:step - 1] AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders WHERE length(filter_order) = 5)
),
seen AS (
  SELECT *, fails[own] AS hit,
    len(list_filter(string_split(earlier, ''), lambda f: f <> '' AND coalesce(fails[f], false))) > 0 AS gone,
    len(list_filter(map_values(fails), lambda f: f)) = 1 AS alone
  FROM cells CROSS JOIN steps
),
summed AS (
  SELECT part, filter_order, step, own,
    CAST(coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (NOT gone AND hit), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (gone AND hit), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (hit AND alone), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (NOT gone AND hit), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (NOT gone AND hit), 0) AS BIGINT) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, own
)
SELECT * EXCLUDE own, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM summed
"""

ORACLE = {"op6_jaccard_join": OP6, "op8_substring_dedup": OP8, "op10_warc_archive": OP10, "op11_filter_audit": OP11}
