"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {}

SQL["op1_url_filters"] = r"""
WITH rules(h, p, action) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
urls AS (
  SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls),
met AS (
  SELECT r, page_id, host, path, h || p AS rule, action, row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC) AS k
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM met WHERE k = 1
"""

SQL["op8_exact_dedup"] = f"""
WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

SQL["op4_mixing"] = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len({WORDS}) AS size, replace(replace(replace(replace(replace(replace(coalesce(text, ''), ' ', ''), chr(9), ''), chr(10), ''), chr(11), ''), chr(12), ''), chr(13), '') AS dense FROM documents),
k AS (
  SELECT doc_id, source, size,
         0.25 + 0.75 * coalesce(length(regexp_replace(dense, '[0-9#*$%&|<>{{}}\[\]=_~^]', '', 'g'))::DOUBLE / nullif(length(dense), 0), 0.0) AS q,
         (('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT source, source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
c AS (
  SELECT *, coalesce(sum(cap) OVER b, 0.0) AS cap_before, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0) AS weight_left, sum(source_size) OVER ()::DOUBLE AS total
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - cap_before) / weight_left AS level FROM c),
free AS (SELECT level AS free FROM l WHERE cap / weight >= level ORDER BY cap / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN cap / weight < level THEN cap ELSE weight * (SELECT free FROM free) END AS target FROM l),
e AS (SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs FROM t),
r AS (SELECT *, greatest(round(target - epochs * source_size)::BIGINT, 0) AS rest FROM e),
p AS (
  SELECT doc_id, size, source_size, target, epochs, rest,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY -ln(u) / q, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN r ON k.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM p
"""

STEP = "ln(1.002::DOUBLE / 0.998::DOUBLE)"
RANK = "s[1 + floor({} * (len(s) - 1))::BIGINT]"
PAIR = ", ".join(f"nullif({RANK.format(b)} - {RANK.format(a)}, 0)" for a, b in [("0.25", "0.75"), ("0.1", "0.9"), ("0.05", "0.95"), ("0", "1")])
SQL["op6_quality_rules"] = rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
l AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
rep AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) t(o) GROUP BY r),
m AS (
  SELECT w.r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(lines) AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN l USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
v AS (
  SELECT *, unnest(['chars', 'symbols', 'dup', 'repeat']) AS ratio,
         unnest([coalesce(word_chars::DOUBLE / nullif(n_words, 0), 0), coalesce(n_symbols::DOUBLE / nullif(n_words, 0), 0), coalesce(n_dup_lines::DOUBLE / nullif(n_lines, 0), 0), coalesce(n_repeat_words::DOUBLE / nullif(n_words, 0), 0)]) AS value FROM b),
k AS (SELECT *, CASE WHEN value >= 0.001 THEN ceil(ln(value) / {STEP})::BIGINT END AS bucket FROM v),
x AS (SELECT lang, source, ratio, bucket FROM k WHERE NOT base_failed AND bucket IS NOT NULL),
q2 AS (SELECT lang, source, ratio, list_sort(list(bucket)) AS s FROM x GROUP BY ALL HAVING count(*) >= 50),
q1 AS (SELECT lang, ratio, list_sort(list(bucket)) AS s FROM x GROUP BY ALL HAVING count(*) >= 50),
q0 AS (SELECT ratio, list_sort(list(bucket)) AS s FROM x GROUP BY ALL),
f AS (
  SELECT a.lang, a.source, a.ratio, coalesce(q2.s, q1.s, q0.s) AS s FROM (SELECT DISTINCT lang, source, ratio FROM k WHERE NOT base_failed) a
  LEFT JOIN q2 ON q2.lang IS NOT DISTINCT FROM a.lang AND q2.source IS NOT DISTINCT FROM a.source AND q2.ratio = a.ratio
  LEFT JOIN q1 ON q1.lang IS NOT DISTINCT FROM a.lang AND q1.ratio = a.ratio LEFT JOIN q0 ON q0.ratio = a.ratio),
f1 AS (SELECT lang, source, ratio, {RANK.format("0.25")} AS lo, {RANK.format("0.75")} AS hi, coalesce({PAIR}, 0) AS spread FROM f),
j AS (
  SELECT k.r, bool_and(coalesce(bucket <= hi + 3 * spread AND (k.ratio <> 'chars' OR bucket >= lo - 3 * spread), TRUE)) AS fine
  FROM k LEFT JOIN f1 ON f1.lang IS NOT DISTINCT FROM k.lang AND f1.source IS NOT DISTINCT FROM k.source AND f1.ratio = k.ratio GROUP BY k.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND fine AS kept FROM b JOIN j USING (r)
"""

SQL["op7_substring_dedup"] = rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
g AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM w)),
twice AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY md5(g)) > 1),
covered AS (SELECT DISTINCT r, i + o AS i FROM twice, range(0, 35) t(o)),
gone AS (SELECT r, list(i) AS gone FROM covered GROUP BY r),
kept AS (SELECT r, list(x ORDER BY i) AS kept FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w) ANTI JOIN covered USING (r, i) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(array_to_string(coalesce(kept, []), ' ')) AS kept_sha256
FROM w LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)
"""

KEY = "translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL["op11_line_dedup"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, i, line, {KEY} AS key FROM (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d)),
common AS (SELECT key FROM l WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
kept AS (SELECT r, list(line ORDER BY i) AS kept FROM l ANTI JOIN common USING (key) GROUP BY r)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(len(kept), 0))::BIGINT AS n_dropped, sha256(array_to_string(coalesce(kept, []), chr(10))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

SQL["op13_hard_negatives"] = """
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score FROM e a JOIN e b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS k FROM s WHERE same),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor, k ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT same AND k <= 5 AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
