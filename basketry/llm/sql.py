"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

from basketry.llm.url_filter import LISTED_SITES

_URL_FILTER = r"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), split AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path,
    string_split(regexp_extract(coalesce(rest, ''), '^[^?#]*[?]([^#]*)', 1), '&') AS query
  FROM parts
), named AS (
  SELECT *, list_sort([x for x in query if x <> '' AND NOT regexp_matches(x, 'TRACKING')]) AS asked
  FROM split
), spelled AS (
  SELECT page_id, host, path,
    regexp_replace(regexp_replace(host, ':(80|443)$', ''), '[.]$|^www[.]', '', 'g') || regexp_replace(path, '/+$', '')
      || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(asked, '&') ELSE '' END AS canonical
  FROM named
), listed AS (
  SELECT DISTINCT canonical AS on_list FROM spelled
  WHERE regexp_matches(host, '(^|[.])(SITES)[.]')
), rules(rule, action, rule_host, rule_path) AS (
  VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
    ('www.example.com/en/', 'allow', 'www.example.com', '/en/'),
    ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')
), best AS (
  SELECT host, path, max_by(rule, length(rule)) AS rule, max_by(action, length(rule)) AS action
  FROM (SELECT DISTINCT host, path FROM split) s JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, s.host, s.path, rule,
  coalesce(action, CASE WHEN on_list IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM spelled s LEFT JOIN best USING (host, path) LEFT JOIN listed ON canonical = on_list
""".replace("SITES", "|".join(LISTED_SITES)).replace("TRACKING", "^(utm_[^=]*|ref|gclid|fbclid|sessionid)(=|$)")

_HOST_RULES = r"""
WITH words AS (
  SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT row_id, k, count(*) OVER (PARTITION BY row_id, w[k], w[k + 1], w[k + 2]) AS n
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS k FROM words WHERE len(w) >= 3)
), repeats AS (
  SELECT row_id, count(DISTINCT k + step) AS n_repeat_words
  FROM windows, (VALUES (0), (1), (2)) AS steps(step) WHERE n > 1 GROUP BY row_id
), measured AS (
  SELECT row_id, doc_id, source, len(w) AS n_words,
    coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len([x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')])
      - len(list_distinct([x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')]))
      AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len([x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')]) AS n_lines,
    length(regexp_replace(t, '[^\x21-\x7E]', '', 'g')) AS n_ascii
  FROM words LEFT JOIN repeats USING (row_id)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
), failures AS (
  SELECT source AS host, 'base' AS rule, base_failed AS failed FROM judged
  UNION ALL SELECT source, 'symbols', 100 * n_symbols > 10 * n_words FROM judged
  UNION ALL SELECT source, 'lines', 100 * n_dup_lines > 30 * n_lines FROM judged
  UNION ALL SELECT source, 'length', 2 * n_ascii > word_chars AND (word_chars < 3 * n_words OR word_chars > 10 * n_words)
    FROM judged
), hosts AS (
  SELECT host, rule, count(*) AS docs, count(*) FILTER (failed) AS failed FROM failures GROUP BY host, rule
), moments AS (
  SELECT rule, sum(failed) / sum(docs) AS mean, var_pop(failed / docs) AS spread, avg(1 / docs) AS inverse,
    avg(docs) AS mean_docs
  FROM hosts GROUP BY rule
), prior AS (
  SELECT rule, mean, CASE WHEN spread - mean * (1 - mean) * inverse <= 0 THEN mean_docs
    ELSE greatest(mean * (1 - mean) / (spread - mean * (1 - mean) * inverse) - 1, 1) END AS weight
  FROM moments
), rates AS (
  SELECT host, rule, (mean * weight + failed) / (weight + docs) AS rate FROM hosts JOIN prior USING (rule)
), verdicts AS (
  SELECT host, max(rate) AS worst, max(rate) FILTER (rule = 'base') AS host_rate,
    max(rate) FILTER (rule = 'symbols') AS host_symbol_rate, max(rate) FILTER (rule = 'lines') AS host_dup_line_rate,
    max(rate) FILTER (rule = 'length') AS host_word_length_rate
  FROM rates GROUP BY host
)
SELECT doc_id, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  round(host_rate, 6) AS host_rate, round(host_symbol_rate, 6) AS host_symbol_rate,
  round(host_dup_line_rate, 6) AS host_dup_line_rate, round(host_word_length_rate, 6) AS host_word_length_rate,
  NOT base_failed AND worst <= 0.5 AS kept
FROM judged JOIN verdicts ON source IS NOT DISTINCT FROM host
"""

_DECONTAMINATE = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), patterns AS (
  SELECT DISTINCT item, size, array_to_string(w[k : k + size - 1], ' ') AS pattern
  FROM (SELECT item, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k
        FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM patterns),
hits AS (
  SELECT row_id, k, p.size, item
  FROM (SELECT row_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM doc_words, sizes WHERE len(w) >= size) d
  JOIN patterns p ON p.size = d.size AND p.pattern = array_to_string(w[k : k + d.size - 1], ' ')
), covered AS (
  SELECT row_id, count(DISTINCT place) AS n_hit
  FROM (SELECT row_id, unnest(range(k, k + size)) AS place FROM hits) GROUP BY row_id
), found AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_id, item FROM hits) GROUP BY row_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (row_id) LEFT JOIN found USING (row_id)
"""

_NEGATIVES = """
WITH taken AS (
  SELECT row_number() OVER () AS uid, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.uid, a.vec_id AS anchor_id, r.uid AS other, r.vec_id, r.label = a.label AS same,
    CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM taken a JOIN taken r ON a.uid <> r.uid
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT uid, anchor_id, other, vec_id AS positive_id, score AS positive_score
  FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id, other) <= 5
)
SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
  CAST(row_number() OVER (PARTITION BY s.uid, p.other ORDER BY s.score DESC, s.vec_id, s.other) AS INT) AS rank
FROM positives p JOIN scored s USING (uid, anchor_id)
WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""

LLM_ORACLE = {
    "op13_negatives": _NEGATIVES,
    "op3_host_rules": _HOST_RULES,
    "op6_decontaminate": _DECONTAMINATE,
    "op8_url_filter": _URL_FILTER,
}
