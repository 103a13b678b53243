"""DuckDB SQL over whole tables that gives the rows of a query, where SQL can express it."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op9_url_expressions"] = r"""
WITH rules(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts AS (
  SELECT row_number() OVER () AS row, page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fit AS (
  SELECT p.row, r.host || r.path AS rule, r.verdict,
    row_number() OVER (PARTITION BY p.row ORDER BY length(r.host || r.path) DESC) AS n
  FROM parts p JOIN rules r
    ON (p.host = r.host OR suffix(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fit f ON p.row = f.row AND f.n = 1
"""

ORACLE_SQL["op6_weighted_sampling"] = r"""
WITH known AS (SELECT doc_id, max(quality) AS label FROM labels GROUP BY doc_id),
docs AS (
  SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    CASE WHEN k.label > 0 THEN 2.0::DOUBLE WHEN k.label <= 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS quality,
    md5(concat_ws('|', 'mix', coalesce(d.doc_id::VARCHAR, ''), coalesce(md5(d.text), ''))) AS tie
  FROM documents d LEFT JOIN known k ON d.doc_id = k.doc_id),
drawn AS (
  SELECT *, -ln((('0x' || substr(tie, 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / quality AS draw FROM docs),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM drawn GROUP BY source),
weighted AS (
  SELECT *, [3.0::DOUBLE, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
    source_size * 2.0::DOUBLE AS most FROM totals),
rated AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
      - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM weighted),
targets AS (SELECT source, source_size, least(most, max(rate) OVER () * weight) AS target FROM rated),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM drawn d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (whole * size + greatest(0, least(size, floor(target + 0.5)::BIGINT - whole * source_size - before)))::BIGINT AS taken
FROM placed
"""

ORACLE_SQL["op8_snapshot_collapse"] = r"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
conv AS (
  SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS said
  FROM turns GROUP BY conv_id)
SELECT c.conv_id, c.n_turns,
  array_to_string(list_transform(c.said, lambda t: '<|' || coalesce(t.r, '') || '|>' || chr(10) || coalesce(t.t, '') || chr(10) || '<|end|>' || chr(10)), '') AS rendered
FROM conv c
WHERE NOT EXISTS (
  SELECT 1 FROM conv o
  WHERE o.said[1] IS NOT DISTINCT FROM c.said[1]
    AND (o.n_turns > c.n_turns OR o.n_turns = c.n_turns AND (o.conv_id < c.conv_id OR o.conv_id IS NULL AND c.conv_id IS NOT NULL))
    AND o.said[1:c.n_turns] = c.said)
"""

ORACLE_SQL["op3_containment_search"] = r"""
WITH doc_words AS (
  SELECT DISTINCT doc_id, md5(text) AS t, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
item_words AS (
  SELECT DISTINCT item_id, md5(text) AS t, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
sizes AS (SELECT 5 AS k UNION SELECT DISTINCT len(w) FROM item_words WHERE len(w) BETWEEN 1 AND 4),
doc_set AS (
  SELECT DISTINCT doc_id, t, s FROM (SELECT doc_id, t, unnest(list_transform(
    range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS s FROM doc_words, sizes WHERE len(w) >= k)),
item_set AS (
  SELECT DISTINCT item_id, t, s FROM (SELECT item_id, t, unnest(list_transform(
    range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM item_words WHERE len(w) > 0)),
item_size AS (SELECT item_id, t, count(*) AS n_item FROM item_set GROUP BY item_id, t),
found AS (
  SELECT d.doc_id, d.t, i.item_id, count(*)::BIGINT AS n_found, any_value(n.n_item)::BIGINT AS n_item
  FROM doc_set d JOIN item_set i ON d.s = i.s JOIN item_size n ON i.item_id IS NOT DISTINCT FROM n.item_id AND i.t = n.t
  GROUP BY d.doc_id, d.t, i.item_id, i.t HAVING 5 * count(*) >= 4 * any_value(n.n_item))
SELECT doc_id, item_id, n_found, n_item FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, t, item_id ORDER BY n_found / n_item DESC, n_item DESC) AS best FROM found)
WHERE best = 1
"""

ORACLE_SQL["op1_secret_ownership"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
    concat_ws('/', source, lang) AS repo FROM documents),
found AS (
  SELECT row, owner, repo, 'assign' AS kind, 0 AS rank, 8 AS least, regexp_extract_all(t, p) AS whole,
    regexp_extract_all(t, p, 2) AS value, string_split_regex(t, p) AS gap
  FROM docs, (SELECT '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' AS p)
  UNION ALL SELECT row, owner, repo, 'access', 1, 16, regexp_extract_all(t, 'AKIA[A-Z0-9]+'),
    regexp_extract_all(t, 'AKIA[A-Z0-9]+'), string_split_regex(t, 'AKIA[A-Z0-9]+') FROM docs
  UNION ALL SELECT row, owner, repo, 'hex', 2, 32, regexp_extract_all(t, '[0-9a-f]+'),
    regexp_extract_all(t, '[0-9a-f]+'), string_split_regex(t, '[0-9a-f]+') FROM docs
  UNION ALL SELECT row, owner, repo, 'token', 3, 20, regexp_extract_all(t, '[A-Za-z0-9+/_=-]{20,}'),
    regexp_extract_all(t, '[A-Za-z0-9+/_=-]{20,}'), string_split_regex(t, '[A-Za-z0-9+/_=-]{20,}') FROM docs),
each AS (
  SELECT row, owner, repo, kind, rank, least, i, whole[i] AS whole, value[i] AS value, gap[i] AS gap
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM found)),
placed AS (
  SELECT *, sum(length(gap) + length(whole)) OVER (PARTITION BY row, kind ORDER BY i) AS stop FROM each),
kept AS (SELECT * FROM placed WHERE length(value) >= least),
spread AS (
  SELECT *, CASE WHEN owners >= 3 OR repos >= 4 THEN 5 WHEN owners = 1 THEN 3 ELSE 4 END AS rank
  FROM (SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT {'o': owner, 'r': repo}) AS repos FROM kept GROUP BY value)),
spans AS (
  SELECT row, kind, rank, stop - length(whole) AS start, stop, NULL AS owners, NULL AS repos FROM kept WHERE rank < 3
  UNION
  SELECT row, ['live', 'shared', 'copied'][s.rank - 2], s.rank, stop - length(k.value), stop, owners, repos
  FROM kept k JOIN spread s ON k.value = s.value
  WHERE s.rank = 5 OR length(k.value) >= 16
    AND len(list_distinct(string_split(k.value, ''))) >= 8 AND regexp_matches(k.value, '[0-9]') AND regexp_matches(k.value, '[A-Za-z]')
    AND NOT regexp_matches(k.value, '(?i)example|sample|dummy|placeholder|change_?me|your|xxxx|test_?key|1234567')),
joined AS (
  SELECT row,
    count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'live') AS n_live, count(*) FILTER (kind = 'shared') AS n_shared,
    count(*) FILTER (kind = 'copied') AS n_copied,
    string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank, stop) FILTER (rank < 3) AS base,
    string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank, stop) FILTER (rank < 4) AS spans,
    string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, rank, stop) FILTER (rank = 5) AS copied,
    string_agg(concat(kind, ':', start, ':', stop, ':', owners, ':', repos), ',' ORDER BY start, rank, stop) FILTER (rank > 2) AS owned
  FROM spans GROUP BY row)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared, coalesce(n_copied, 0) AS n_copied, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(copied, '') AS copied,
  coalesce(owned, '') AS owned
FROM docs d LEFT JOIN joined j ON d.row = j.row
"""
