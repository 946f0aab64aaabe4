"""SQL that the queries of this package must agree with, where SQL can express them."""

# A word is a run of characters other than ASCII white space; A-Z are lower-cased one by one, as lower() also changes others.
_OP4 = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+4], ' ') for i in range(1, len(w) - 3)]) END AS s
  FROM words
), sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes UNION SELECT reach.doc_id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.other
)
SELECT doc_id, CAST(any_value(n) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM sizes JOIN reach USING (doc_id) GROUP BY doc_id
"""

_OP6 = """
WITH cut AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, rest, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), keyed AS (
  SELECT page_id, host, path,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[.]+$', ''), '^(www|m)[.](.*[.].*)$', '\\2') AS site,
    CASE WHEN regexp_replace(path, '/+$', '') = '' THEN '/' ELSE regexp_replace(path, '/+$', '') END AS place,
    list_sort(list_filter(string_split(regexp_extract(regexp_replace(rest, '#.*', ''), '[?](.*)', 1), '&'),
      lambda x: x <> '' AND string_split(x, '=')[1] NOT IN ('utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'gclid', 'fbclid', 'ref'))) AS query
  FROM parts
), canon AS (
  SELECT page_id, host, path, CASE WHEN site <> '' THEN site || place || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS c FROM keyed
), listed AS (
  SELECT DISTINCT c FROM canon WHERE c IS NOT NULL AND list_has_any(string_split(host, '.'), ['adult-x', 'spam-farm'])
), ruled AS (
  SELECT page_id, host, path, c, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM canon
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN listed.c IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  listed.c IS NOT NULL AS listed
FROM ruled LEFT JOIN listed ON ruled.c = listed.c
"""

SQL: dict[str, str] = {"op4_jaccard_join": _OP4, "op6_url_filters": _OP6}
