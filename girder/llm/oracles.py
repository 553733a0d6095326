"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from girder.llm import repeats, url_filter

SUFFIX_ARRAY_DEDUP = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (
  SELECT doc_id, i, md5(hex(array_slice(b, i + 1, i + {repeats.WINDOW}))) AS h
  FROM (SELECT doc_id, b, unnest(range(0, n - {repeats.WINDOW - 1})) AS i FROM d WHERE n >= {repeats.WINDOW})),
twice AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
marked AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {repeats.WINDOW} THEN 0 ELSE 1 END AS fresh
  FROM w SEMI JOIN twice USING (h)),
runs AS (
  SELECT doc_id, min(i) AS a, max(i) + {repeats.WINDOW} AS z
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM marked) GROUP BY doc_id, r),
gaps AS (
  SELECT doc_id, coalesce(lag(z) OVER o, 0) AS x, a AS y FROM runs WINDOW o AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, coalesce(max(z), 0), any_value(n) FROM d LEFT JOIN runs USING (doc_id) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(CASE WHEN x < y THEN hex(array_slice(b, x + 1, y)) ELSE '' END, '' ORDER BY x) AS k
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n - length(k) / 2 AS BIGINT) AS n_removed,
  coalesce((SELECT count(*) FROM runs WHERE runs.doc_id = d.doc_id), 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id)
"""


def _host(u: str) -> str:
    return f"translate(coalesce(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), ''), '{url_filter.UPPER}', '{url_filter.LOWER}')"  # noqa: E501


def _path(u: str) -> str:
    return f"coalesce(regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _undotted(p: str) -> str:
    kept = (
        f"list_reduce(list_transform(string_split({p}, '/'), lambda s: [s]), lambda a, s: CASE WHEN s[1] = '.' THEN a"
        " WHEN s[1] = '..' THEN CASE WHEN len(a) > 1 THEN a[:-2] ELSE a END ELSE list_concat(a, s) END)"
    )
    return f"array_to_string({kept}, '/') || CASE WHEN regexp_matches({p}, '/[.][.]?$') THEN '/' ELSE '' END"


def _address(u: str) -> str:
    query = f"regexp_extract({u}, '(?s)^.*?://[^?#]*([?][^#]*)', 1)"
    path = f"CASE WHEN {_path(u)} = '' THEN '/' ELSE {_undotted(_path(u))} END"
    return f"CASE WHEN contains({u}, '://') THEN {_host(u)} || {path} || {query} END"


def _attribute(tag: str, name: str) -> str:
    quoted = url_filter.ATTRIBUTE.replace("'", "''")
    parts = " || ".join(f"regexp_extract({tag}, '(?i)\\s{name}{quoted}', {i})" for i in (1, 2, 3))
    return f"nullif(trim(replace({parts}, '&amp;', '&')), '')"


def _rule(host: str, path: str, column: str) -> str:
    cases = "".join(
        f" WHEN ({host} = '{h}' OR ends_with({host}, '.{h}')) AND starts_with({path}, '{p}')"
        f" THEN '{h + p if column == 'rule' else v}'"
        for h, p, v in sorted(url_filter.RULES, key=lambda r: (-len(r[0] + r[1]), r))
    )
    return f"CASE{cases} END"


URL_FILTER = f"""
WITH RECURSIVE tags AS (
  SELECT url, unnest(regexp_extract_all(html, '(?i)<link\\b[^>]*>')) AS t, 'link' AS kind FROM pages
  UNION ALL SELECT url, unnest(regexp_extract_all(html, '(?i)<meta\\b[^>]*>')), 'meta' FROM pages),
links AS (
  SELECT url, {_attribute("t", "href")} AS l FROM tags
  WHERE kind = 'link' AND list_contains(string_split_regex(lower({_attribute("t", "rel")}), '\\s+'), 'canonical')
  UNION ALL
  SELECT url, nullif(regexp_extract({_attribute("t", "content")}, '(?i)url\\s*=\\s*[''"]?([^''"]+)', 1), '') FROM tags
  WHERE kind = 'meta' AND lower({_attribute("t", "http-equiv")}) = 'refresh'),
whole AS (
  SELECT url, CASE WHEN contains(l, '://') THEN l WHEN starts_with(l, '//') THEN 'http:' || l
    WHEN starts_with(l, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || l
    ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)
      || CASE WHEN regexp_replace({_path("url")}, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace({_path("url")}, '[^/]*$', '') END
      || l END AS target FROM links WHERE l IS NOT NULL),
e AS (SELECT {_address("url")} AS a, {_address("target")} AS b FROM whole),
near AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach AS (SELECT a, a AS b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a),
said AS (
  SELECT a, {_rule("split_part(b, '/', 1)", "substr(b, strpos(b, '/'))", "verdict")} AS v FROM reach),
shared AS (SELECT a, CASE WHEN bool_or(v = 'allow') THEN 'allow' WHEN bool_or(v = 'block') THEN 'block' END AS s
           FROM said GROUP BY a),
judged AS (SELECT page_id, {_host("url")} AS host, {_path("url")} AS path, {_address("url")} AS address FROM pages)
SELECT page_id, host, path, {_rule("host", "path", "rule")} AS rule,
  coalesce({_rule("host", "path", "verdict")}, s, 'allow') AS verdict
FROM judged LEFT JOIN shared ON judged.address = shared.a
"""

ORACLES = {"op5_url_filter": URL_FILTER, "op8_suffix_array_dedup": SUFFIX_ARRAY_DEDUP}
