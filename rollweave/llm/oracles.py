"""DuckDB SQL for the operators whose results SQL can express."""

from rollweave.llm.urlfilter import _NAME, _WS, ATTRIBUTE, link_tag, token


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _attribute(name: str) -> str:
    """The value of the first attribute of that name among ``attributes``, without quotes."""
    found = f"list_filter(attributes, lambda a: lower(regexp_extract(a, '^[ \\t\\n\\f\\r/]?({_quoted(_NAME)})', 1)) = '{name}')[1]"
    value = f"regexp_extract({found}, '(?s)^[^=]*={_WS}*(.*)$', 1)"
    return f"(CASE WHEN left({value}, 1) IN ('\"', '''') THEN substr({value}, 2, length({value}) - 2) ELSE {value} END)"


_URL = """
  SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages"""

_OP10 = f"""
WITH RECURSIVE p AS ({_URL}),
h AS (
  SELECT page_id, url, html,
    coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(rest, '^[^?#]*([?][^#]*)', 1), '') AS query
  FROM p),
rules(rhost, rpath, rule, verdict) AS (VALUES
  ('com', '/', 'com/', 'allow'), ('example.com', '/en/', 'example.com/en/', 'block'),
  ('www.example.com', '/en/', 'www.example.com/en/', 'allow'), ('net', '/es/', 'net/es/', 'block'), ('net', '/fr/', 'net/fr/', 'block')),
tag AS (
  SELECT h.*, CASE WHEN path = '' THEN '/' ELSE path END AS spot, unnest(tags) AS tag, generate_subscripts(tags, 1) AS place
  FROM (SELECT *, list_filter(regexp_extract_all(html, '{_quoted(token("*"))}', 0), lambda t: regexp_matches(t, '{_quoted(link_tag("*"))}')) AS tags FROM h WHERE host <> '') h),
said AS (
  SELECT * EXCLUDE (attributes), lower(regexp_extract(tag, '^<([A-Za-z]+)', 1)) AS sort,
    {_attribute("rel")} AS rel, {_attribute("http-equiv")} AS equiv, {_attribute("href")} AS href0, {_attribute("content")} AS content
  FROM (SELECT *, regexp_extract_all(tag, '(?s){_quoted(ATTRIBUTE)}', 0) AS attributes FROM tag)),
kinds AS (
  SELECT *, CASE WHEN sort = 'base' THEN 'base' WHEN sort = 'link' AND regexp_matches(rel, '(?i)(^|\\s)canonical(\\s|$)') THEN 'canonical'
      WHEN sort = 'meta' AND regexp_matches(equiv, '(?i)^\\s*refresh\\s*$') THEN 'refresh' END AS kind,
    CASE WHEN sort = 'meta' THEN regexp_extract(content, '(?is)\\burl\\s*=\\s*["'']?\\s*([^"''\\s]+)', 1) ELSE href0 END AS href1 FROM said),
decoded AS (
  -- numeric references and &amp;
  SELECT * EXCLUDE (href1), regexp_extract(replace(list_reduce(list_prepend(href1, list_distinct(regexp_extract_all(href1, '&#[0-9]{{1,7}};|&#[xX][0-9a-fA-F]{{1,6}};'))), lambda held, r:
      replace(held, r, chr(CASE WHEN lower(substr(r, 3, 1)) = 'x' THEN ('0x' || substr(r, 4, length(r) - 4))::INTEGER ELSE substr(r, 3, length(r) - 3)::INTEGER END))), '&amp;', '&'), '(?s)^\\s*(\\S*)', 1) AS href
  FROM kinds WHERE kind IS NOT NULL),
based AS (
  SELECT page_id, url, html, arg_min(CASE
      WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href WHEN starts_with(href, '//') THEN 'x:' || href WHEN starts_with(href, '/') THEN 'x://' || host || href
      WHEN starts_with(href, '?') THEN 'x://' || host || path || href ELSE 'x://' || host || regexp_extract(spot, '^(.*/)', 1) || href END, place) AS base
  FROM decoded WHERE kind = 'base' AND href <> '' GROUP BY ALL),
link AS (
  SELECT d.* REPLACE (coalesce(bhost, d.host) AS host, coalesce(bpath, d.path) AS path, CASE WHEN bhost IS NULL THEN d.spot WHEN bpath = '' THEN '/' ELSE bpath END AS spot), d.host || d.spot || d.query AS self
  FROM decoded d LEFT JOIN (
    SELECT page_id, url, html, regexp_extract(base, '^.*?://([^/?#]*)', 1) AS bhost, regexp_extract(base, '^.*?://[^/?#]*([^?#]*)', 1) AS bpath FROM based) b
    ON b.page_id IS NOT DISTINCT FROM d.page_id AND b.url = d.url AND b.html = d.html
  WHERE kind <> 'base' AND href <> ''),
target AS (
  SELECT *, CASE
      WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
      WHEN starts_with(href, '//') THEN 'x:' || href
      WHEN starts_with(href, '/') THEN 'x://' || host || href
      WHEN starts_with(href, '?') THEN 'x://' || host || path || href
      ELSE 'x://' || host || regexp_extract(spot, '^(.*/)', 1) || href END AS url2
  FROM link),
parts AS (
  SELECT self AS a,
    translate(regexp_extract(url2, '^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host2,
    regexp_extract(url2, '^.*?://[^/?#]*([^?#]*)', 1) AS path2, regexp_extract(url2, '^.*?://[^?#]*([?][^#]*)', 1) AS query2
  FROM target),
target2 AS (
  SELECT * FROM parts
  UNION ALL
  SELECT a, host2, list_reduce(list_prepend('', string_split(regexp_replace(path2, '^/', ''), '/')), lambda held, x:
      CASE x WHEN '..' THEN regexp_replace(held, '/[^/]*$', '') WHEN '.' THEN held ELSE held || '/' || x END)
    || CASE WHEN regexp_matches(path2, '(^|/)[.][.]?$') THEN '/' ELSE '' END, query2
  FROM parts WHERE regexp_matches(path2, '(^|/)[.][.]?(/|$)')),
edge AS (
  SELECT a, host2 || CASE WHEN path2 = '' THEN '/' ELSE path2 END || query2 AS b FROM target2 WHERE host2 <> ''),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
blocked AS (
  SELECT a AS node FROM (SELECT DISTINCT a FROM both_ways) n
  WHERE (SELECT arg_max(r.verdict, length(r.rule)) FROM rules r
         WHERE (split_part(a, '/', 1) = r.rhost OR ends_with(split_part(a, '/', 1), '.' || r.rhost))
           AND starts_with(regexp_extract(a, '^[^/]*(/[^?]*)', 1), r.rpath)) = 'block'),
reach AS (SELECT node FROM blocked UNION SELECT b FROM reach JOIN both_ways ON a = node),
best AS (
  SELECT h.page_id, h.url, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM h JOIN rules r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY ALL)
SELECT h.page_id, h.host, h.path, best.rule,
  coalesce(best.verdict, CASE WHEN reach.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM h
LEFT JOIN best ON best.page_id IS NOT DISTINCT FROM h.page_id AND best.url IS NOT DISTINCT FROM h.url
LEFT JOIN reach ON reach.node = h.host || CASE WHEN h.path = '' THEN '/' ELSE h.path END || h.query
"""

_OP3 = """
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AND row_number() OVER (PARTITION BY text_sha256, doc_id) = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

_OP4 = """
WITH d AS (
  SELECT doc_id, text, coalesce('s' || source, 'n') AS skey,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    -ln((('0x' || substr(md5(coalesce(cast(doc_id AS varchar), '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
      / (0.5::DOUBLE + 0.5::DOUBLE * ((share * share) * (share * share))) AS key
  FROM (SELECT *, coalesce(CASE WHEN length(text) > 0
      THEN length(translate(text, '#$%&*|!<>{}[]^~=+@ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', ''))::DOUBLE / length(text) END, 0) AS share FROM documents)),
s AS (
  SELECT skey, sum(size)::BIGINT AS source_size, count(*) AS docs,
    (row_number() OVER (ORDER BY skey = 'n', skey) - 1) % 3 + 1 AS weight FROM d GROUP BY skey),
r AS (
  SELECT *, row_number() OVER o AS place,
    sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_weight
  FROM s WINDOW o AS (ORDER BY source_size / weight, skey)),
l AS (SELECT place AS spot, rest AS level_rest, rest_weight AS level_weight FROM r
      WHERE rest * weight <= 3 * source_size * rest_weight ORDER BY place LIMIT 1),
t AS (
  SELECT skey, source_size, docs,
    CASE WHEN spot IS NULL OR place < spot THEN (3 * source_size)::DOUBLE ELSE (level_rest * weight)::DOUBLE / level_weight END AS target
  FROM r LEFT JOIN l ON true),
e AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(3, floor(target / source_size))::BIGINT END AS epochs FROM t),
m AS (
  SELECT d.*, source_size, target, epochs, target - epochs * source_size AS budget,
    floor(greatest(1, ceil(docs / 1024)) * (1 - exp(-key)))::BIGINT AS bucket
  FROM d JOIN e USING (skey)),
b AS (
  SELECT skey, bucket, budget, sum(sum(size)) OVER (PARTITION BY skey ORDER BY bucket) AS upto, sum(size) AS words,
    max(max(size)) OVER (PARTITION BY skey) AS most
  FROM m GROUP BY skey, bucket, budget),
c AS (
  SELECT skey, min(bucket) AS end_bucket, arg_min(upto - words, bucket) AS before,
    coalesce(min(bucket) FILTER (upto > budget + 2 * most), max(bucket)) AS last_bucket
  FROM b WHERE upto > budget GROUP BY skey),
x AS (SELECT m.*, budget - before AS gap FROM m JOIN c ON m.skey = c.skey AND bucket BETWEEN end_bucket AND last_bucket),
p1 AS (SELECT *, sum(size) OVER (PARTITION BY skey ORDER BY key, doc_id, size) <= gap AS more FROM x),
q1 AS (SELECT * REPLACE (gap - coalesce(sum(size) FILTER (more) OVER (PARTITION BY skey), 0) AS gap) FROM p1),
p2 AS (SELECT *, NOT more AND size <= gap AND coalesce(sum(size) FILTER (NOT more AND size <= gap) OVER (PARTITION BY skey ORDER BY key, doc_id, size), 0) <= gap AS add FROM q1),
q2 AS (SELECT * EXCLUDE (add) REPLACE (more OR add AS more, gap - coalesce(sum(size) FILTER (add) OVER (PARTITION BY skey), 0) AS gap) FROM p2),
p3 AS (SELECT *, NOT more AND size <= gap AND coalesce(sum(size) FILTER (NOT more AND size <= gap) OVER (PARTITION BY skey ORDER BY key, doc_id, size), 0) <= gap AS add FROM q2),
q3 AS (SELECT * EXCLUDE (add) REPLACE (more OR add AS more, gap - coalesce(sum(size) FILTER (add) OVER (PARTITION BY skey), 0) AS gap) FROM p3),
n AS (SELECT *, rank() OVER (PARTITION BY skey ORDER BY more OR size = 0, size, key, doc_id) = 1 AND NOT more AND size > 0 AND size < 2 * gap AS last_one FROM q3),
f AS (
  SELECT doc_id, size, source_size, target, epochs + (more OR last_one)::BIGINT AS copies FROM n
  UNION ALL
  SELECT doc_id, size, source_size, target, epochs + (bucket < end_bucket AND epochs < 3)::BIGINT
  FROM m JOIN c USING (skey) WHERE bucket NOT BETWEEN end_bucket AND last_bucket
  UNION ALL
  SELECT doc_id, size, source_size, target, epochs FROM m WHERE skey NOT IN (SELECT skey FROM c))
SELECT doc_id, size, source_size, target, size * copies AS taken FROM f
"""

SQL = {"op3_exact_dedup": _OP3, "op4_source_mixing": _OP4, "op10_url_filters": _OP10}

_OP8 = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

SQL["op8_exact_topk"] = _OP8


def _op13() -> str:
    def nearest(name: str, books: str) -> str:
        square = "list_sum(list_transform(list_zip(x.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
        return f"""{name} AS (
  SELECT rid, p, near.d AS d, near.e AS e FROM (
    SELECT x.rid, x.p, min(struct_pack(d := {square}, e := b.e)) AS near FROM x JOIN {books} b ON x.p = b.p GROUP BY x.rid, x.p))"""

    def means(name: str, books: str, found: str) -> str:
        return f"""{name}_sum AS (
  SELECT p, e, pos, sum(value)::HUGEINT AS s, count(*) AS n
  FROM (SELECT p, e, unnest(x.x) AS value, generate_subscripts(x.x, 1) AS pos FROM {found} JOIN x USING (rid, p)) GROUP BY ALL),
{name} AS (
  SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM {books} b
  LEFT JOIN (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS x FROM {name}_sum GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"""

    return f"""
WITH q AS (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM (SELECT rid, v, unnest(range(16)) AS p FROM q)),
b0 AS MATERIALIZED (
  SELECT p, e, x FROM (SELECT rid, row_number() OVER (ORDER BY vec_id, v) - 1 AS e FROM q QUALIFY e < 64) JOIN x USING (rid)),
{nearest("a0", "b0")},
{means("b1", "b0", "a0")},
{nearest("a1", "b1")},
{means("b2", "b1", "a1")},
{nearest("a2", "b2")},
c AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a2 GROUP BY rid),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM q JOIN c USING (rid) JOIN h ON true
"""


SQL["op13_vector_codes"] = _op13()
