"""Operator 5, URL filters with redirect equivalence.

A rule names a host (and all its subdomains) and the beginning of a path; of
the rules that fit a url the longest decides. Where none fits, the url's
aliases decide: canonical links and immediate refreshes join urls into
components; a component with an allowed url is allowed, else one with a blocked
url is blocked, else it is allowed. A url's own rule always comes first.

Null urls and urls without `://` have empty host and path, fit no rule, have no
alias and are allowed. Null html gives no edge. Relative targets are resolved
against the page's url; tags in comments and scripts count for nothing. Repeated
rows, and rows whose id is null, get a row each; other columns are ignored. Extra edges (src, dst) of a redirect log may be given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import connected_components
from .shared import cut, table

RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


_UNSEEN = r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query; empty where there is none."""
    get = lambda k: F.coalesce(F.regexp_extract(url, _URL, k), F.lit(""))
    return F.translate(get(1), _UPPER, _LOWER), get(2), get(3)


def matched(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def resolved(target: Column, src: Column) -> Column:
    """A link's target as a url, seen from the page's: of RFC 3986, with `.` and `..` taken out of the path. Null where either has no place."""
    base = F.regexp_extract(src, r"(?s)^.*?://[^/?#]*", 0)
    path = F.regexp_extract(src, _URL, 2)
    query = F.regexp_extract(target, r"(?s)^[^?#]*([?#].*)$", 1)
    own = F.regexp_extract(target, r"(?s)^[^?#]*", 0)
    joined = F.when(own == "", path).when(own.startswith("/"), own).otherwise(F.concat(F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, r"(?s)^.*/", 0)), own))
    steps = F.split(joined, "/")
    tail = F.when(joined.rlike(r"(?s)(^|/)\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda done, step: F.when(step == ".", done).when(step == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(done)).otherwise(F.concat(done, F.array(step))),
    )
    inside = F.concat(base, F.when(joined.rlike(r"(?s)(^|/)\.\.?(/|$)"), F.concat(F.array_join(kept, "/"), tail)).otherwise(joined), F.when((own == "") & ~query.startswith("?"), F.regexp_extract(src, _URL, 3)).otherwise(F.lit("")), query)
    full = F.when(target.startswith("//"), F.concat(F.lit("http:"), target)).when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), target).otherwise(inside)
    return F.when(src.contains("://") & full.contains("://"), full)


def alias_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) of canonical links and refreshes, as urls; those in comments and scripts don't count."""
    html = F.regexp_replace("html", _UNSEEN, " ")
    links = pages.where(F.col("html").rlike("(?i)canonical|http-equiv")).select(
        F.col("url").alias("src"),
        F.explode(F.concat(
            F.transform(F.regexp_extract_all(html, F.lit(_CANONICAL), 0), lambda t: F.regexp_extract(t, _HREF, 1)),
            F.transform(F.regexp_extract_all(html, F.lit(_REFRESH), 0), lambda t: F.regexp_extract(t, _TARGET, 1)),
        )).alias("dst"),
    ).where("dst <> ''")
    to = resolved(F.replace(F.col("dst"), F.lit("&amp;"), F.lit("&")), F.col("src"))
    return links.select("src", to.alias("dst")).where(F.col("dst").isNotNull())


def _address(url: Column) -> Column:
    host, path, query = parts(url)
    return F.concat(host, path, query)


def url_filters(pages: DataFrame, rules=RULES, edges: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page."""
    host, path, _ = parts(F.col("url"))
    rule, verdict = matched(F.col("host"), F.col("path"), rules)
    found = alias_edges(pages.select("url", "html"))
    if edges is not None:
        found = found.unionByName(edges.select("src", "dst"))
    found = cut(found, "aliases")  # pages are read for links once; the edges are used three times
    known = found.select(F.col("src").alias("url")).unionByName(found.select(F.col("dst").alias("url"))).distinct()
    groups = connected_components(found.select(_address(F.col("src")).alias("a"), _address(F.col("dst")).alias("b")))
    own = known.select(_address(F.col("url")).alias("id"), host.alias("host"), path.alias("path")).select("id", verdict.alias("v"))
    decided = groups.join(own, "id").groupBy("component").agg(F.when(F.bool_or(F.col("v") == "allow"), F.lit("allow")).when(F.bool_or(F.col("v") == "block"), F.lit("block")).otherwise(F.lit("allow")).alias("alias_verdict"))
    by_alias = groups.join(decided, "component").select(F.col("id").alias("address"), "alias_verdict")
    address = F.when(F.col("url").contains("://"), _address(F.col("url")))  # null joins nothing
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), address.alias("address"))
    return (
        rows.withColumns({"rule": rule, "own": verdict}).join(by_alias, "address", "left")
        .select("page_id", "host", "path", "rule", F.coalesce("own", "alias_verdict", F.lit("allow")).alias("verdict"))
    )


ORACLE_SQL = r"""
WITH RECURSIVE p AS (
  SELECT CAST(page_id AS BIGINT) AS page_id, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*(\??[^#]*)', 1), '') AS q
  FROM pages),
rules(what, h, b) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
seen AS (SELECT host || path || q AS a, host, path, q, regexp_replace(html, '(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script|$)', ' ', 'g') AS html FROM p),
tags AS (SELECT a, host, path, q, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')) AS t, 'href' AS k FROM seen
  UNION ALL SELECT a, host, path, q, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')), 'url' FROM seen),
targets AS (SELECT a, host, path, q, replace(regexp_extract(t, CASE WHEN k = 'href' THEN '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)' ELSE '(?is)\burl\s*=\s*["'']?([^"''\s>]+)' END, 1), '&amp;', '&') AS d FROM tags),
split AS (SELECT *, regexp_extract(d, '(?s)^[^?#]*') AS own, regexp_extract(d, '(?s)^[^?#]*([?][^#]*)', 1) AS dq FROM targets WHERE d <> '' AND host || path <> ''),
-- Relative targets: their own path behind the folder of the page's, then dot segments go one by one.
relative AS (SELECT a, d, host, CASE WHEN own = '' THEN path WHEN starts_with(own, '/') THEN own WHEN path = '' THEN '/' || own ELSE regexp_extract(path, '(?s)^.*/') || own END AS p,
    CASE WHEN own = '' AND dq = '' THEN q ELSE dq END AS dq
  FROM split WHERE NOT starts_with(d, '//') AND NOT regexp_matches(d, '^[A-Za-z][A-Za-z0-9+.-]*:')),
walked AS (SELECT * FROM relative UNION SELECT a, d, host, CASE WHEN regexp_matches(p, '/\.(/|$)') THEN regexp_replace(p, '/\.(/|$)', '/')
    WHEN regexp_matches(p, '^/\.\.(/|$)') THEN regexp_replace(p, '^/\.\.(/|$)', '/') ELSE regexp_replace(p, '/[^/]*/\.\.(/|$)', '/') END, dq
  FROM walked WHERE regexp_matches(p, '/\.\.?(/|$)')),
urls AS (SELECT a, 'http://' || host || p || dq AS d FROM walked WHERE NOT regexp_matches(p, '/\.\.?(/|$)')
  UNION ALL SELECT a, CASE WHEN starts_with(d, '//') THEN 'http:' || d ELSE d END FROM split WHERE starts_with(d, '//') OR regexp_matches(d, '^[A-Za-z][A-Za-z0-9+.-]*:')),
edge AS (SELECT a, translate(regexp_extract(d, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(d, '(?s)^.*?://[^/?#]*([^#]*)', 1) AS b FROM urls WHERE contains(d, '://')),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
nodes AS (SELECT DISTINCT a AS id, split_part(split_part(a, '/', 1), '?', 1) AS host, coalesce(regexp_extract(a, '^[^/?]*([^?]*)', 1), '') AS path FROM both_ways),
judged AS (SELECT n.id, (SELECT max_by(r.what, length(r.h || r.b)) FROM rules r WHERE (n.host = r.h OR ends_with(n.host, '.' || r.h)) AND starts_with(n.path, r.b)) AS v FROM nodes n),
alias AS (SELECT r.a, CASE WHEN bool_or(j.v = 'allow') THEN 'allow' WHEN bool_or(j.v = 'block') THEN 'block' ELSE 'allow' END AS v FROM (SELECT a, b FROM reach UNION SELECT a, a FROM both_ways) r JOIN judged j ON j.id = r.b GROUP BY r.a),
own AS (SELECT p.*, (SELECT max_by(r.h || r.b, length(r.h || r.b)) FROM rules r WHERE (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.b)) AS rule,
  (SELECT max_by(r.what, length(r.h || r.b)) FROM rules r WHERE (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.b)) AS v FROM p)
SELECT o.page_id, o.host, o.path, o.rule, coalesce(o.v, alias.v, 'allow') AS verdict FROM own o LEFT JOIN alias ON alias.a = o.host || o.path || o.q
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters(table(spark, sf_dir, "pages"))
