"""URL rules, with block decisions carried along redirects and canonical links.

A page's address and the addresses that it declares as its own (canonical link) or sends its readers to
(meta refresh) name one resource. These edges form components; a block on one member holds for its
aliases unless a rule allows the alias itself, or allows another member (an explicit allow comes first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairreach.llm.common import let, table
from fairreach.llm.graph import components
from fairreach.llm.registry import query
from fairreach.session import scratch_path

ALLOW, BLOCK = "allow", "block"
#: Rules of the registered query: host with path, and what it says.
RULES = (("com/", ALLOW), ("example.com/en/", BLOCK), ("www.example.com/en/", ALLOW), ("net/es/", BLOCK), ("net/fr/", BLOCK))

_AFTER = r"(?s)^.*?://"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an address; both empty for null or without ``://``."""
    known = url.contains("://")
    rest = F.regexp_replace(url, _AFTER, "")
    host = F.when(known, lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)))
    path = F.when(known, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def resource(url: Column) -> Column:
    """What makes two addresses the same one: host, path and query; null without ``://``."""

    def of(x: Column) -> Column:
        host, path = host_path(x)
        asked = F.regexp_extract(F.regexp_replace(x, _AFTER, ""), r"^[^?#]*(\?[^#]*)?", 1)
        return F.when(x.contains("://"), F.concat(host, let(path, lambda p: F.when(p == "", F.lit("/")).otherwise(p)), asked))

    return let(url, of)


def absolute(link: Column, base: Column) -> Column:
    """A link as it stands on a page with address ``base``."""
    return let(F.trim(F.regexp_replace(link, "&amp;", "&")), lambda x: _absolute(x, base))


def _absolute(link: Column, base: Column) -> Column:
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    host, path = host_path(base)
    folder = let(path, lambda p: F.when(p == "", F.lit("/")).otherwise(F.regexp_extract(p, r"(?s)^(.*/)", 1)))
    return (
        F.when(link == "", None)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(scheme, F.lit("://"), host, link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:|^#"), None)
        .otherwise(F.concat(scheme, F.lit("://"), host, folder, link))
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """``(source, target)`` addresses: all canonical links and meta refreshes of each page's html."""
    tags = lambda what: F.regexp_extract_all("html", F.lit(what), F.lit(0))
    links = F.concat(
        F.transform(
            tags(r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""), lambda t: F.regexp_extract(t, r"""(?is)\bhref\s*=\s*["']?([^"'\s>]*)""", 1)
        ),
        F.transform(
            tags(r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""), lambda t: F.regexp_extract(t, r"""(?is)\burl\s*=\s*['"]?([^"'\s>]*)""", 1)
        ),
    )
    targets = F.transform(links, lambda link: absolute(link, F.col("url")))
    found = pages.where(pages.html.rlike("(?i)canonical|refresh")).select(F.col("url").alias("source"), F.explode(targets).alias("target"))
    return found.where("source is not null and target is not null")


def matching_rule(host: Column, path: Column, rules) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits, of equally long ones an allow, else null."""
    fits = None
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[1] != ALLOW, r[0])):
        name, _, start = rule.partition("/")
        on_host = (host == name) | host.endswith("." + name)
        test = on_host & path.startswith("/" + start)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fits = F.when(test, value) if fits is None else fits.when(test, value)
    return fits if fits is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def judge(pages: DataFrame, rules=RULES, edges: DataFrame | None = None, default: str = ALLOW) -> DataFrame:
    """``page_id, host, path, rule, verdict, by`` for every page row.

    ``edges`` are (source, target) addresses known from crawling; the pages' own canonical links and refreshes are added.
    ``by`` says what decided: rule, alias or default. A rule fits its host, all subdomains and paths
    that start with the rule's; the longest wins. Without a rule of its own, a page takes from its component: allow
    where a member's rule allows, else block where a member's rule blocks, else ``default``.
    Null addresses and those without ``://`` have an empty host and path, no rule and the default. Rows are kept as they
    are, repeated ids too; an empty table gives no rows.
    """
    spark = pages.sparkSession
    pages = pages.select("page_id", "url", "html")
    found = page_edges(pages)
    if edges is not None:
        found = found.union(edges.select("source", "target"))
    found = found.select(resource(F.col("source")).alias("a"), resource(F.col("target")).alias("b")).where("a is not null and b is not null")
    path = scratch_path(spark, "edges")
    found.distinct().write.parquet(path)
    members = components(spark.read.parquet(path))
    where, at = F.regexp_extract("node", r"^[^/?#]*", 0), F.regexp_extract("node", r"^[^/?#]*([^?#]*)", 1)
    said = members.withColumn("own", matching_rule(where, at, rules)["verdict"])
    carried = said.groupBy("root").agg(F.min("own").alias("alias"))  # "allow" comes before "block"
    aliases = members.join(carried.where("alias is not null"), "root").select(F.col("node").alias("resource"), "alias")

    host, path = host_path(F.col("url"))
    own = pages.select("page_id", host.alias("host"), path.alias("path"), resource(F.col("url")).alias("resource"))
    own = own.withColumn("own", matching_rule(F.col("host"), F.col("path"), rules)).join(aliases, "resource", "left")
    return own.select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "alias", F.lit(default)).alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(F.col("alias").isNotNull(), "alias").otherwise("default").alias("by"),
    )


ORACLE = r"""
WITH RECURSIVE rules(rule, name, start, said) AS (VALUES
    ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'), ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
    ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
page AS (
    SELECT row_number() OVER () AS r, page_id, url, html,
        CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS asked
    FROM page),
node AS (SELECT *, CASE WHEN rest <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || asked END AS resource FROM parts),
link AS (
    SELECT resource AS a, regexp_extract(unnest(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>')), '(?is)\bhref\s*=\s*["'']?[a-z]+://([^"''\s>#]*)', 1) AS b FROM node
    UNION
    SELECT resource, regexp_extract(unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>')), '(?is)\burl\s*=\s*["'']?[a-z]+://([^"''\s>#]*)', 1) FROM node),
edge AS (SELECT a, b FROM link WHERE a IS NOT NULL AND b <> '' AND a <> b UNION SELECT b, a FROM link WHERE a IS NOT NULL AND b <> '' AND a <> b),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a),
said AS (
    SELECT a, b, (SELECT arg_max(said, length(rule)) FROM rules
        WHERE (regexp_extract(b, '^[^/?#]*') = name OR ends_with(regexp_extract(b, '^[^/?#]*'), '.' || name))
            AND starts_with(regexp_extract(b, '^[^/?#]*([^?#]*)', 1), start)) AS v
    FROM reach),
alias AS (SELECT a, min(v) AS v FROM said GROUP BY a),
best AS (
    SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said
    FROM node JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(said, v, 'allow') AS verdict,
    CASE WHEN rule IS NOT NULL THEN 'rule' WHEN v IS NOT NULL THEN 'alias' ELSE 'default' END AS "by"
FROM node LEFT JOIN best USING (r) LEFT JOIN alias ON alias.a = node.resource
"""


@query("op1_url_filters", ORACLE)
def op1(spark, sf_dir):
    return judge(table(spark, sf_dir, "pages"))
