"""URL rules, carried over to the aliases of a URL: redirects and canonical links make URLs one page.

A rule (host, path prefix, verdict) fits its host and all subdomains; the longest fitting rule decides,
and of equally long ones allow does. Redirects (meta refresh) and canonical links of the pages are edges
between URLs, as are edges given by the caller. Components of these edges are alias groups, found without
gathering them anywhere. A URL without a rule of its own is blocked if its group holds a URL that a rule
blocks and none that a rule allows; otherwise it is allowed.

Two spellings are one URL if they differ only in scheme, upper case of the host, default port, fragment,
tracking parameters, the order of parameters or a missing path.

Defined results: a null url, or one without ``://``, has empty host and path, no rule and no aliases,
and is allowed; null html has no edges; relative targets are taken relative to their page; equal rows get
equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landgate.llm.components import components
from landgate.llm.tables import stored, table

RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Rules given as a Python list are sent to every executor; more than these come as a DataFrame.
MAX_LISTED_RULES = 10_000
TRACKING = "utm_[a-z_]*|gclid|fbclid|msclkid|mc_cid|mc_eid"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def node(url: Column) -> Column:
    """A 64-bit name of the URL that all its spellings share; null if it has no ``://``."""
    host = F.regexp_replace(url_host(url), ":(80|443)$", "")
    path = F.when(url_path(url) == "", "/").otherwise(url_path(url))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.filter(
        F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")
    )
    name = F.concat_ws("", host, path, F.lit("?"), F.array_join(F.array_sort(kept), "&"))
    return F.when(F.instr(url, "://") > 0, F.xxhash64(name))


#: What holds no tags of a page: comments, scripts and styles, up to the page's end if nothing closes them.
NO_MARKUP = r"(?is)<!--(?:.*?-->|.*+)|<(script|style|textarea|template)\b(?:.*?</\1\b|.*+)"
#: A link or meta tag. Possessive groups take any number of characters without the stack, and no sign after which
#: another tag may begin is passed, so a page is read once however broken its tags are.
TAG = r"""(?is)<(?:link|meta)\b(?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+>"""


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(from_url, to_url): every canonical link and meta refresh of the pages, none from comments or scripts."""
    markup = F.regexp_replace(F.col(html), NO_MARKUP, " ")
    tags = F.regexp_extract_all(markup, F.lit(TAG), F.lit(0))
    tag = F.col("_tag")
    canonical = tag.rlike(r"(?i)^<link\b") & tag.rlike(r"""(?i)\brel\s*=\s*["']?[^"'>]*\bcanonical\b""")
    refresh = tag.rlike(r"(?i)^<meta\b") & tag.rlike(r"""(?i)http-equiv\s*=\s*["']?refresh""")
    value = r"""(?is)\s%s\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    href = F.concat(*(F.regexp_extract(tag, value % "href", i) for i in (1, 2, 3)))
    content = F.concat(*(F.regexp_extract(tag, value % "content", i) for i in (1, 2, 3)))
    to = F.when(canonical, href).when(
        refresh, F.regexp_extract(content, r"""(?is)url\s*=\s*["']?([^"'\s]+)""", 1)
    )
    to = F.replace(F.trim(to), F.lit("&amp;"), F.lit("&"))
    origin = F.regexp_extract("_url", r"(?s)^.*?://[^/?#]*", 0)
    scheme = F.regexp_extract("_url", r"(?s)^(.*?:)//", 1)
    folder = F.regexp_extract("_url", r"(?s)^.*?://[^/?#]*(?:[^?#]*/)?", 0)
    full = (
        F.when(to.contains("://"), to)
        .when(to.startswith("//"), F.concat(scheme, to))
        .when(to.startswith("/"), F.concat(origin, to))
        .when(to != "", F.concat(F.when(folder == origin, F.concat(folder, F.lit("/"))).otherwise(folder), to))
    )
    found = pages.select(F.col(url).alias("_url"), F.explode(tags).alias("_tag"))
    found = found.filter(canonical | refresh).filter(F.instr("_url", "://") > 0)
    return found.select(F.col("_url").alias("from_url"), full.alias("to_url")).filter("to_url IS NOT NULL")


def rule_table(spark: SparkSession, rules) -> DataFrame:
    if isinstance(rules, DataFrame):
        return rules.select("rule_host", "rule_path", "rule_verdict")
    if len(rules) > MAX_LISTED_RULES:
        raise ValueError(f"give more than {MAX_LISTED_RULES} rules as a DataFrame")
    schema = "rule_host string, rule_path string, rule_verdict string"
    return F.broadcast(spark.createDataFrame(list(rules), schema))


def ruled(urls: DataFrame, rules) -> DataFrame:
    """``urls`` (url) once each, with host, path and the rule that decides, if any."""
    spark = urls.sparkSession
    urls = urls.select("url").distinct()
    urls = urls.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    tried = urls.select("url", "path", F.explode(suffixes).alias("rule_host"))
    fits = tried.join(rule_table(spark, rules), "rule_host").filter("startswith(path, rule_path)")
    rule = F.concat("rule_host", "rule_path")
    best = F.struct(F.length(rule).alias("n"), F.col("rule_verdict") == "allow", rule.alias("rule"), "rule_verdict")
    best = fits.groupBy("url").agg(F.max(best).alias("best"))
    return urls.join(best, "url", "left").select(
        "url", "host", "path", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("own")
    )


def judged_urls(pages: DataFrame, rules=RULES, links: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages`` (page_id, url, html).

    ``links`` (from_url, to_url) adds redirects known from elsewhere, such as a crawl's log.
    """
    found = page_links(pages)
    found = found.union(links.select("from_url", "to_url")) if links is not None else found
    found = stored(found.distinct(), "url-links")
    own = pages.select("page_id", "url")
    linked = found.select(F.col("from_url").alias("url")).union(found.select(F.col("to_url").alias("url")))
    decided = stored(ruled(own.select("url").union(linked), rules), "url-rules")
    edges = found.select(node(F.col("from_url")).alias("a"), node(F.col("to_url")).alias("b"))
    groups = components(edges, "url-aliases")
    named = decided.withColumn("node", node(F.col("url")))
    blocks = (
        named.filter("own IS NOT NULL")
        .join(groups, "node")
        .groupBy("component")
        .agg(F.max(F.col("own") == "allow").alias("allowed"))
        .filter("NOT allowed")
        .select("component", F.lit(True).alias("blocked"))
    )
    aliases = groups.join(blocks, "component").select("node", "blocked")
    verdicts = named.join(aliases, "node", "left").select(
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("own", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
    )
    same = own["url"].eqNullSafe(verdicts["url"])
    return own.join(verdicts, same).select("page_id", "host", "path", "rule", "verdict")


def op7_redirect_aliases(spark, sf_dir):
    return judged_urls(table(spark, sf_dir, "pages"))


#: The given pages hold neither canonical links nor refreshes, so no URL has an alias and the rules decide alone.
SQL = r"""
WITH parts AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
rules (h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
best AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)
"""
QUERIES = {"op7_redirect_aliases": (op7_redirect_aliases, SQL)}
