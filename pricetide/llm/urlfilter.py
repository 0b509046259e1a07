"""URL filters with redirect equivalence.

A rule (host, path, verdict) fits its host and all subdomains where the path
starts with the rule's; the longest rule wins, allow before block among equals.

A URL that no rule fits takes the decision of its aliases: URLs are nodes, tied
by redirects (a given table, and every `meta refresh` of a page) and all its
canonical links, their character references (numeric ones, amp, lt, gt, quot,
apos) decoded once, and
the connected components of that graph are the aliases. A component with a
blocked URL is blocked, unless an allow rule fits one of its URLs: explicit
allow has precedence. A URL without a decided alias is allowed. Decisions are
aggregated per component before they meet the URLs again, so a hub that a third
of all pages point to is one row on the small side.

URLs are compared without fragment and with the host's A-Z in lower case.

Defined results: a null URL, or one without ``://``, has empty host and path,
no alias and the verdict allow; null or empty pages have no links; links that
lead nowhere (empty, script or mail) are ignored; repeated rows get one result
each; without rules everything is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricetide.llm.common import ascii_lower, stored
from pricetide.llm.components import connected_components

# The registered query's rules (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = (r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\bcontent\s*=\s*"
           r"[\"']?[^\"'>]*?url\s*=\s*[\"']?([^\"'\s>]+)")

NAMED_REFERENCES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
# A reference, text without one, or a lone ampersand.
REFERENCE = (r"(?s)&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|(?:amp|lt|gt|quot)(?:;|(?![A-Za-z0-9=]))|apos;)|[^&]+|&")


def url_host(url: str | Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: str | Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_node(url: str | Column) -> Column:
    """The URL as a node of the alias graph; null if it has no ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    scheme = ascii_lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    return F.when(url.contains("://"), F.concat(scheme, F.lit("://"), url_host(url), rest))


def absolute(link: Column, base: Column) -> Column:
    """``link`` resolved against the page's URL ``base``."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (F.when(link.contains("://"), link)
             .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
             .when(link.startswith("/"), F.concat(site, link))
             .when((link == "") | link.rlike(r"^(#|[A-Za-z][A-Za-z0-9+.-]*:)"), F.lit(None).cast("string"))
             .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), link)))


def decoded(link: Column) -> Column:
    """``link`` with its numeric character references and those of `& < > " '`
    decoded, in one pass; other references stay as written."""
    tokens = F.regexp_extract_all(link, F.lit(REFERENCE), F.lit(0))

    def plain(token: Column) -> Column:
        hexadecimal = F.regexp_extract(token, "^&#[xX]([0-9a-fA-F]+);?$", 1)
        decimal = F.regexp_extract(token, "^&#([0-9]+);?$", 1)
        code = F.when(hexadecimal != "", F.conv(hexadecimal, 16, 10)).when(decimal != "", decimal).try_cast("bigint")
        sound = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        named = F.lit(None).cast("string")
        for name, char in NAMED_REFERENCES.items():
            named = F.when(token.rlike(f"^&{name};?$"), char).otherwise(named)
        return (F.when(sound, F.decode(F.unhex(F.lpad(F.hex(F.when(sound, code)), 8, "0")), "UTF-32"))
                 .when(token.rlike("^&#[0-9xX]"), "\ufffd").otherwise(F.coalesce(named, token)))

    return F.when(link.contains("&"), F.array_join(F.transform(tokens, plain), "")).otherwise(link)


def alias_links(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(a, b) nodes tied by canonical links, refreshes and ``redirects`` (src, dst)."""
    found = pages.filter(F.col("url").contains("://")).select(
        "url", F.explode(F.array_distinct(F.concat(*(
            F.regexp_extract_all("html", F.lit(p), F.lit(1)) for p in (CANONICAL, REFRESH))))).alias("link"))
    found = found.withColumn("link", decoded(F.col("link")))
    links = found.filter("link != ''").select(url_node("url").alias("a"),
                                              url_node(absolute(F.col("link"), F.col("url"))).alias("b"))
    if redirects is not None:
        links = links.union(redirects.select(url_node("src"), url_node("dst")))
    return links.filter("a is not null and b is not null")


def rule_frame(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path) -> rule, verdict of the longest fitting rule, for distinct
    pairs that a rule fits."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pairs = urls.select("host", "path").distinct().filter("host != ''")
    fitted = rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict").distinct()
    hits = (pairs.withColumn("rule_host", F.explode(suffixes)).join(fitted, "rule_host")
                 .filter(F.col("path").startswith(F.col("rule_path"))))
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(rule).alias("n"), (F.col("verdict") == "allow").alias("allow"),
                    F.length("rule_host").alias("h"), rule.alias("rule"), F.col("verdict").alias("verdict"))
    return hits.groupBy("host", "path").agg(F.max(rank).alias("best")).select(
        "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("own"))


def filter_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, verdict) for every row of ``pages``
    (page_id, url, html)."""
    rows = pages.select("page_id", "url", url_host("url").alias("host"), url_path("url").alias("path"),
                        url_node("url").alias("node"))
    links = stored(alias_links(pages, redirects), "alias-links")
    groups = stored(connected_components(links), "aliases")
    # Decisions of every URL that has an alias, pages or not, per component.
    named = groups.select("node", "component", url_host("node").alias("host"), url_path("node").alias("path"))
    # One judgement serves the pages and their aliases.
    decided = stored(judge(rows.select("host", "path").union(named.select("host", "path")), rules), "decisions")
    spread = (named.join(decided, ["host", "path"]).groupBy("component")
                   .agg(F.max((F.col("own") == "allow").cast("int")).alias("allowed"),
                        F.max((F.col("own") == "block").cast("int")).alias("blocked"))
                   .filter("allowed = 0 and blocked = 1").select("component"))
    blocked = groups.join(spread, "component").select("node", F.lit("block").alias("alias"))
    judged = rows.join(decided, ["host", "path"], "left").join(blocked, "node", "left")
    return judged.select("page_id", "url", "host", "path", "rule",
                         F.coalesce("own", "alias", F.lit("allow")).alias("verdict"))


def q_urls(spark, sf_dir):
    from pricetide.llm.common import read

    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return filter_urls(pages, rule_frame(spark, RULES)).select("page_id", "host", "path", "rule", "verdict")


# The given pages hold no canonical link or refresh, so the rules decide alone.
Q_URLS_SQL = r"""
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
q AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p),
r(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                        ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
b AS (
  SELECT page_id, host, path, rh || rp AS rule, v,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC NULLS LAST, v) AS k
  FROM q LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM b WHERE k = 1
"""
