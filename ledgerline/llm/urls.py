"""URL filter rules spread over redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import connected_components

#: (verdict, host, path): a rule fits its host and all subdomains.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Query parameters that do not choose another page.
TRACKING = "^(utm_[^=]*|fbclid|gclid|ref)(=|$)"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)(?:\\?([^#]*))?"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = "(?is)<link\\b(?=[^>]*\\brel\\s*=\\s*[\"']?canonical\\b)[^>]*?\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)"
_REFRESH = "(?is)<meta\\b(?=[^>]*\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b)[^>]*?\\burl\\s*=\\s*[\"']?([^\"'\\s>]+)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def url_node(url: Column) -> Column:
    """The page a URL leads to: scheme, default port, fragment, tracking parameters and a final
    slash dropped, other parameters sorted. Null when there is no host."""
    host = F.regexp_replace(url_host(url), ":(80|443)?$", "")
    query = F.split(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 3), "&")
    kept = F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, F.rtrim(url_path(url), F.lit("/")), tail))


def resolve(base: Column, link: Column) -> Column:
    """A link found on page ``base`` as an absolute URL (null for an empty link)."""
    link = F.regexp_replace(link, "&amp;", "&")
    root = F.concat(F.lit("http://"), url_host(base))
    return (F.when(F.coalesce(link, F.lit("")) == "", None).when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(F.lit("http:"), link)).when(link.startswith("/"), F.concat(root, link))
            .when(link.startswith("?"), F.concat(root, url_path(base), link)).when(link.startswith("#"), base)
            .otherwise(F.concat(root, F.regexp_extract(F.concat(url_path(base), F.lit("")), "^(.*/)?", 0),
                                F.when(url_path(base).contains("/"), "").otherwise("/"), link)))


def page_links(pages: DataFrame) -> DataFrame:
    """Edges (u, v, target) between page nodes: canonical links and refresh redirects found in ``html``."""
    html = F.coalesce(F.col("html"), F.lit(""))
    links = F.concat(F.regexp_extract_all(html, F.lit(_LINK), 1), F.regexp_extract_all(html, F.lit(_REFRESH), 1))
    found = pages.select("url", F.explode(links).alias("link"))
    target = resolve(F.col("url"), F.col("link"))
    return found.select(url_node(F.col("url")).alias("u"), url_node(target).alias("v"), target.alias("target"))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct (rule, verdict); of equally long ones an allow rule. Null if none fits."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0], r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, links: DataFrame | None = None) -> DataFrame:
    """``pages`` (page_id, url, html) with host, path, rule and verdict.

    A page that a rule fits takes the rule's verdict. All others take the verdict
    of their aliases: pages joined by redirects and canonical links (``links``,
    URLs in columns u and v, may add redirects from a crawl log) form components,
    found by distributed star steps; a component with an explicitly allowed page
    is allowed, else one with an explicitly blocked page is blocked, else allowed.

    Defined cases: null url, or one without ``://``: host and path empty, no rule,
    allowed; null html has no links; links to pages that are not in the table
    still join aliases; a rule also judges such a target; repeated rows stay;
    extra columns are not carried, so their names cannot clash.
    """
    seen = pages.select("page_id", "url", "html")
    judged = seen.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
                         url_node(F.col("url")).alias("node"))
    judged = judged.withColumn("fit", matched_rule(F.col("host"), F.col("path"), rules))
    edges = page_links(seen)
    if links is not None:
        edges = edges.unionByName(links.select(url_node(F.col("u")).alias("u"), url_node(F.col("v")).alias("v"), F.col("v").alias("target")))
    edges = materialise(edges.where("u <> v").distinct(), "url_edges")
    groups = connected_components(edges)

    # Explicit decisions of nodes: of pages in the table, and of link targets as the rules see them.
    ends = edges.select(F.col("v").alias("node"), matched_rule(url_host(F.col("target")), url_path(F.col("target")), rules).alias("fit"))
    explicit = judged.select("node", "fit").unionByName(ends).where("node is not null and fit is not null")
    explicit = explicit.groupBy("node").agg(F.max(F.col("fit.verdict") == "allow").alias("allow"),
                                            F.max(F.col("fit.verdict") == "block").alias("block"))
    by_group = (explicit.join(groups, "node", "left").groupBy(F.coalesce("component", "node").alias("grp"))
                .agg(F.when(F.max("allow"), "allow").otherwise("block").alias("alias_verdict")))
    by_node = groups.join(by_group, F.col("component") == F.col("grp")).select("node", "alias_verdict")
    alone = by_group.join(groups, F.col("grp") == groups["node"], "left_anti").select(F.col("grp").alias("node"), "alias_verdict")
    verdicts = materialise(by_node.unionByName(alone), "url_verdicts").withColumnRenamed("node", "n")
    return (judged.join(verdicts, F.col("node") == F.col("n"), "left")
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce(F.col("fit.verdict"), F.col("alias_verdict"), F.lit("allow")).alias("verdict")))
