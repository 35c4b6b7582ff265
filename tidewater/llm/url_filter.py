"""URL filters with redirect equivalence.

Rules (host and path prefix, block or allow) judge urls; the longest fitting
rule wins. Redirects and canonical links make urls aliases of one another:
their connected components carry a block to every member that no rule judges,
unless a member of the component is allowed by a rule (allow goes before
block). All of it is DataFrame work: no Python runs on the executors.

Aliases come from ``<link rel=canonical>`` and ``<meta http-equiv=refresh>`` in
the pages and from an optional redirect log (from_url, to_url).

Defined results: a null url or one without ``://`` has empty host and path and
is allowed; a url's identity is its scheme, host (A-Z lower-cased) and the rest
without fragment; relative link targets are resolved against the page's url or
its ``<base href>``; null or empty html has no links; repeated rows get equal results; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm._components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (host, path, verdict) of the rules of production
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: a rule table of at most so many rows is broadcast
BROADCAST_RULES = 100_000


def _rest(url: Column) -> Column:
    return F.when(url.contains("://"), F.substring(url, F.instr(url, "://") + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def identity(url: Column) -> Column:
    """What tells urls apart: scheme and host lower-cased, no fragment; null
    for what is not a url."""
    scheme = F.translate(F.substring_index(url, "://", 1), _UPPER, _LOWER)
    behind = F.regexp_extract(_rest(url), r"^[^/?#]*([^#]*)", 1)
    return F.when(url.contains("://"), F.concat(scheme, F.lit("://"), host_of(url), behind))


def _let(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often it is named."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _without_dots(path: Column) -> Column:
    """A path without its segments ``.`` and ``..``."""
    empty = F.array().cast("array<string>")

    def joined(parts: Column) -> Column:
        kept = F.aggregate(parts, empty, lambda acc, x: F.when(x == ".", acc).when((x == "..") & (F.size(acc) < 2), empty)
                           .when(x == "..", F.slice(acc, 1, F.size(acc) - 1)).otherwise(F.concat(acc, F.array(x))))
        last = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(empty)
        return F.concat(F.lit("/"), F.array_join(F.concat(kept, last), "/"))

    return _let(F.split(F.substring(path, 2, F.length(path)), "/", -1), joined)


def _absolute(base: Column, target: Column) -> Column:
    """A link target as a url, resolved against ``base`` (a url); null if it
    has a scheme without ``://``."""
    def resolved(x: Column) -> Column:
        to, root, path = x["target"], F.concat(x["scheme"], F.lit("://"), x["host"]), x["path"]
        own, behind = F.regexp_extract(to, r"^([^?#]*)", 1), F.regexp_extract(to, r"^[^?#]*(.*)$", 1)
        folder = F.concat(F.lit("/"), F.regexp_extract(path, r"^/(.*/)", 1))
        plain = _without_dots(F.when(to.startswith("/"), own).otherwise(F.concat(folder, own)))
        return (F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), to)
                .when(to.startswith("//"), F.concat(x["scheme"], F.lit(":"), to))
                .when(to.startswith("?"), F.concat(root, path, to))
                .when((to == "") | to.startswith("#"), x["base"])
                .otherwise(F.concat(root, plain, behind)))

    target = F.regexp_replace(F.trim(F.regexp_replace(target, r"[\t\r\n]", "")), "&amp;", "&")
    return _let(F.struct(base.alias("base"), target.alias("target"), F.substring_index(base, "://", 1).alias("scheme"),
                         host_of(base).alias("host"), path_of(base).alias("path")), resolved)


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, quoted or bare; empty without it."""
    pattern = rf"(?i)[\s\"'/]{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\"'\s>]+))"
    return F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (a, b) between identities that pages declare, of all their tags."""
    head = F.col(html)
    tags = lambda name: F.regexp_extract_all(head, F.lit(rf"(?i)<{name}\b[^>]*>"), F.lit(0))
    canonical = F.filter(tags("link"), lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical"))
    refresh = F.filter(tags("meta"), lambda t: F.lower(F.trim(_attribute(t, "http-equiv"))) == "refresh")
    targets = F.concat(F.transform(canonical, lambda t: _attribute(t, "href")),
                       F.transform(refresh, lambda t: F.regexp_extract(t, r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)))
    bases = F.filter(F.transform(tags("base"), lambda t: _attribute(t, "href")), lambda h: h != "")
    found = (pages.where(F.col(url).contains("://") & head.rlike("(?i)canonical|http-equiv"))
             .select(F.col(url).alias("url"), F.get(bases, F.lit(0)).alias("base"), F.explode(targets).alias("target")).where("trim(target) <> ''"))
    # each step is exploded, so that the next does not repeat its expressions
    found = found.select("url", "target", F.explode(F.array(_absolute(F.col("url"), F.col("base")))).alias("base"))
    found = found.select("url", "target", F.explode(F.array(F.when(F.col("base").contains("://"), F.col("base")).otherwise(F.col("url")))).alias("base"))
    found = found.select("url", F.explode(F.array(_absolute(F.col("base"), F.col("target")))).alias("to"))
    return found.select(identity(F.col("url")).alias("a"), identity(F.col("to")).alias("b")).where("b IS NOT NULL")


def rule_table(spark, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge(nodes: DataFrame, rules: DataFrame, broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``nodes`` (node, host, path, ...) with ``rule`` and ``rule_verdict`` of the
    longest fitting rule, null without one. A host meets the rules by its own
    name and each parent domain; equally long rules are the same rule, of
    which block goes first."""
    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"),
                         F.col("verdict").alias("r_verdict")).distinct()
    parts = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(parts)),
                          lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    met = nodes.select("node", "path", F.explode(parents).alias("r_host"))
    if rules.limit(broadcast_rules + 1).count() <= broadcast_rules:
        rules = F.broadcast(rules)
    name = F.concat("r_host", "r_path")
    best = (met.join(rules, "r_host").where(F.col("path").startswith(F.col("r_path")))
            .groupBy("node").agg(F.max(F.struct(F.length(name).alias("n"), name.alias("rule"), F.col("r_verdict").alias("v"))).alias("best")))
    return nodes.join(best, "node", "left").select(nodes["*"], F.col("best.rule").alias("rule"), F.col("best.v").alias("rule_verdict"))


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None,
                url: str = "url", html: str = "html", key: str = "page_id") -> DataFrame:
    """Per page: key, host, path, rule (or null), verdict."""
    spark = pages.sparkSession
    urls = pages.select(F.col(url).alias("url"), F.col(html).alias("html"))
    edges = page_links(urls)
    if redirects is not None:
        edges = edges.union(redirects.select(identity(F.col("from_url")), identity(F.col("to_url"))))
    own = urls.select(identity(F.col("url")).alias("node"))
    group = components(edges, "url-aliases")
    nodes = (own.union(group.select("node")).where("node IS NOT NULL").distinct()
             .select("node", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path")))
    judged = judge(nodes, rule_table(spark, rules)).join(group, "node", "left")
    # a block reaches a component's members unless one of them is allowed by a rule
    spread = (judged.where("component IS NOT NULL").groupBy("component")
              .agg(F.coalesce(F.bool_or(F.col("rule_verdict") == "block"), F.lit(False)).alias("blocked"),
                   F.coalesce(F.bool_or(F.col("rule_verdict") == "allow"), F.lit(False)).alias("allowed")))
    settled = judged.join(spread, "component", "left").select(
        "node", "rule", F.coalesce("rule_verdict", F.when(F.col("blocked") & ~F.col("allowed"), "block").otherwise("allow")).alias("verdict"))
    rows = pages.select(F.col(key).alias("__key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), identity(F.col(url)).alias("node"))
    return rows.join(settled, "node", "left").select(
        F.col("__key").alias(key), "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))
