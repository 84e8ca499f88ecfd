"""Operator 6: URL filter with redirect equivalence, DataFrame operations only.

A url is judged by the longest rule that fits its host (or a parent domain)
and whose path starts its own. Urls without a rule take the decision of their
aliases: pages tied by canonical links, meta refreshes or a given table of
redirects form connected components; a component with a blocking rule and no
allowing rule blocks its unruled members, any other component allows them. An
explicit rule of the url itself always stands.

Plan: host, path and rule are column expressions over one scan; links are
extracted only from pages whose html mentions them. Components are computed
over the linked urls alone (``components``), so pages without links cost no
shuffle beyond the final join, which the planner broadcasts when the linked
urls are few and AQE splits when one component holds many pages.

Edge cases: a null url or one without ``://`` has empty host and path, no
rule and no links, and is allowed; null html has no links; repeated urls share
one node; a link to the page itself is no edge; fragments do not make other
nodes; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rule list of the query.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def with_parts(df: DataFrame, url: str, prefix: str = "") -> DataFrame:
    """``df`` with columns host, path and node of its column ``url``, names prefixed.

    node is the url as a graph node: scheme and host lower-cased, no fragment,
    empty path as ``/``; null if there is no ``://``. One step per column, so
    that no expression is repeated inside another.
    """
    h, p, n, rest = prefix + "host", prefix + "path", prefix + "node", prefix + "rest"
    at = F.instr(F.col(url), "://")
    return (df.withColumn(rest, F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))))
            .withColumn(h, F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.lit("")))
            .withColumn(p, F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")))
            .withColumn(n, F.when(F.col(rest).isNotNull(), F.concat(
                F.translate(F.substring_index(url, "://", 1), UPPER, LOWER), F.lit("://"), F.col(h),
                F.when(F.col(p) == "", F.lit("/")).otherwise(F.col(p)),
                F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)?", 1))))
            .drop(rest))


def _longest_rule(h: Column, p: Column, rules: tuple[Rule, ...], value) -> Column:
    """``value(rule)`` of the longest fitting rule, else null. The list is small and fixed by the caller."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((h == r.host) | h.endswith("." + r.host)) & p.startswith(r.path)
        out = F.when(fits, F.lit(value(r))).otherwise(out)
    return out


def _attribute(tag: Column, name: str) -> Column:
    found = F.regexp_extract(tag, r"(?is)\s" + name + r"\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
    return F.replace(F.trim(F.regexp_replace(found, "^[\"']|[\"']$", "")), F.lit("&amp;"), F.lit("&"))


_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_CANONICAL = r"(?is)<link\b(?=[^>]*\srel\s*=\s*(?:\"[^\"]*\bcanonical\b[^\"]*\"|'[^']*\bcanonical\b[^']*'|canonical[\s/>]))[^>]*>"
_REFRESH = r"(?is)<meta\b(?=[^>]*\shttp-equiv\s*=\s*[\"']?refresh\b)[^>]*>"


def _resolved(url: Column, url_path: Column, link: Column) -> Column:
    """The link as an absolute url, seen from ``url``; null if it is empty or a fragment."""
    origin = F.regexp_extract(url, r"^([^:]*://[^/?#]*)", 1)
    folder = F.regexp_extract(url_path, r"^(.*/)[^/]*$", 1)
    return (F.when((link == "") | link.startswith("#"), F.lit(None).cast("string"))
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.startswith("//"), F.concat(F.substring_index(url, "://", 1), F.lit(":"), link))
            .when(link.startswith("/"), F.concat(origin, link))
            .otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), link)))


def link_edges(pages: DataFrame) -> DataFrame:
    """(a, b) node pairs of canonical links and meta refreshes, from pages (url, html)."""
    low = F.lower("html")
    some = pages.where(F.col("url").contains("://") & (low.contains("canonical") | low.contains("refresh")))
    shown = some.select("url", F.regexp_replace("html", _HIDDEN, " ").alias("html"))
    tags = shown.select("url", F.regexp_extract("html", _CANONICAL, 0).alias("c"), F.regexp_extract("html", _REFRESH, 0).alias("r"))
    refresh = F.trim(F.regexp_replace(F.regexp_extract(_attribute(F.col("r"), "content"), r"(?is)url\s*=\s*(.*)$", 1), "^[\"']|[\"']$", ""))
    links = tags.select("url", F.explode(F.array(_attribute(F.col("c"), "href"), refresh)).alias("link"))
    links = written(links.where(F.col("link") != ""), "url-links")
    seen = with_parts(links, "url", "a_").withColumn("to", _resolved(F.col("url"), F.col("a_path"), F.col("link")))
    return with_parts(seen, "to", "b_").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """pages (page_id, url, html) -> page_id, host, path, rule, verdict, component (node of the
    smallest alias, null without links). ``redirects``: optional further edges (from_url, to_url)."""
    h, p = F.col("host"), F.col("path")
    verdict = lambda r: r.verdict
    ruled = with_parts(pages.select("page_id", "url"), "url").select(
        "page_id", "host", "path", "node", _longest_rule(h, p, rules, lambda r: r.name).alias("rule"),
        _longest_rule(h, p, rules, verdict).alias("own"))
    edges = link_edges(pages)
    if redirects is not None:
        more = with_parts(with_parts(redirects.select("from_url", "to_url"), "from_url", "a_"), "to_url", "b_")
        edges = edges.unionByName(more.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))
    aliases = components(written(edges, "url-edges"), "url-components")
    own = with_parts(aliases, "node", "n_").select("root", _longest_rule(F.col("n_host"), F.col("n_path"), rules, verdict).alias("own"))
    decided = own.groupBy("root").agg(F.max(F.col("own") == "block").alias("any_block"), F.max(F.col("own") == "allow").alias("any_allow"))
    by_node = aliases.join(decided, "root").select(
        F.col("node").alias("alias"), F.col("root").alias("component"),
        F.when(F.coalesce("any_block", F.lit(False)) & ~F.coalesce("any_allow", F.lit(False)), "block").otherwise("allow").alias("shared"))
    return ruled.join(by_node, F.col("node") == F.col("alias"), "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", "shared", F.lit("allow")).alias("verdict"), "component")


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")).drop("component")


def _sql_rule(h: str, p: str, what: str) -> str:
    cases = "".join(f" WHEN ({h} = '{r.host}' OR ends_with({h}, '.{r.host}')) AND starts_with({p}, '{r.path}') THEN '{getattr(r, what)}'"
                    for r in sorted(RULES, key=lambda r: -len(r.name)))
    return f"CASE{cases} END"


def _sql_parts(url: str) -> tuple[str, str]:
    rest = f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"
    return (f"translate(COALESCE(regexp_extract({rest}, '^[^/?#]*', 0), ''), '{UPPER}', '{LOWER}')",
            f"COALESCE(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')")


_H, _P = _sql_parts("url")

#: The SQL holds for pages with absolute canonical links in double quotes.
ORACLE_SQL = f"""
WITH RECURSIVE p AS (
  SELECT page_id, url, {_H} AS host, {_P} AS path,
         split_part(url, '#', 1) AS node,
         split_part(regexp_extract(html, '<link[^>]*rel="canonical"[^>]*href="([^"#]+)', 1), '#', 1) AS target
  FROM pages),
r AS (SELECT *, {_sql_rule('host', 'path', 'name')} AS rule, {_sql_rule('host', 'path', 'verdict')} AS own FROM p),
e AS (SELECT node AS a, target AS b FROM r WHERE target <> '' AND target <> node
      UNION SELECT target, node FROM r WHERE target <> '' AND target <> node),
reach(a, b) AS (SELECT a, a FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
n AS (SELECT a, {_sql_rule(*_sql_parts('b'), 'verdict')} AS own FROM reach),
d AS (SELECT a, CASE WHEN bool_or(COALESCE(own = 'block', false)) AND NOT bool_or(COALESCE(own = 'allow', false))
                THEN 'block' ELSE 'allow' END AS shared FROM n GROUP BY a)
SELECT page_id, host, path, rule, COALESCE(own, shared, 'allow') AS verdict FROM r LEFT JOIN d ON r.node = d.a
"""
