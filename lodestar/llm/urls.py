"""URL filter with redirect equivalence.

Rules judge a url by host and path. Pages that name each other by redirect or canonical link are
aliases; connected components of those links carry a block from any alias to those without a rule,
and an explicit allow of any alias takes precedence over it. Only SQL expressions, joins and
aggregates are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.llm.components import stars

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    """``action`` is allow or block; ``pattern`` a host, a slash and the start of a path."""

    action: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits (an allow before a block of the same length); null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.action == "allow", r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(rule.pattern)).otherwise(out)
    return out


def _action(rule: Column, rules: Sequence[Rule]) -> Column:
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == r.pattern, F.lit(r.action)).otherwise(out)
    return out


def node_of(url: Column) -> Column:
    """The document a url names: host, path and query, without scheme and fragment; null without a host."""
    query = F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), query))


def _absolute(target: Column, base: Column) -> Column:
    """A link target as a whole url: absolute, from the host's root, or beside the page."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    origin = F.concat(F.lit("http://"), host_of(base))
    folder = F.regexp_extract(path_of(base), "^(.*/)", 1)
    return (
        F.when(F.instr(target, "://") > 0, target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), target))
    )


def alias_links(pages: DataFrame) -> DataFrame:
    """``src`` and ``dst`` urls of the canonical links and page redirects that the html states."""
    canonical = F.regexp_extract(F.regexp_extract("html", _CANONICAL, 0), _HREF, 1)
    refresh = F.regexp_extract(F.regexp_extract("html", _REFRESH, 0), _TARGET, 1)
    stated = pages.filter(F.col("html").isNotNull() & (host_of(F.col("url")) != "")).select(
        "url", F.explode(F.array(canonical, refresh)).alias("target"))
    return stated.filter("target <> ''").select(F.col("url").alias("src"), _absolute(F.col("target"), F.col("url")).alias("dst"))


def judge(pages: DataFrame, rules: Sequence[Rule], links: DataFrame | None = None) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of each row of ``pages``.

    ``links`` are urls ``src`` and ``dst`` that lead to each other (from a crawl's redirect log,
    say), next to those stated in the html. A url with a rule gets the rule's verdict. One without is
    allowed if any of its aliases has an allow rule, else blocked if any has a block rule, else allowed. A null
    url, or one without ``://``, has empty host and path, no rule and no aliases, and is allowed. A null html states
    no links; a repeated row is judged twice; an empty table gives an empty table.
    """
    stated = alias_links(pages)
    if links is not None:
        stated = stated.unionByName(links.select("src", "dst"))
    named = stated.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b"))
    roots = stars(named)
    # A root stands in no row of its own.
    nodes = roots.unionByName(roots.select(F.col("root").alias("id"), "root").distinct())
    as_url = F.concat(F.lit("http://"), F.col("id"))
    judged = nodes.withColumn("action", _action(rule_of(host_of(as_url), path_of(as_url), rules), rules))
    by_root = judged.groupBy("root").agg(F.min("action").alias("decided"))  # allow sorts before block
    aliases = nodes.join(by_root.filter("decided is not null"), "root").select(F.col("id").alias("node"), "decided")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    # Urls without a host have no aliases; names of their own keep them from meeting in one task.
    node = F.coalesce(node_of(F.col("url")), F.concat(F.lit(" "), F.xxhash64("page_id", F.monotonically_increasing_id()).cast("string")))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), node.alias("node")).withColumn(
        "rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(_action(F.col("rule"), rules), F.col("decided"), F.lit("allow"))
    return rows.join(aliases, "node", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"))
