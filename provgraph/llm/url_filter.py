"""URL filter: host and path rules, carried over redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provgraph.llm.common import Scratch, lower_ascii
from provgraph.llm.graph import connected_components


class Rule(NamedTuple):
    """``verdict`` (allow or block) for ``host``, its subdomains and paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does; of equally long ones allow wins.

    The rule list is configuration, compiled into one expression; it is
    ordered so that the first rule that fits is the one that counts.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow")):
        # The latest (longest) rule is the outermost condition.
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def url_key(url: Column) -> Column:
    """What names a page whatever its scheme and fragment: host, path and query string."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)", 1)
    path = path_of(url)
    return F.concat(host_of(url), F.when(path == "", "/").otherwise(path), query)


def _attribute(tag: Column, name: str) -> Column:
    value = F.regexp_extract(tag, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1)
    return F.trim(F.regexp_replace(value, r"""^["']|["']$""", ""))


def page_links(html: Column) -> Column:
    """Array of the targets of canonical links and meta-refresh redirects in a page's markup."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), F.lit(0))
    canonical = F.filter(tags, lambda t: F.lower(_attribute(t, "rel")).rlike(r"(^|\s)canonical(\s|$)"))
    refresh = F.filter(tags, lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh")
    found = F.concat(
        F.transform(canonical, lambda t: _attribute(t, "href")),
        F.transform(refresh, lambda t: F.trim(F.regexp_extract(_attribute(t, "content"), r"""(?is)url\s*=\s*['"]?([^'"]*)""", 1))),
    )
    # Markup writes & as an entity.
    return F.filter(F.transform(found, lambda u: F.regexp_replace(u, "&amp;", "&")), lambda u: u != "")


def resolved(link: Column, base: Column) -> Column:
    """``link`` as an absolute URL, seen from the page ``base``."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link))
    )


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """(id, host, path, rule, verdict, component), one row per row of ``pages``.

    A page's own rule decides first, so an explicit allow outranks every
    block that arrives over links.  A page without a rule is blocked when its
    URL is redirect-equivalent to a blocked one, and allowed otherwise.  Two
    URLs are equivalent when connected by canonical links, meta-refresh
    redirects or rows of ``redirects`` (source, target), in either direction,
    whether or not the URL between has a page; scheme and fragment do not
    count.  An explicitly allowed URL in between passes on nothing of its own
    and stops nothing.  ``component`` names the class (null when the URL has
    no link).

    Null and relative URLs have an empty host and path, fit no rule and are
    allowed; null markup has no links; repeated pages are judged alike; no
    rows or rules give no blocks.  Extra columns are not read.

    Only URLs with links enter the components job; the hash of a URL is its
    node.  The join back has one row per linked URL on the build side and is
    split by the skew join where one URL has very many pages.
    """
    scratch = Scratch(pages.sparkSession, "url-filter")
    url = F.col("_url")
    cols = [F.col(id_col).alias("_id"), F.col(url_col).alias("_url")]
    seen = pages.select(*cols, *([F.col(html_col).alias("_html")] if html_col else []))
    key = lambda u: F.md5(url_key(u).cast("binary"))
    own = matching_rule(host_of(url), path_of(url), rules)
    edges = []
    if html_col:
        link = seen.where(url.contains("://")).select("_url", F.explode(page_links(F.col("_html"))).alias("_link"))
        edges.append(link.select(url, resolved(F.col("_link"), url).alias("_to")))
    if redirects is not None:
        edges.append(redirects.select(F.col("source").alias("_url"), F.col("target").alias("_to")))
    judged = seen.select("_id", "_url", host_of(url).alias("host"), path_of(url).alias("path"), own.alias("_own"))
    if not edges:
        judged = judged.withColumn("component", F.lit(None).cast("string")).withColumn("_blocked", F.lit(False))
    else:
        both = edges[0] if len(edges) == 1 else edges[0].union(edges[1])
        both = scratch.save(both.where("_url is not null and _to is not null"))
        ends = both.select(url, key(url).alias("a"), F.col("_to"), key(F.col("_to")).alias("b"))
        comp = connected_components(scratch, ends)
        # A block can come from either end of a link, also from a URL without a page.
        nodes = ends.select(F.col("a").alias("id"), "_url").union(ends.select("b", "_to"))
        blocked = (
            nodes.where(own["verdict"] == "block").select("id").distinct()
            .join(comp, "id").select("component").distinct().withColumn("_blocked", F.lit(True))
        )
        marks = scratch.save(comp.join(blocked, "component", "left").select(F.col("id").alias("_key"), "component", F.coalesce("_blocked", F.lit(False)).alias("_blocked")))
        judged = judged.withColumn("_key", key(url)).join(marks, "_key", "left")
    verdict = F.coalesce(F.col("_own.verdict"), F.when(F.col("_blocked"), "block").otherwise("allow"))
    return judged.select(
        F.col("_id").alias(id_col), "host", "path", F.col("_own.rule").alias("rule"), verdict.alias("verdict"), "component"
    )
