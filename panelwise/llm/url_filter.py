"""Allow and block rules for URLs, carried over redirects and canonical links."""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.llm.common import ascii_lower, fresh, whole
from panelwise.llm.components import components
from panelwise.session import materialize, small_frame

#: Scheme, host and path of an address; what follows them is left over.
_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_TAGS = r"(?is)<(?:link|meta|base)\b[^>]*>"
_BASE = r"(?is)^<base\b.*?\bhref\s*=\s*[\"']?\s*[^\"'\s>]"
_CANONICAL = r"(?is)\brel\s*=\s*[\"']?\s*canonical\b"
_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?\s*refresh\b"
_HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
_TARGET = r"(?is)\bcontent\s*=\s*[\"']?[^\"'>]*?\burl\s*=\s*[\"']?\s*([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    return ascii_lower(F.regexp_extract(whole(url), _ADDRESS, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(whole(url), _ADDRESS, 2)


_DOTS = r"/\.{1,2}(/|$)"


def _resolved_dots(paths: pd.Series) -> pd.Series:
    out = []
    for path in paths:
        if path is None:
            out.append(None)
            continue
        kept, parts = [], path.split("/")[1:]
        for part in parts:
            if part == "..":
                del kept[-1:]
            elif part != ".":
                kept.append(part)
        if parts[-1] in (".", ".."):
            kept.append("")
        out.append("/" + "/".join(kept))
    return pd.Series(out, dtype=object)


def _without_dots(path: Column) -> Column:
    """The path with its segments . and .. resolved; only paths that have some are sent to Python."""
    dotted = F.when(path.rlike(_DOTS), path)
    return F.coalesce(F.pandas_udf(_resolved_dots, T.StringType())(dotted), path)


def address_of(url: Column) -> Column:
    """The URL as a node of the link graph: scheme and host lower-cased, dots resolved, no fragment; null if it has no host."""
    scheme = ascii_lower(F.substring_index(url, "://", 1))
    path = path_of(url)
    query = F.regexp_extract(url, r"(?s)^(?>.*?://)[^?#]*+(\?[^#]*)", 1)
    path = F.when((path == "") & (query == ""), "/").otherwise(_without_dots(path))
    host = host_of(url)
    return F.when(host != "", F.concat(scheme, F.lit("://"), host, path, query))


_REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*(?:;|(?![A-Za-z0-9=])))")
_PARTS = re.compile(r"(.*?)://([^/?#]*)([^?#]*)", re.DOTALL)


def _decoded(value: str) -> str:
    """An attribute's value with its character references decoded, by the rules for attributes: &copy=1 is none."""
    return _REFERENCE.sub(lambda m: unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0], value)


def _resolved(target: str, page: str | None) -> str | None:
    """The target as seen from a page; its dots stay.  None if it is no address of a page."""
    target = target.strip()
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", target):
        return target if re.match(r"[A-Za-z][A-Za-z0-9+.-]*://", target) else None
    parts = _PARTS.match(page or "")
    if not parts:
        return None
    scheme, host, path = parts.groups()
    if target.startswith("//"):
        return f"{scheme}:{target}"
    if target.startswith("/"):
        return f"{scheme}://{host}{target}"
    if target.startswith("#"):
        return page
    if target.startswith("?"):
        return f"{scheme}://{host}{path or '/'}{target}"
    return f"{scheme}://{host}{path.rpartition('/')[0]}/{target}"


def _targets(url: pd.Series, base: pd.Series, target: pd.Series) -> pd.Series:
    out = []
    for page, first, to in zip(url, base, target):
        start = _resolved(_decoded(first), page) if first else None
        out.append(_resolved(_decoded(to), start or page))
    return pd.Series(out, dtype=object)


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): addresses joined by a canonical link or a redirect written in the page.

    Targets are resolved against the page's first <base href>, or else its own url,
    and their character references are decoded.
    """
    tags = F.regexp_extract_all(whole(F.col(html)), F.lit(_TAGS), F.lit(0))
    found = (
        pages.select(F.col(url).alias("url"), tags.alias("tags"))
        .select(
            "url",
            F.regexp_extract(whole(F.get(F.filter("tags", lambda x: x.rlike(_BASE)), F.lit(0))), _HREF, 1).alias("base"),
            F.explode(F.filter("tags", lambda x: ~x.rlike(r"(?i)^<base\b") & (x.rlike(_CANONICAL) | x.rlike(_REFRESH)))).alias("tag"),
        )
        .withColumn(
            "target",
            F.when(F.col("tag").rlike(_CANONICAL), F.regexp_extract("tag", _HREF, 1)).otherwise(F.regexp_extract("tag", _TARGET, 1)),
        )
    )
    full = found.filter("target <> ''").select("url", F.pandas_udf(_targets, T.StringType())("url", "base", "target").alias("full"))
    edges = full.select(address_of(F.col("url")).alias("a"), address_of(F.col("full")).alias("b"))
    return edges.filter("a <> b").distinct()


def rules_frame(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) as a table; equal host and path: allow wins."""
    return small_frame(spark, rules, "rule_host string, rule_path string, rule_verdict string")


def judge(urls: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(key, rule, rule_verdict) for the keys whose address some rule fits; the longest rule wins.

    ``urls`` has the key, host and path.  The host's suffixes of as many labels as the
    rules have are looked up among them by equality, so the work for an address depends
    neither on the number of rules nor on its further labels.  The best rule is a partial aggregate.
    """
    most = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 1
    count = F.least(F.size(F.split("host", r"\.")), F.lit(most))
    suffix = F.explode(F.transform(F.sequence(F.lit(1), count), lambda k: F.call_function("substring_index", "host", F.lit("."), -k)))
    fits = (
        urls.filter("host <> ''")
        .select(key, "path", suffix.alias("rule_host"))
        .join(rules, "rule_host")
        .filter("startswith(path, rule_path)")
    )
    rule = F.concat("rule_host", "rule_path")
    rank = F.struct(F.length(rule).alias("length"), (F.col("rule_verdict") == "allow").alias("allow"), rule.alias("rule"))
    return (
        fits.groupBy(key)
        .agg(F.max(rank).alias("best"))
        .select(key, "best.rule", F.when(F.col("best.allow"), "allow").otherwise("block").alias("rule_verdict"))
    )


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """The pages with host, path, rule and verdict; their html is left out.

    A page that a rule fits has that rule's verdict.  Another one is blocked if an
    address it is equivalent to, over canonical links and redirects in either
    direction and any number of steps, is blocked by a rule and none is allowed by
    one; else it is allowed.  Linked addresses count although no page has them.
    Null urls and urls without :// have an empty host and path and are allowed.
    Every row gives one row, repeated rows too.  Columns named host, path, rule or
    verdict are replaced.
    """
    spark = pages.sparkSession
    kept = [f"`{c}`" for c in pages.columns if c not in (html, "host", "path", "rule", "verdict")]
    raw, place, best, said, bad = fresh(pages, "raw", "place", "best", "said", "bad")
    plain = pages.select(*kept, F.col(f"`{url}`").alias(raw))
    seen = plain.select(F.col(raw).alias("url")).distinct()
    ruled = judge(seen.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")), rules, "url")
    ruled = ruled.select(F.col("url").alias(raw), F.col("rule").alias(best), F.col("rule_verdict").alias(said))

    groups = components(materialize(alias_edges(pages, url, html), "aliases"))
    nodes = groups.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    verdicts = judge(nodes, rules, "node").join(nodes.select("node", "component"), "node")
    blocked = (
        verdicts.groupBy("component")
        .agg(F.max(F.col("rule_verdict") == "allow").alias("allowed"))
        .filter("NOT allowed")
        .join(nodes.select("node", "component"), "component")
        .select(F.col("node").alias(place), F.lit(True).alias(bad))
    )
    alias = materialize(blocked, "blocked")
    rows = plain.withColumn(place, address_of(F.col(raw))).join(ruled, raw, "left").join(alias, place, "left")
    verdict = F.coalesce(said, F.when(F.col(bad), "block").otherwise("allow"))
    return rows.select(
        *kept,
        host_of(F.col(raw)).alias("host"),
        path_of(F.col(raw)).alias("path"),
        F.col(best).alias("rule"),
        verdict.alias("verdict"),
    )
