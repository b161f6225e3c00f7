"""Connected components of an edge table, by joins and aggregates alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.session import materialize


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b): the smallest node each can reach.

    Two steps in turn until nothing changes: every node's larger neighbours are
    linked to its smallest neighbour, then its smaller ones are.  Each round
    halves the depth of the trees at least, so rounds grow with the logarithm of
    the longest path.  Neighbour minima are partial aggregates, and the joins back
    are plain equality joins, so a hub with many links is split by adaptive
    execution.  Each round is a written table; nothing but counts reaches the
    driver.  Loops and repeated edges are allowed, null ends are dropped, and no
    edges give no rows.
    """
    links = materialize(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u > v")
        .distinct(),
        "links",
    )
    state = _state(links)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _linked(both, larger_only=True)
        both = large.select("u", "v")
        small = materialize(_linked(both, larger_only=False), "links")
        links, before, state = small, state, _state(small)
        if state == before:
            break
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("v", "v"))


def _state(links: DataFrame) -> tuple:
    """Number of links and the sum of their digests; equal for equal tables."""
    digest = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(links.agg(F.count("*"), F.sum(digest)).first())


def _linked(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Link neighbours of each node to the smallest of the node and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = pairs.join(least, "u")
    if larger_only:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return out.filter("u > v").distinct()
