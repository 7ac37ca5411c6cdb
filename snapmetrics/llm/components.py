"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmetrics.llm.common import stored


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _least(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each ``a``, combined before the shuffle and
    written, so that the join back may split a hub's edges."""
    return stored(edges.groupBy("a").agg(F.min("b").alias("least")), "least")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); a component is
    named by its smallest node.

    Alternating large-star and small-star steps hang every node from smaller
    ones until each hangs from the smallest of its component; the number of
    rounds grows with the logarithm of the longest chain.  Edges are written
    to the shared folder each round; only a count and a checksum reach the
    driver.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Larger neighbours hang from the smallest of the node and its neighbours.
        large = both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        large = stored(large.distinct(), "edges")
        # The node and its smaller neighbours hang from the smallest of them.
        small = large.join(_least(large), "a")
        hung = small.select("a", F.col("least").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("least").alias("b")))
        edges = stored(hung.where("a <> b").distinct(), "edges")
        last, state = state, _state(edges)
        if last == state:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
