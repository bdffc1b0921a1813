"""Connected components of a graph given as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.sources.shared import share


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges go from the larger to the smaller end."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    others = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """``a`` and ``b``, the smallest node that ``a`` reaches, for all nodes but those smallest themselves.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type. Large and small stars take turns until
    nothing changes: each node's neighbours are tied to the smallest of them, so no step makes more edges than
    it read, whatever a node's degree, and the number of steps grows with the logarithm of the longest
    path. Each step is written to the shared folder, so a lost executor costs one step.
    """
    ends = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    current = share(ends, "edges")
    while True:
        following = share(_small_star(_large_star(current)), "edges")
        if _mark(following) == _mark(current):
            return following
        current = following


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, and for others only by a chance of about 1 in 2**60."""
    hashed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(hashed), F.sum(F.shiftright(hashed, 24))).first())
