"""Connected components of a graph given as edges, by alternating stars, all as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equigauge.session import settle


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): every pair with the least of u and its partners. Partners combine before the shuffle."""
    least = pairs.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("partner")).select("of", F.least("of", "partner").alias("m"))
    return pairs.join(least, F.col("u") == F.col("of")).select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    downward = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _with_least(downward)
    tied = found.select(F.col("v").alias("u"), F.col("m").alias("v")).union(found.select("u", F.col("m").alias("v")))
    return tied.filter("u != v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node of `edges` (u, v, of one integer type) but the least.

    Each round hangs larger neighbours on the least one, then smaller ones, until nothing changes; rounds grow with the
    logarithm of the longest path. Every round is written to the shared folder. Hubs are split by Spark's skew joins.
    Nodes of NULL are dropped; loops and repeated edges do no harm.
    """
    now = settle(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before, now = state, settle(_small_star(_large_star(now)))
