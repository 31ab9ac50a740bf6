"""Connected components of a link table, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of any order and repetition: (node, component) for every node in a link, where
    component is the smallest node reachable.

    Every round joins links with the least neighbour of one end, which partial aggregation finds
    also for a node with very many links, and writes the new links to shared storage. Rounds end
    when a round leaves the links as they were; their number grows with the logarithm of the links.
    """
    state = stored(_forward(links), "links")
    seen = _mark(state)
    while seen[0]:
        state = stored(_small_star(_large_star(state)), "links")
        now = _mark(state)
        if now == seen:
            break
        seen = now
    stars = state.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.union(state.select("a", "a").distinct())


def _forward(links: DataFrame) -> DataFrame:
    """Each link once, its smaller end first."""
    return (
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    ).distinct()


def _mark(state: DataFrame) -> tuple:
    row = state.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return row[0], row[1]


def _large_star(state: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to its least neighbour."""
    both = state.union(state.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return _forward(both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b"))


def _small_star(state: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, move to the least of them."""
    down = state.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return _forward(moved.union(least.select(F.col("m"), F.col("u"))))
