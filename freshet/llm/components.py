"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.session import stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than a node is tied to the smallest node around."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("_m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("_m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` for every node of ``edges`` (``a``, ``b``) but the smallest of each component.

    The component is the smallest id reachable. Rows with a null end are passed
    over; loops and repeated edges do no harm. Minima are combined before the
    shuffle, so a node with a third of all edges is no heavier than another.
    """
    ends = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = stored(ends.distinct(), "edges")
    mark = _fingerprint(now)
    while True:
        now = stored(_small_star(_large_star(now)), "edges")
        before, mark = mark, _fingerprint(now)
        if mark == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
