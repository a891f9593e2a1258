"""Connected components of links between ids, by alternating large-star and small-star steps.

A large-star step moves the larger neighbours of every node to its smallest neighbour, a small-star step the smaller ones
and the node itself; both keep the components. Repeated, they leave stars whose centre is the smallest id. A step is a
grouping with partial aggregates and a join that Spark can split at a hot node. Each round is written, so lost executors
cost one round at most, and nothing but a row count and a check sum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written


def _star(links: DataFrame, smallest: DataFrame) -> DataFrame:
    """links (u, v) with the node `u` whose smallest neighbour or self is `least`."""
    return links.join(smallest, "u")


def large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return _star(both, least).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()


def small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = _star(down, least).select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of every id that a link (u, v) names; the component is its smallest id. Links of a node to itself
    and nulls are ignored; direction and repetition do not matter."""
    current = links.select("u", "v").where("u is not null and v is not null and u <> v")
    before = None
    for _ in range(most_rounds):
        current = written(small_star(large_star(current)), "components")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if now == before or not now[0]:
            ids = current.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return ids.unionByName(current.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
        before = now
    raise RuntimeError(f"no fixed point in {most_rounds} rounds")
