"""Connected components of a graph whose edges are a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.llm.tables import kept


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    onward = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return onward.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs of ids -> (node, component) for every node but the least of its component.

    Alternates the large-star and small-star steps until the edges stay the
    same. A step takes partial minima and joins them back by the node; the
    larger end of a link has few of them, as every step ties it to least nodes. Loops, repeated and reversed pairs do no harm; pairs
    with a null are left out. An empty input gives an empty result. Only two
    numbers per round reach the driver.
    """
    u, v = edges.columns
    now = kept(
        edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v)))
        .distinct(),
        "edges",
    )
    stamp = None
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == stamp or not found[0]:
            return now.toDF("node", "component")
        stamp = tuple(found)
        now = kept(_small_star(_large_star(now)), "stars")
