"""Connected components of links between documents, by rounds of joins on tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.session import freeze


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u").filter("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    handed = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return handed.union(least.select("u", F.col("m").alias("v"))).distinct()


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    counted = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counted.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every linked node: ``root`` is the smallest node it is connected with.

    Large and small stars alternate until the edges are a star around each root. A chain
    of n links takes about log n rounds. A node with very many links is grouped by
    partial minima, and its rows are split by adaptive execution in the joins. No link
    reaches the driver.
    """
    edges = freeze(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct(), "edges")
    while not _is_forest_of_stars(edges):
        edges = freeze(_small_star(freeze(_large_star(edges), "large-star")), "small-star")
    roots = edges.select(F.col("v").alias("node")).distinct()
    found = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return freeze(found.union(roots.select("node", F.col("node").alias("root"))), "roots")
