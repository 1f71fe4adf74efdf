"""Connected components of a link table, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likertlake.session import Workspace


def components(links: DataFrame, space: Workspace) -> DataFrame:
    """``node`` and ``root``, the least node reachable, for every end of a link ``a``, ``b``.

    Alternates two star contractions, each of which hands a node's neighbours to the
    least of them, until the links are stars. The rounds grow as the logarithm of the
    longest path. A node of very many links is only ever aggregated to a minimum and
    joined with that one row. Each round is written, so a lost executor costs a re-read.
    """
    edges = space.cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = space.cut(small.union(least).where("u <> v").distinct(), "stars")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node has either one edge down or only edges from above."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1))).groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return ends.where("down > 1 or down = 1 and up = 1").isEmpty()
