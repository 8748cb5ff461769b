"""Connected components of a table of links, by large-star and small-star rounds (union-find as joins)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwatch.llm.store import saved


def _is_stars(edges: DataFrame) -> bool:
    """Whether every id points at one id that points nowhere. Rounds keep what is connected, so this is the end."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("out")).unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("out")))
    of = ends.groupBy("id").agg(F.sum("out").alias("out"), F.min("out").alias("least"))
    return of.where("out > 1 or (out = 1 and least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """id and component (least id reachable) of every id in `links` (a, b); ids without links are not in the result.

    Each round points neighbours at the least one they know of. The rounds grow with the logarithm of the longest
    path, each is written to the shared folder, and only counts reach the driver. A hub's long list of neighbours is
    one side of a join against one row per id, which is split where it is skewed.
    """
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _is_stars(edges):
        # large star: the larger neighbours of u go to the least of u and its neighbours
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = large.distinct()
        # small star: the smaller neighbours of u, and u, go to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
