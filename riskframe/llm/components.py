"""Connected components of a link table, by alternating stars.

Each round points every vertex's larger neighbours at its smallest one, then does the same among
smaller neighbours (large star, small star). Rounds are grouped aggregations and joins on vertices,
with the link table written to shared storage between them; the driver only learns whether a
vertex is left that is not settled. A vertex with very many links is one row per task before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import materialize


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """Whether every vertex points at one vertex that points at none: nothing would move any more."""
    ends = edges.select(F.greatest("u", "v").alias("x"), F.lit(1).alias("points"), F.lit(0).alias("aimed")).union(
        edges.select(F.least("u", "v").alias("x"), F.lit(0).alias("points"), F.lit(1).alias("aimed")))
    seen = ends.groupBy("x").agg(F.sum("points").alias("points"), F.max("aimed").alias("aimed"))
    return seen.where("points > 1 or (points = 1 and aimed = 1)").isEmpty()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, label) of all vertices that have a link; label is the smallest vertex reached."""
    edges = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    while not _settled(edges):
        edges = materialize(_small_star(_large_star(edges)).distinct(), "links")
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("label")).union(
        edges.select(F.col("v").alias("vertex"), F.col("v").alias("label")).distinct())
