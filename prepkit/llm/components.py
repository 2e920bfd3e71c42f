"""Connected components of a graph given as a frame of edges, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest of them: the larger ones of each node (``large``), or the smaller ones and itself."""
    if large:
        sides = edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    else:
        sides = edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
    least = sides.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("low"))
    joined = sides.join(least, "x")
    if large:
        moved = joined.where("y > x").select(F.col("y").alias("x"), F.col("low").alias("y"))
    else:
        moved = joined.select(F.col("y").alias("x"), F.col("low").alias("y")).unionByName(
            least.select("x", F.col("low").alias("y")))
    return moved.where("x <> y").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (x, y): the smallest node it is connected with.

    Every round is written to the shared folder. Rounds grow with the logarithm of the longest path.
    """
    now = stored(edges.where("x <> y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum((F.xxhash64("x", "y") % 1_000_000_007)).alias("sum")).first()
        if mark == seen:
            break
        seen = mark
        now = stored(_star(_star(now, True), False), "links")
    roots = now.select(F.col("x").alias("node"), F.col("y").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
