"""Connected components of an edge list, by alternating star operations on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colophon.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its least neighbour (or itself)."""
    both = edges.select(F.col("u").alias("n"), F.col("v").alias("m")).unionByName(edges.select(F.col("v").alias("n"), F.col("u").alias("m")))
    least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("low"))
    return both.join(least, "n").where("m > n").select(F.col("m").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("n"), F.least("u", "v").alias("m"))
    least = down.groupBy("n").agg(F.min("m").alias("low"))
    moved = down.join(least, "n").select(F.col("m").alias("u"), F.col("low").alias("v"))
    own = least.select(F.col("n").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether each larger end has one edge only and no smaller end is a larger one elsewhere: then all is told."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an edge; component is the least node of it.

    Null ends and loops are left out; repeated edges don't matter; an empty edge list gives an empty result. The rounds
    grow with the logarithm of the largest component; each is written to the shared folder, so a lost executor costs one
    round at most. The algorithm is the public large-star/small-star scheme.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    e = materialize(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    for _ in range(max_rounds):
        if _are_stars(e):
            break
        e = materialize(_small_star(_large_star(e)), "cc")
    else:
        raise RuntimeError("components did not settle")
    own = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own.select("node", F.col("node").alias("component")))
