"""Connected components of a graph of links, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.session import materialize


def _smallest(edges: DataFrame, key: str, other: str) -> DataFrame:
    return edges.groupBy(key).agg(F.min(other).alias("least"))


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root): each linked node with the smallest node it can reach; roots are among the nodes.

    Stars are contracted by turns: every node sends its larger neighbours to its smallest one,
    then its smaller neighbours there. Rounds end when only stars are left, after about
    log(nodes) of them. Each round is written to the shared folder. A node with very many
    neighbours is summed before the shuffle and joined by a join that Spark can split.
    """
    a, b = F.col(left), F.col(right)
    edges = links.where(a != b).select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct()
    edges = materialize(edges, "links")
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        # Large star: what is larger than v goes to the smallest of v and its neighbours.
        least = _smallest(both, "v", "u").withColumn("least", F.least("v", "least"))
        edges = (
            both.where("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("least").alias("u")).distinct()
        )
        # Small star: v and what is smaller go to the smallest.
        least = _smallest(edges, "v", "u")
        moved = edges.join(least, "v")
        edges = (
            moved.select(F.col("u").alias("v"), F.col("least").alias("u"))
            .unionByName(least.select("v", F.col("least").alias("u")))
            .where("v <> u")
            .distinct()
        )
        edges = materialize(edges, "stars")
        ends = edges.select(F.col("v").alias("x"), F.lit(1).alias("under"), F.lit(0).alias("over")).unionByName(
            edges.select(F.col("u").alias("x"), F.lit(0).alias("under"), F.lit(1).alias("over"))
        )
        ends = ends.groupBy("x").agg(F.sum("under").alias("under"), F.max("over").alias("over"))
        if ends.where("under + over > 1").isEmpty():
            break
    roots = edges.select(F.col("u").alias("node")).distinct()
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
