"""Connected components of a graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Workspace


def components(edges: DataFrame) -> DataFrame:
    """node, component: the least name among those that ``edges`` (a, b) join, whichever way they point.

    Each round hangs a node's larger neighbours, then its smaller ones, under its
    least neighbour (Kiveris and others, 2014); edges never grow in number, and
    rounds grow with the logarithm of the nodes. A node that stands only in an edge
    to itself is a component of its own; edges with a null are left out.
    """
    with Workspace(edges.sparkSession, "components") as space:
        given = edges.where("a is not null and b is not null").select("a", "b")
        nodes = given.select(F.col("a").alias("node")).unionByName(given.select(F.col("b").alias("node"))).distinct()
        now = space.store(given.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        mark = None
        while True:
            both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
            least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
            large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct()
            down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            under = down.groupBy("a").agg(F.min("b").alias("low"))
            small = down.join(under, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("x")).select("x.*")
            now = space.store(small.where("a != b").distinct())
            told = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")).first()
            if told == mark:
                break
            mark = told
        return space.keep(nodes.join(now.select(F.col("a").alias("node"), "b"), "node", "left").select("node", F.coalesce("b", "node").alias("component")))
