"""Connected components by alternating stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b): the smallest node it can reach.

    Large star: every node hands the least node around it to its larger neighbours; small star: to
    its smaller ones. The edges shrink to one star a component in about log(n) rounds. Minima are combined
    map-side and written to the shared folder, like each round's edges: lineage stays short, and the joins
    of edges with minima are between two plain shuffles, so that Spark splits a hub's many edges over tasks.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = stored((both.filter("b > a").join(least, "a")
                        .select(F.col("b").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct(), "large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = (large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                              F.struct(F.greatest("b", "m").alias("a"),
                                       F.least("b", "m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a <> b").distinct())
        now = stored(small, "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
