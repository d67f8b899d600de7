"""Connected components of a large graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def connected(edges: DataFrame) -> DataFrame:
    """node, comp: the smallest node reachable, for every node of `edges` (a, b: long).

    Alternates two steps until nothing changes: every node hands its larger neighbours, then
    its smaller ones, to the smallest node it knows. Each step is a minimum per node (summed
    on the map side, so a hub is no hot key) and a join back that AQE may split; the graph
    shrinks to stars in a number of rounds that grows with the logarithm of its size. Loops
    and repeated edges do no harm; without edges there are no rows.
    """

    def pairs(df):
        return df.where("u <> v").distinct()

    big = F.greatest("a", "b").alias("u")
    star = stored(pairs(edges.select(big, F.least("a", "b").alias("v"))), "edges")
    state = None
    while True:
        both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = pairs(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), "m")
                      .withColumnRenamed("m", "v"))
        large = stored(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        star = stored(pairs(small), "small-star")
        row = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            break
        state = tuple(row)
    roots = star.select(F.col("v").alias("node")).distinct()
    named = star.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return stored(named.unionByName(roots.withColumn("comp", F.col("node"))), "components")
