"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.session import free, stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has an edge; component is the smallest node that can be reached.

    Large-star hooks each node's larger neighbours to its smallest one, small-star hooks the smaller ones; a chain of
    n nodes folds in about log2(n) rounds. Each round is written out, so a lost executor costs one round at most. Null
    ends are ignored; a loop edge makes its node a component of one.
    """
    pairs = stage(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null"))
    loops = pairs.where("x = y").select(F.col("x").alias("u"))
    now = pairs.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
    nodes = pairs.select(F.col("x").alias("u")).union(pairs.select(F.col("y").alias("u"))).union(loops).distinct()
    last, before = None, []
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        star = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = star.groupBy("u").agg(F.min("v").alias("m"))
        small = star.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        if before:
            free(*before)
        before = [now]
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == last:
            break
        last = mark
    top = now.groupBy("u").agg(F.min("v").alias("v"))
    return nodes.join(top, "u", "left").select(F.col("u").alias("node"), F.coalesce("v", "u").alias("component"))
