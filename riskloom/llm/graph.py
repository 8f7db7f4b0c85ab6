"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.workspace import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges (a, b)``; the root is the least node of its component.

    Large-star and small-star steps in turn: every node links its larger neighbours, then its smaller
    ones, to the least node it knows, until all edges lead to a root. Minima are combined before the
    shuffle and written, so that the edges of a hub can be split in the join.
    """
    spark = edges.sparkSession
    edges = written(spark, edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        roots = edges.select(F.col("b").alias("a")).distinct()
        if not edges.join(roots, "a", "left_semi").take(1):
            # every edge ends in a node without a smaller neighbour; one such node for each start?
            if not edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").take(1):
                break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(spark, both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = written(spark, large, "large-star")
        least = written(spark, large.groupBy("a").agg(F.min("b").alias("m")), "least")
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        edges = written(spark, small.filter("a <> b").distinct(), "small-star")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
