"""Connected components of an edge table by alternating stars, in shuffled rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import remove_path, stage


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the smallest node.

    Large stars link every larger neighbour of a node to its smallest neighbour,
    small stars the smaller ones and the node itself, until nothing changes. Each
    star is one minimum per node and one join; a round's edges are written to the
    shared folder, so a lost executor repeats no earlier round.
    """
    spark = edges.sparkSession
    ordered = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    current, path = stage(ordered, "edges")
    mark = _mark(current)
    while mark[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, large_path = stage(large.distinct(), "edges")
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = large.join(small, "u").where(F.col("v") != F.col("m")).select(
            F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")
        )
        after, after_path = stage(linked.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        found = _mark(after)
        remove_path(spark, large_path)
        remove_path(spark, path)
        current, path = after, after_path
        if found == mark:
            break
        mark = found
    roots = current.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
