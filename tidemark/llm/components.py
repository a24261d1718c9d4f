"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import discard, materialize


def _mark(edges: DataFrame) -> tuple[int, int, int]:
    """Number of edges and two checks of their set, by XOR, which can't overflow however many there are."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.bit_xor(F.xxhash64("v", F.lit(1), "u")).alias("y")).first()
    return row["n"], row["x"] or 0, row["y"] or 0


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node with an edge, the smallest node that it reaches.

    edges: bigint columns u, v in any direction, repeats and loops allowed. Each round links every neighbour of a node to the
    node's smallest neighbour, by aggregation and join alone, so a star of any size is pre-aggregated and never gathered.
    """
    spark = edges.sparkSession
    now, path = materialize(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(smallest, "u")
        star = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
        after, new = materialize(star, "stars")
        after_mark = _mark(after)
        discard(spark, path)
        now, path = after, new
        if after_mark == mark:
            break
        mark = after_mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
