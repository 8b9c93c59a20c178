"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.llm.store import removed, stored




def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component): each linked node with the smallest node it reaches; null ends and links
    of a node with itself are left out, repeated links count once.

    Large-star links each node's larger neighbours to the smallest in its neighbourhood;
    small-star does so with the smaller ones and itself. Both find the smallest by an
    aggregation and join it back to the links, so no node's neighbours are gathered. Every round is
    written, and the rounds end when one leaves the links as they were; their number grows with the
    logarithm of the links.
    """
    spark = links.sparkSession
    ends = [F.col(left).alias("u"), F.col(right).alias("v")]
    edges, folder = stored(
        links.where(F.col(left) != F.col(right))
        .select(F.greatest(*ends).alias("u"), F.least(*ends).alias("v")).distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("v"))
        least = nearest.select("u", F.least("u", "v").alias("m"))
        # the larger neighbours v of u go to the smallest around u
        large = (both.where("v > u").join(least, "u").where("v != m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_least, "u").where("v != m").select(F.col("v").alias("u"),
                                                                    F.col("m").alias("v"))
                 .unionByName(small_least.select("u", F.col("m").alias("v"))).distinct())
        following, place = stored(small, "links")
        removed(spark, folder)
        edges, folder = following, place
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
    return row[0], row[1]
