"""Connected components of a distributed link table (alternating large-star / small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ruleweave.llm.stage import dropped, staged


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable. `links` has two bigint columns u, v.

    Each round replaces every link by one to a smaller neighbour; rounds are staged in the shared
    folder and compared by row count and an order-free checksum, so only two numbers reach the
    driver. No round is broadcast: staged links take far less room than links in memory. Self links and
    repeated links are harmless; an empty table gives an empty result.
    """
    current = staged(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                     .distinct(), "links")
    mark = _mark(current)
    while mark[0]:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.hint("merge").join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.hint("merge").join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v")).distinct()
        after = staged(small, "links")
        new = _mark(after)
        dropped(current)
        current = after
        if new == mark:
            break
        mark = new
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
