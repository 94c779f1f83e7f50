"""Connected components of a link table by alternating star contractions.

Each round points every node at the smallest node it knows of; the number of
rounds grows with the logarithm of the longest path. Links stay in tables of the
shared folder, only one number a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import staged

MAX_ROUNDS = 60


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links run from the larger (a) to the smaller (b) node here."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a > b")
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def components(spark: SparkSession, links: DataFrame, path: str) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)`` (a != b): the smallest node it can reach."""
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    now, seen = staged(spark, pairs, f"{path}/links"), None
    for turn in range(MAX_ROUNDS):
        now = staged(spark, _small_star(_large_star(now).distinct()), f"{path}/turn-{turn}")
        mark = now.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
