"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backdrop.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links every node's larger (or not larger) neighbours to the smallest of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else links
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    near = both.join(least, F.col("a") == F.col("u")).withColumn("m", F.least("m", "a"))
    if large:
        made = near.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = near.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return made.where(F.col("a") > F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b) but the roots: the smallest node of its component.

    Large and small stars alternate until nothing changes, in a number of
    rounds that grows with the logarithm of the longest path. A hot node is
    pre-aggregated, and its links are split by the skew join. Every round is a
    stored table.
    """
    spark = links.sparkSession
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    now, said = stored(spark, now, "links"), None
    while True:
        now = stored(spark, _star(_star(now, True), False), "stars")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == said:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        said = new
