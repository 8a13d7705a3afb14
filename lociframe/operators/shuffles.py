"""Random permutations that every engine can repeat: the order of a digest of seed, shuffle and item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def mark(seed: int, *items: Column | str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(x).cast("string") if isinstance(x, str) else x.cast("string") for x in items]))


def permutations(spark: SparkSession, n: int, shuffles: int, seed: int = 1) -> DataFrame:
    """(shuffle, item, place): a random order of 0 to n - 1 for each shuffle. Its size is a parameter, not data."""
    rows = spark.range(shuffles).select(F.col("id").alias("shuffle"), F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>")).alias("item"))
    order = Window.partitionBy("shuffle").orderBy(mark(seed, "shuffle", "item"), "item")
    return rows.withColumn("place", F.row_number().over(order) - 1)
