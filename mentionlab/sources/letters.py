"""Letter pairs of the manual: letter ``a..z`` repeating beside ``1..n``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def letter_of(n: Column) -> Column:
    """Letter of the ``n``-th pair (1-based)."""
    return F.char(F.lit(97) + F.pmod(n - 1, F.lit(26)))


def letters(spark: SparkSession, n: int = 200000, slices: int = 20) -> DataFrame:
    """The manual's pairs, made in ``slices`` partitions without a driver-side list."""
    ids = spark.range(1, n + 1, numPartitions=slices)
    return ids.select(letter_of(F.col("id")).alias("chr"), F.col("id").alias("num"))


def letters_from(df: DataFrame, num: Column) -> DataFrame:
    """Pairs over any numbering column of a table."""
    return df.select(letter_of(num).alias("chr"), num.alias("num"))
