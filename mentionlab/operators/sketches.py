"""A8 kept as sketches: distinct articles per (day, topic) that merge over any range of days.

A count of distinct articles can't be added up over days, as an article may name a topic on several
of them.  A stored sketch can: the union of the days' sketches estimates the distinct articles
of the range, and no article is read again.  Sketches are built with map-side combine, a few kB for a
hot topic and a few bytes for a rare one, and stored by day, so a range reads its days only and
a day that is counted again replaces its folder.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 12


def relative_error(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """Error bound of a merged sketch relative to the exact number: 1.04 / sqrt(2^lg_k) is one sigma."""
    return sigmas * 1.04 / math.sqrt(2 ** lg_k)


def article_sketches(mentions: DataFrame, keys: Sequence[str] = ("date", "topic"), lg_k: int = LG_K) -> DataFrame:
    """``(*keys, sketch)`` of the distinct record ids (null ids count as none)."""
    return mentions.groupBy(*keys).agg(F.hll_sketch_agg("record_id", F.lit(lg_k)).alias("sketch"))


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser keys: ``("topic",)`` over days, ``("date",)`` over topics, none for all."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, out: str = "articles") -> DataFrame:
    """The sketch replaced by its estimate."""
    return sketches.withColumn(out, F.hll_sketch_estimate("sketch")).drop("sketch")


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Writes sketches by day; days already stored are replaced, others stay."""
    sketches.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("date").parquet(path)


def articles_between(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """``(topic, articles)`` estimated over the stored days from ``first`` to ``last``; other days aren't read."""
    days = spark.read.parquet(path).filter(F.col("date").between(F.to_date(F.lit(first)), F.to_date(F.lit(last))))
    return estimated(merged(days, ["topic"]))
