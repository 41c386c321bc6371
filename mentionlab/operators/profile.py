"""Diagnostic preview of a frame as rows ``(metric, value)`` computed in one job (K7, A4, A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mentions_profile(mentions: DataFrame) -> DataFrame:
    """Counts, null counts, distinct topics and the date range of a mentions frame."""
    stats = mentions.agg(
        F.count(F.lit(1)).cast("string").alias("rows"),
        F.count_if(F.col("date").isNull()).cast("string").alias("null_dates"),
        F.count_if(F.col("topic").isNull()).cast("string").alias("null_topics"),
        F.count_distinct("topic").cast("string").alias("topics"),
        F.count_distinct("record_id").cast("string").alias("records"),
        F.min("date").cast("string").alias("first_date"),
        F.max("date").cast("string").alias("last_date"),
    )
    names = ["rows", "null_dates", "null_topics", "topics", "records", "first_date", "last_date"]
    return stats.unpivot([], names, "metric", "value")


def with_row_count(df: DataFrame, name: str = "rows"):
    """A4 without a second job: attach an observation; read it after the action that runs ``df``.

    Returns ``(observed_df, observation)``; ``observation.get[name]`` is the row count.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs
