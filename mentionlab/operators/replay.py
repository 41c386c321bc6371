"""Replay of segment files: uniform event times (T7) and paced sending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlab.functions.times import SEGMENT_MINUTES, millis
from mentionlab.plans.ranking import number_rows


def spread_timestamps(lines: DataFrame, segment_col: str, start: Column, order_col: str,
                      interval_minutes: int = SEGMENT_MINUTES) -> DataFrame:
    """Line ``i`` of ``n`` in a segment gets ``start + i * floor(interval / n)`` (milliseconds).

    ``i`` comes from ``number_rows``: a big segment is numbered by many tasks.
    An empty segment has no lines and so no output (the reference fails on it).
    """
    step = F.floor(F.lit(interval_minutes * 60_000) / F.col("_n")).cast("bigint")
    numbered = number_rows(lines.withColumn("_start_ms", millis(start)), [segment_col],
                           [F.col(order_col)], out="_i", size_col="_n")
    return numbered.withColumn("ms", F.col("_start_ms") + F.col("_i") * step).drop("_start_ms", "_i", "_n")


def replay_schedule(lines: DataFrame, segment_col: str, order_col: str,
                    interval_seconds: int = SEGMENT_MINUTES * 60) -> DataFrame:
    """Second (from the segment start) in which each line is sent, spread exactly by rank."""
    numbered = number_rows(lines, [segment_col], [F.col(order_col)], out="_i", size_col="_n")
    second = F.floor(F.col("_i") * F.lit(interval_seconds) / F.col("_n")).cast("bigint")
    return numbered.withColumn("send_second", second).drop("_i", "_n")
