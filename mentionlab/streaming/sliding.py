"""Histogram of names over a sliding hour with a watermark.

``window(ts, 1 hour, slide)`` assigns each mention to ``width / slide`` windows (Expand),
then ``groupBy(window, name).count()`` aggregates partially before the shuffle, so a hot
name is combined on the map side.  A 5-second slide would multiply rows 720-fold; use the
exact per-event form in :mod:`mentionlab.streaming.trailing` for that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlab.functions.times import micros


def sliding_counts(mentions: DataFrame, width: str = "1 hour", slide: str = "5 minutes",
                   ts_col: str = "ts", name_col: str = "name") -> DataFrame:
    """``(ws BIGINT micros, name, count)`` per window start and name."""
    w = F.window(F.col(ts_col), width, slide)
    return (mentions.groupBy(w.alias("w"), F.col(name_col).alias("name"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(micros(F.col("w.start")).alias("ws"), "name", "count"))


def sliding_counts_stream(mentions: DataFrame, width: str = "1 hour", slide: str = "5 minutes",
                          lateness: str = "1 hour", ts_col: str = "ts", name_col: str = "name") -> DataFrame:
    """Streaming form: the watermark bounds state and drops rows later than ``lateness``."""
    return sliding_counts(mentions.withWatermark(ts_col, lateness), width, slide, ts_col, name_col)
