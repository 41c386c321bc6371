"""Change logs of a histogram: top-100 differences, coalescing, application.

These are the batch forms; ``mentionlab.streaming.top100`` runs the same functions
inside ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlab.operators.histogram import top_entries

TOP_N = 100


def top_changes(previous: DataFrame, current: DataFrame, n: int = TOP_N) -> DataFrame:
    """Messages turning the top ``n`` of ``previous`` into the top ``n`` of ``current``.

    New or changed entries carry their count, entries that left carry 0.  Both sides are
    at most ``n`` rows, so the full outer join is bounded.
    """
    prev = top_entries(previous, n).select("name", F.col("count").alias("_old"))
    cur = top_entries(current, n).select("name", F.col("count").alias("_new"))
    cur = cur.withColumnRenamed("name", "_name")
    both = prev.join(cur, F.col("name").eqNullSafe(F.col("_name")), "full_outer") \
        .withColumn("name", F.coalesce("name", "_name"))
    changed = F.col("_new").isNotNull() & (F.col("_old").isNull() | (F.col("_old") != F.col("_new")))
    gone = F.col("_new").isNull()
    return both.filter(changed | gone).select(
        "name", F.when(gone, F.lit(0).cast("bigint")).otherwise(F.col("_new")).alias("count"))


def latest_per_name(updates: DataFrame, bucket_col: str, name_col: str = "name",
                    count_col: str = "count", seq_col: str = "seq") -> DataFrame:
    """Inside one send interval the last update of a name wins."""
    return updates.groupBy(bucket_col, F.col(name_col).alias("name")).agg(
        F.max_by(count_col, seq_col).alias("count"))


def apply_changelog(changes: DataFrame, name_col: str = "name", count_col: str = "count",
                    seq_col: str = "seq") -> DataFrame:
    """The materialised histogram: last value per name, 0 deletes."""
    last = changes.groupBy(F.col(name_col).alias("name")).agg(F.max_by(count_col, seq_col).alias("count"))
    return last.filter(F.col("count") != 0)


def apply_increments(increments: DataFrame, name_col: str = "name", inc_col: str = "increment") -> DataFrame:
    """Increments add up per name."""
    return increments.groupBy(F.col(name_col).alias("name")).agg(F.sum(inc_col).cast("bigint").alias("count"))


def change_message(changes: DataFrame) -> DataFrame:
    """K5/K6: one JSON array ``[{"name","count"}]`` (JSON-escaped; bounded by the top-n size)."""
    return changes.agg(F.to_json(F.sort_array(F.collect_list(F.struct("name", "count"))))
                       .alias("message"), F.count(F.lit(1)).alias("entries"))
