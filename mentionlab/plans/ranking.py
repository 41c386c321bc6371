"""Skew-safe building blocks.

* :func:`number_rows` numbers rows inside groups (or over the whole frame) at any size,
  never moving a group into one task: a range shuffle spreads even a group holding a third
  of all rows over many partitions, each partition numbers its rows locally, and a small
  table of per-partition offsets (one row per group and partition) fixes the numbers up.
* :func:`broadcast_if_small` broadcasts a side only after proving its size bound,
  otherwise leaves the join to a shuffle (and AQE).
* :func:`stable` cuts lineage with a reliable checkpoint in the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionlab.session import checkpoint_root

_PID_SHIFT = 33  # monotonically_increasing_id puts the partition index in the upper 31 bits


def stable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """Broadcast hint only when ``df`` provably has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows; above the bound the hint is not
    given and the planner shuffles (AQE may still switch at run time on real sizes).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_rows(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column | str],
                out: str = "pos", size_col: str | None = None, base: int = 0) -> DataFrame:
    """Position of every row inside its group under ``order`` (ties broken by the order keys).

    ``order`` must make rows unique within a group for the numbers to be deterministic.
    ``size_col`` adds the group size.  Numbers start at ``base``; without group columns the
    whole frame is numbered.  The numbered rows are written once (see :func:`stable`), as
    their partition numbers must not change in a rerun.
    """
    groups = [F.col(g) for g in group_cols]
    keys = [*groups, *[_as_col(o) for o in order]]
    numbered = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                .withColumn("_mid", F.monotonically_increasing_id()))
    numbered = stable(numbered).withColumn("_pid", F.shiftright("_mid", _PID_SHIFT))
    # one row per (group, partition): at most groups + partitions rows
    pieces = numbered.groupBy(*group_cols, "_pid").agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(*group_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    if size_col:
        pieces = pieces.withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*group_cols)))
    pieces = pieces.drop("_cnt")
    if group_cols:
        cond = [numbered[g].eqNullSafe(pieces[g]) for g in group_cols] + [numbered["_pid"] == pieces["_pid"]]
        joined = numbered.join(pieces, cond).select(numbered["*"], pieces["_first"], pieces["_off"],
                                                     *([pieces[size_col]] if size_col else []))
    else:
        # one row per partition: the bound is the partition count
        joined = numbered.join(F.broadcast(pieces), "_pid")
    pos = (F.col("_off") + F.col("_mid") - F.col("_first") + F.lit(base)).cast("bigint")
    return joined.withColumn(out, pos).drop("_mid", "_pid", "_first", "_off")
