"""W10 on a stream: running totals of increments per name (update mode), and the poll trigger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from mentionlab.operators.changes import apply_increments
from mentionlab.streaming.deltas import EVERY, DeltaTable

SEGMENT_POLL = "15 minutes"


def running_totals(increments: DataFrame, name_col: str = "name", inc_col: str = "increment") -> DataFrame:
    """Streaming aggregate; write with ``outputMode("update")`` to get one change per name per batch."""
    return apply_increments(increments, name_col, inc_col)


def poll_trigger(writer, every: str = SEGMENT_POLL):
    """Re-scan the source each interval (or run ``availableNow`` from an outside scheduler)."""
    return writer.trigger(processingTime=every)


class CurrentTable:
    """``foreachBatch`` sink for update-mode output: the newest row of every key.

    A batch holds at most one row per key, and only these rows are written: the table is merged
    on read from a base and the batches since (:class:`mentionlab.streaming.deltas.DeltaTable`).
    """

    def __init__(self, base: str, schema: str, keys: Sequence[str], every: int = EVERY):
        self.table = DeltaTable(base, schema, keys, every=every)

    def __call__(self, changes: DataFrame, batch_id: int) -> None:
        self.table.append(changes.sparkSession, changes, batch_id)

    def current(self, spark: SparkSession) -> DataFrame:
        return self.table.latest(spark)[1]
