"""W2b-W5 as micro-batches: exact trailing-hour counts that stay right for silent names.

``foreachBatch`` counts each batch's mentions against those of the last window (plus
lateness) kept from earlier batches, with
:func:`mentionlab.operators.histogram.trailing_counts`: no task holds a whole name.  The
kept mentions are an appended log (:mod:`mentionlab.streaming.deltas`): a batch writes its own
mentions, and every so many batches the log is compacted to the window.

Stream time is the newest mention time seen in the whole stream.  Updates of a batch:

* ``arrival``: a mention at ``t`` with the count of its name in ``(t - 1 hour, t]``;
* ``late``: a mention older than stream time less the lateness; it isn't logged, and
  carries its name's count at stream time (W3: none vanishes without an update);
* ``expire``: a name that lost mentions since the stream time of the batch before, with its
  count at the new stream time (0: it leaves the histogram), stamped with that time (W4);
* ``level``: likewise for a name whose mentions came out of order, as their own counts hold
  at earlier times.

The last update of every name (by ``us``; ``expire`` and ``level`` last) is then its count
in the hour that ends at stream time (W9).  Mentions without a time are left out; null names count as
one name.  A batch without rows keeps everything as it is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.functions.times import micros
from mentionlab.operators.histogram import HOUR_US, trailing_counts
from mentionlab.streaming.deltas import DeltaTable

RECENT_SCHEMA = "event_id LONG, name STRING, us LONG"
UPDATE_SCHEMA = "event_id LONG, name STRING, count LONG, us LONG, kind STRING"


class TrailingHourBatches:
    """Sink for ``(event_id, name, ts)`` mentions; ``then(updates, batch_id)`` gets each batch's updates."""

    def __init__(self, base: str, window_us: int = HOUR_US, lateness_us: int = HOUR_US,
                 then: Callable[[DataFrame, int], None] | None = None):
        self.base = base.rstrip("/")
        self.window_us = window_us
        self.lateness_us = lateness_us
        self.then = then
        self.recent = DeltaTable(f"{self.base}/recent", RECENT_SCHEMA)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(F.col("event_id").cast("long").alias("event_id"), F.col("name").cast("string").alias("name"),
                            micros(F.col("ts")).alias("us")).filter(F.col("us").isNotNull())
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)  # the source is read once a batch
        try:
            self._count(spark, rows, batch_id)
        finally:
            rows.unpersist()
        if self.then:
            self.then(spark.read.schema(UPDATE_SCHEMA).parquet(self._updates(batch_id)), batch_id)

    def _updates(self, batch_id: int) -> str:
        return f"{self.base}/updates/batch={batch_id}"

    def _count(self, spark: SparkSession, rows: DataFrame, batch_id: int) -> None:
        recent, before = self.recent.read(spark, batch_id - 1)
        times = [t for t in (before, rows.agg(F.max("us")).first()[0]) if t is not None]
        if not times:  # no mention yet
            spark.createDataFrame([], UPDATE_SCHEMA).write.mode("overwrite").parquet(self._updates(batch_id))
            self.recent.append(spark, None, batch_id)
            return
        now = max(times)
        first = before is None
        us = F.col("us")
        if not first:  # the log keeps older ones until it is compacted
            recent = recent.filter(us > F.lit(before - self.window_us - self.lateness_us))
        late = F.lit(False) if first else us <= F.lit(before - self.lateness_us)
        fresh, old = rows.filter(~late), rows.filter(late)
        logged = recent.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True)))
        counts = trailing_counts(logged.withColumn("_ts", F.timestamp_micros("us")), "name", "_ts", "event_id",
                                 self.window_us, keep=("us", "_new"))
        arrivals = counts.filter("_new").select("event_id", "name", "count", "us", F.lit("arrival").alias("kind"))
        # one row per name: its count now, and whether the update of its last mention still says so
        counted_before = F.lit(False) if first else us > F.lit(before - self.window_us)
        gone = (us <= F.lit(now - self.window_us)) & (F.col("_new") | counted_before)
        behind = F.lit(False) if first else F.col("_new") & (us < F.lit(before))
        names = logged.groupBy("name").agg(F.count_if(us > F.lit(now - self.window_us)).alias("count"),
                                           F.bool_or(gone).alias("_gone"), F.bool_or(behind).alias("_behind"))
        closing = names.filter("_gone OR _behind").select(
            F.lit(None).cast("long").alias("event_id"), "name", "count", F.lit(now).cast("long").alias("us"),
            F.when(F.col("_gone"), "expire").otherwise("level").alias("kind"))
        here = names.select(F.col("name").alias("_name"), "count")
        lates = old.join(here, old["name"].eqNullSafe(here["_name"]), "left").select(
            "event_id", "name", F.coalesce("count", F.lit(0)).cast("long").alias("count"), "us",
            F.lit("late").alias("kind"))
        arrivals.unionByName(closing).unionByName(lates) \
            .write.mode("overwrite").parquet(self._updates(batch_id))
        self.recent.append(spark, fresh, batch_id, now, keep=us > F.lit(now - self.window_us - self.lateness_us))


def read_updates(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/updates")
