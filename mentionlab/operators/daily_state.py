"""T1 over S8: daily top-k that is kept up to date as segments arrive.

The counts per (day, topic) are a stored table, bucketed by a key made of both.  An update
counts the new segments only, lays these counts out in the same buckets and joins them to the
stored ones bucket by bucket: the stored side is read where it lies and goes through no
exchange.  The result is the next generation of the table, written by the tasks of the join, a
bucket each.  Only the days that the new segments touch are ranked again; their ranks are appended
to a merge-on-read table (:mod:`mentionlab.streaming.deltas`).

A manifest per update names its generation and the last segment it has seen.  An update that runs again
reads the manifest before it, so it leaves the same tables; generations two updates back are deleted.
A null day or topic is a day or topic of its own, as in ``daily_topk``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.functions.times import DEFAULT_LAST_SEGMENT
from mentionlab.operators.topk import DEFAULT_K, mention_counts, rank_topics
from mentionlab.plans.ranking import broadcast_if_small, stable
from mentionlab.streaming.deltas import DeltaTable, delete, read_json, write_json

COUNTS_SCHEMA = "key STRING, date DATE, topic STRING, count LONG"
RANKED_SCHEMA = "date DATE, rank LONG, topic STRING, count LONG"
MAX_DAYS = 100_000


def _key():
    """Text that tells days and topics apart, nulls included."""
    return F.concat_ws("|", F.coalesce(F.col("date").cast("string"), F.lit("-")),
                       F.coalesce(F.concat(F.lit("s"), F.col("topic")), F.lit("n")))


class DailyTopk:
    """Stored counts and ranks under ``base``; ``buckets`` is fixed for a store."""

    def __init__(self, base: str, k: int = DEFAULT_K, buckets: int = 64):
        self.base, self.k, self.buckets = base.rstrip("/"), k, buckets
        self.ranked = DeltaTable(f"{self.base}/ranked", RANKED_SCHEMA, ["date", "rank"])

    # ---------------------------------------------------------------- stored state
    def _manifest_path(self, update: int) -> str:
        return f"{self.base}/updates/{update}.json"

    def manifest(self, spark: SparkSession, update: int) -> dict:
        if update < 0:
            return {"update": update, "generation": None, "last_segment": DEFAULT_LAST_SEGMENT}
        found = read_json(spark, self._manifest_path(update))
        if found is None:
            raise RuntimeError(f"{self.base} has no update {update}")
        return found

    def _folder(self, generation: int) -> str:
        return f"{self.base}/counts/generation={generation}"

    def _table(self, spark: SparkSession, generation: int) -> DataFrame:
        """The stored counts as a bucketed table (the catalogue of a new session doesn't know them yet)."""
        name = "mentionlab_counts_" + uuid.uuid5(uuid.NAMESPACE_URL, self._folder(generation)).hex
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
        spark.sql(f"CREATE TABLE {name} ({COUNTS_SCHEMA}) USING parquet CLUSTERED BY (key) INTO {self.buckets} BUCKETS "
                  f"LOCATION '{self._folder(generation)}'")
        return spark.table(name)

    def counts(self, spark: SparkSession, update: int) -> DataFrame:
        generation = self.manifest(spark, update)["generation"]
        return spark.createDataFrame([], COUNTS_SCHEMA) if generation is None else self._table(spark, generation)

    # ---------------------------------------------------------------- updates
    def merged(self, spark: SparkSession, new: DataFrame, update: int) -> DataFrame:
        """The counts after ``update``; ``new`` are the counts of its mentions."""
        fresh = new.withColumn("key", _key()).repartition(self.buckets, "key").select(
            "key", F.col("date").alias("_date"), F.col("topic").alias("_topic"), F.col("count").alias("_count"))
        before = self.counts(spark, update - 1)
        return before.join(fresh, "key", "full_outer").select(
            "key", F.coalesce("date", "_date").alias("date"), F.coalesce("topic", "_topic").alias("topic"),
            (F.coalesce("count", F.lit(0)) + F.coalesce("_count", F.lit(0))).alias("count"),
            F.col("_count").isNotNull().alias("_new"))

    def update(self, spark: SparkSession, mentions: DataFrame, update: int, last_segment: str | None = None) -> None:
        """Merges the mentions of new segments (``update`` counts from 0)."""
        before = self.manifest(spark, update - 1)
        new = stable(mention_counts(mentions))
        rows = self.merged(spark, new, update).drop("_new")
        name = "mentionlab_counts_" + uuid.uuid5(uuid.NAMESPACE_URL, self._folder(update)).hex
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        rows.write.mode("overwrite").format("parquet").bucketBy(self.buckets, "key") \
            .option("path", self._folder(update)).saveAsTable(name)
        days = broadcast_if_small(new.select(F.col("date").alias("_day")).distinct(), MAX_DAYS)
        table = self._table(spark, update)
        touched = table.join(days, table["date"].eqNullSafe(days["_day"]), "left_semi")
        self.ranked.append(spark, rank_topics(touched, self.k).select("date", "rank", "topic", "count"), update)
        write_json(spark, self._manifest_path(update), {
            "update": update, "generation": update, "last_segment": last_segment or before["last_segment"]})
        if update > 1:
            delete(spark, self._folder(update - 2))
            delete(spark, self._manifest_path(update - 2))

    def pick_up(self, spark: SparkSession, segments: str, update: int, name_rule: str = "head") -> str:
        """Merges the segment files newer than the last one seen, and returns the newest name."""
        from mentionlab.operators.mentions import mentions_from_text
        from mentionlab.sources.segments import read_new_segments
        last = self.manifest(spark, update - 1)["last_segment"]
        lines = read_new_segments(spark, segments, last)
        newest = lines.agg(F.max("segment")).first()[0] or last
        self.update(spark, mentions_from_text(lines, name_rule), update, newest)
        return newest

    def top(self, spark: SparkSession, update: int) -> DataFrame:
        """``(date, topic, count, rank)`` after ``update``."""
        return self.ranked.read(spark, update)[0].select("date", "topic", "count", "rank")
