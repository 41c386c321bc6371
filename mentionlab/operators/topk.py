"""Counting and ranking topics per day.

The flagship :func:`daily_topk` is ``groupBy(date, topic).count()`` (partial then final
hash aggregate) followed by ``row_number() <= k`` over ``partitionBy(date)``.  Spark
plans a ``WindowGroupLimit`` on both sides of the window's shuffle, so a day with
millions of topics moves only ``k`` rows per map partition: a hot day never lands
whole in one task, unlike the reference's ``collect_list`` per day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionlab.plans.ranking import broadcast_if_small

DEFAULT_K = 10


def mention_counts(mentions: DataFrame, keys: Sequence[str] = ("date", "topic")) -> DataFrame:
    """A1/A2: mentions per key (map-side combined)."""
    return mentions.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def article_counts(mentions: DataFrame) -> DataFrame:
    """Articles (distinct records) naming each topic per day."""
    return mentions.groupBy("date", "topic").agg(F.count_distinct("record_id").alias("articles"))


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``1..k`` per group by ``order`` (deterministic when ``order`` is total)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= k)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def rank_topics(counts: DataFrame, k: int = DEFAULT_K, group: Sequence[str] = ("date",)) -> DataFrame:
    """By count descending, ties by topic ascending."""
    return top_k_per_group(counts, group, [F.col("count").desc(), F.col("topic").asc()], k)


def daily_topk(mentions: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """``(date, topic, count, rank)``, ``rank <= k``."""
    return rank_topics(mention_counts(mentions), k).select("date", "topic", "count", "rank")


def daily_topk_articles(mentions: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """T1 in article mode (A8): a topic counts once per article that names it."""
    counts = article_counts(mentions).withColumnRenamed("articles", "count")
    return rank_topics(counts, k).select("date", "topic", "count", "rank")


def exclude_topics(counts: DataFrame, stoplist: DataFrame, topic_col: str = "topic",
                   max_stoplist_rows: int = 1_000_000) -> DataFrame:
    """Anti-join with a stoplist; broadcast only below the checked size bound."""
    stop = stoplist.select(F.col(stoplist.columns[0]).alias("_stop")).distinct()
    stop = broadcast_if_small(stop, max_stoplist_rows)
    return counts.join(stop, counts[topic_col] == stop["_stop"], "left_anti")


def daily_topk_without(mentions: DataFrame, stoplist: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    counts = exclude_topics(mention_counts(mentions), stoplist)
    return rank_topics(counts, k).select("date", "topic", "count", "rank")


def topk_pivot(topk: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """T5: the i-th topic of each day as column ``r{i}`` (explicit values: no extra job)."""
    wide = topk.groupBy("date").pivot("rank", list(range(1, k + 1))).agg(F.max("topic"))
    return wide.select("date", *[F.col(str(i)).alias(f"r{i}") for i in range(1, k + 1)])


def date_extent(df: DataFrame, date_col: str = "date") -> DataFrame:
    """First and last date (one partial aggregate per partition)."""
    return df.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))


def date_spine(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Every day from the first to the last date of ``df`` (size bound: the time span)."""
    return date_extent(df, date_col).select(
        F.explode(F.sequence("first_date", "last_date", F.expr("INTERVAL 1 DAY"))).alias(date_col))


def spine_topics(topk: DataFrame, k: int = DEFAULT_K) -> DataFrame:
    """``k`` label rows for every day of the span; a missing day or rank gives ``''``."""
    slots = date_spine(topk).select("date", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank")) \
        .withColumn("rank", F.col("rank").cast("bigint"))
    labels = topk.select("date", "rank", "topic")
    return (slots.join(labels, ["date", "rank"], "left")
            .select("date", "rank", F.coalesce("topic", F.lit("")).alias("topic")))


def daily_documents(topk: DataFrame) -> DataFrame:
    """K2: one nested document per day, ``{"data": date, "result": [{topic, count}]}`` in rank order.

    The list per day is at most ``k`` entries, so the collect is bounded.
    """
    entries = F.sort_array(F.collect_list(F.struct("rank", "topic", "count")))
    return (topk.groupBy("date")
            .agg(entries.alias("_e"))
            .select(F.date_format("date", "yyyy-MM-dd").alias("data"),
                    F.arrays_zip(F.col("_e")["topic"].alias("topic"),
                                 F.col("_e")["count"].alias("count")).alias("result")))


def top_ten_rows(topk: DataFrame) -> DataFrame:
    """The reference's committed result shape, for existing readers:
    ``(date TIMESTAMP, topTenTopics ARRAY<STRUCT<_1 STRING, _2 INT>>)`` in rank order."""
    entries = F.sort_array(F.collect_list(F.struct("rank", "topic", "count")))
    return (topk.groupBy("date").agg(entries.alias("_e"))
            .select(F.col("date").cast("timestamp").alias("date"),
                    F.arrays_zip(F.col("_e")["topic"].alias("_1"),
                                 F.col("_e")["count"].cast("array<int>").alias("_2")).alias("topTenTopics")))


def document_json(docs: DataFrame) -> DataFrame:
    """Daily documents as JSON text, one line per day."""
    return docs.select("data", F.to_json(F.struct("data", "result")).alias("document"))
