"""The RDD operations the manual documents, as DataFrame operations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlab.plans.ranking import number_rows


def map_increment(df: DataFrame, col: str = "num", by: int = 1) -> DataFrame:
    """Element-wise map."""
    return df.withColumn(col, F.col(col) + F.lit(by))


def sum_by_key(df: DataFrame, key: str, value: str, out: str = "total") -> DataFrame:
    """M9/A5: ``reduceByKey(_ + _)``."""
    return df.groupBy(key).agg(F.sum(value).cast("bigint").alias(out))


def partition_map(lineitem: DataFrame) -> DataFrame:
    """M4: ``mapPartitions`` over rows is a column expression here (one codegen span, no shuffle)."""
    revenue = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    return lineitem.select("l_orderkey", "l_linenumber", revenue.alias("revenue"))


def join_inner(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               strategy: str | None = None) -> DataFrame:
    """M6: equi-join; ``strategy`` is a join hint (``merge``, ``shuffle_hash``) or None for the planner."""
    r = right.hint(strategy) if strategy else right
    return left.join(r, left[left_key] == r[right_key], "inner")


def cogroup_counts(left: DataFrame, right: DataFrame, key_left: str, key_right: str) -> DataFrame:
    """M7: ``cogroup`` as counts per key on both sides (each pre-aggregated, then full outer join)."""
    lc = left.groupBy(F.col(key_left).alias("key")).agg(F.count(F.lit(1)).alias("n_left"))
    rc = right.groupBy(F.col(key_right).alias("key")).agg(F.count(F.lit(1)).alias("n_right"))
    return lc.join(rc, "key", "full_outer").select(
        "key", F.coalesce("n_left", F.lit(0)).cast("bigint").alias("n_left"),
        F.coalesce("n_right", F.lit(0)).cast("bigint").alias("n_right"))


def group_collect(df: DataFrame, key: str, value: str, max_items: int = 1024,
                  sep: str = ",") -> DataFrame:
    """M8: ``groupByKey`` with the values of a key in order, in parts of at most ``max_items``.

    A key holding a third of all rows becomes many bounded rows instead of one huge one.
    """
    numbered = number_rows(df.select(key, value), [key], [F.col(value)], out="_i")
    part = F.floor(F.col("_i") / F.lit(max_items)).cast("bigint")
    items = F.sort_array(F.collect_list(F.struct(F.col("_i"), F.col(value).cast("string").alias("v"))))
    return (numbered.withColumn("part", part).groupBy(key, "part")
            .agg(items.alias("_items"))
            .select(key, "part", F.array_join(F.transform("_items", lambda x: x["v"]), sep).alias("items")))


def combine_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """``combineByKey`` with a (count, sum) accumulator, finished to a mean."""
    return (df.groupBy(key).agg(F.count(value).alias("n"), F.sum(value).alias("total"))
            .withColumn("mean", F.col("total") / F.col("n")))


def _partial_means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = pa.Table.from_batches([b]).group_by("key").aggregate([("value", "count"), ("value", "sum")])
        yield from found.select(["key", "value_count", "value_sum"]).to_batches()


def combine_mean_pandas(df: DataFrame, key: str, value: str) -> DataFrame:
    """M10 twin with the accumulator built in Arrow batches: (count, sum) per batch and key
    before the shuffle, so a hot key sends a row a batch."""
    kind = df.schema[key].dataType.simpleString()
    parts = df.select(F.col(key).alias("key"), F.col(value).cast("double").alias("value")).mapInArrow(
        _partial_means, f"key {kind}, n bigint, total double")
    return (parts.groupBy(F.col("key").alias(key)).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
            .select(key, (F.col("total") / F.col("n")).alias("mean")))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """M11."""
    return df.select(col).distinct()


def values_in_both(df: DataFrame, col: str, first: Column, second: Column) -> DataFrame:
    """M12 in one pass over ``df``: values with a row of either condition."""
    return (df.groupBy(col).agg(F.bool_or(first).alias("_a"), F.bool_or(second).alias("_b"))
            .filter("_a AND _b").select(col))


def reshuffle(df: DataFrame, n: int | None = None, keys: Sequence[str] = (), then_coalesce: int | None = None) -> DataFrame:
    """``repartition`` (by keys when given) and ``coalesce``; the row set is unchanged.

    Without ``n`` the session's shuffle partitions hold, which grow with the cluster."""
    out = df.repartition(*([n] if n else []), *keys)
    return out.coalesce(then_coalesce) if then_coalesce else out
