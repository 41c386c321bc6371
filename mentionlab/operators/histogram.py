"""Histograms of names: order, extremes, top 100 and exact trailing-hour counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mentionlab.functions.times import micros
from mentionlab.plans.ranking import number_rows

HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000


def _bucket(us, width_us: int):
    """``floor(us / width)`` in exact integer arithmetic (also for times before 1970)."""
    return ((us - F.pmod(us, F.lit(width_us))) / F.lit(width_us)).cast("bigint")


def totals(mentions: DataFrame, name_col: str = "topic") -> DataFrame:
    """Histogram ``(name, count)`` over all mentions."""
    return mentions.groupBy(F.col(name_col).alias("name")).agg(F.count(F.lit(1)).alias("count"))


def sort_orders(by: str = "count", descending: bool = True):
    """Order of the display, with a total tie-break on the name."""
    if by == "count":
        first = F.col("count").desc() if descending else F.col("count").asc()
        return [first, F.col("name").asc()]
    if by == "name":
        return [F.col("name").desc() if descending else F.col("name").asc()]
    raise ValueError("sort by 'count' or 'name'")


def sorted_histogram(hist: DataFrame, by: str = "count", descending: bool = True) -> DataFrame:
    """Every entry with its 1-based position, numbered by a range shuffle and offsets at
    any size, never by one unbounded window."""
    return number_rows(hist, [], sort_orders(by, descending), out="pos", base=1)


def first_n(hist: DataFrame, n: int = 10, by: str = "count", descending: bool = True) -> DataFrame:
    """T4: first ``n`` entries (``TakeOrderedAndProject``: ``n`` rows per partition at most)."""
    top = hist.orderBy(*sort_orders(by, descending)).limit(n)
    return top.withColumn("pos", F.row_number().over(Window.orderBy(*sort_orders(by, descending)))
                          .cast("bigint"))


def top_entries(hist: DataFrame, n: int = 100) -> DataFrame:
    """Exact top ``n`` by count, ties by name, with ``rank``."""
    return first_n(hist, n).withColumnRenamed("pos", "rank")


def histogram_max(hist: DataFrame) -> DataFrame:
    """The largest count (and the first name carrying it)."""
    return hist.orderBy(F.col("count").desc(), F.col("name").asc()).limit(1).select("name", "count")


def histogram_min(hist: DataFrame) -> DataFrame:
    """The smallest count; ties go to the first name in name order."""
    return hist.agg(F.min_by("name", F.struct("count", "name")).alias("name"),
                    F.min("count").alias("count"))


def trailing_counts(events: DataFrame, key_col: str, ts_col: str, id_col: str,
                    width_us: int = HOUR_US, bucket_us: int = MINUTE_US,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """For every row with a time, rows of the same key with time in ``(t - width, t]``.

    Output ``(id, key, count, *keep)``, a row per input row (repeated ids and null keys
    included).  One form for all sizes.  Time is cut into buckets (a minute; a divisor of
    the width), and the rows before ``t`` in the window are

    * the whole buckets from the one of ``t - width`` up to the one before ``t``: partial
      counts per (key, bucket), combined on the map side and summed over a bounded range;
    * plus the rows of ``t``'s own bucket up to ``t``, less those of the oldest bucket that
      are ``width`` or more older: both in one running sum per (key, bucket), in which the
      older rows stand ``width`` later than they are.

    A window thus holds two buckets of one key, never a whole key or hour; rows are
    shuffled once (twice their number), and the join with the partial counts reuses that.
    """
    if width_us % bucket_us:
        raise ValueError("the bucket must divide the window")
    span = width_us // bucket_us
    # a struct groups and joins null keys like any other
    base = events.select(F.col(id_col).alias("_id"), F.struct(F.col(key_col).alias("k")).alias("_key"),
                         micros(F.col(ts_col)).alias("_us"), *keep).filter(F.col("_us").isNotNull())
    per_bucket = base.groupBy("_key", _bucket(F.col("_us"), bucket_us).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    older = Window.partitionBy("_key").orderBy("_b").rangeBetween(-span, -1)
    partial = per_bucket.select("_key", "_b", F.coalesce(F.sum("_n").over(older), F.lit(0)).alias("_before"))
    # one scan: every row as itself, and as one that leaves the window a width later
    copies = F.explode(F.array(F.struct(F.col("_us").alias("_x"), F.lit(1).alias("_sign")),
                               F.struct((F.col("_us") + F.lit(width_us)).alias("_x"), F.lit(-1).alias("_sign"))))
    both = base.select("_id", "_key", *keep, copies.alias("_c")) \
        .select("_id", "_key", *keep, "_c._x", "_c._sign", _bucket(F.col("_c._x"), bucket_us).alias("_b"))
    running = Window.partitionBy("_key", "_b").orderBy("_x").rangeBetween(Window.unboundedPreceding, 0)
    own = both.withColumn("_in", F.sum("_sign").over(running)).filter("_sign = 1")
    return own.join(partial, ["_key", "_b"]).select(
        F.col("_id").alias(id_col), F.col("_key.k").alias(key_col),
        (F.col("_before") + F.col("_in")).cast("bigint").alias("count"), *keep)
