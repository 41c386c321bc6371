"""Segment bookkeeping: manifests (S6), incremental pick-up (S8), last key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.functions.times import DEFAULT_LAST_KEY, DEFAULT_LAST_SEGMENT

# The archive layout of segment files.
SEGMENT_PATH_PATTERN = r"v2/gkg/[0-9]+\.gkg\.csv"
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)"
PATH_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+([^?#]*)"


def url_parts(url: Column) -> list[Column]:
    return [F.regexp_extract(url, HOST_PATTERN, 1).alias("host"),
            F.regexp_extract(url, PATH_PATTERN, 1).alias("path")]


def manifest(urls: DataFrame, order_col: str, url_col: str = "url", n: int = 100) -> DataFrame:
    """First ``n`` entries of a URL list with host and path split out (top-n is the feature)."""
    return (urls.select(order_col, *url_parts(F.col(url_col)),
                        F.regexp_extract(F.col(url_col), SEGMENT_PATH_PATTERN, 0).alias("segment_path"))
            .orderBy(order_col).limit(n))


def read_manifest(spark: SparkSession, path: str, n: int) -> DataFrame:
    lines = spark.read.text(path).withColumn("line_no", F.monotonically_increasing_id())
    return manifest(lines.filter(F.col("value").rlike(SEGMENT_PATH_PATTERN)), "line_no", "value", n)


def newer_than(names: Column, last: str = DEFAULT_LAST_SEGMENT) -> Column:
    """Predicate of the incremental pick-up on the ``yyyyMMddHHmmss`` part (sorts as time)."""
    return F.substring(names, 1, 14) > F.lit(last[:14])


def read_new_segments(spark: SparkSession, base: str, last: str = DEFAULT_LAST_SEGMENT) -> DataFrame:
    """Batch twin of the file stream: only segment files with a name after ``last``."""
    from mentionlab.sources.gkg import read_gkg_text
    lines = read_gkg_text(spark, f"{base}/*.gkg.csv")
    return lines.withColumn("segment", F.col("_metadata.file_name")).filter(newer_than(F.col("segment"), last))


def last_keys(df: DataFrame, group_col: str, key_col: str, offset_col: str,
              default: str = DEFAULT_LAST_KEY) -> DataFrame:
    """Key of the newest record per partition; the seed key when a partition has none."""
    return df.groupBy(group_col).agg(
        F.coalesce(F.max_by(key_col, offset_col), F.lit(default)).alias("last_key"))


def segment_lines(spark: SparkSession, paths) -> DataFrame:
    """Raw lines with their segment (file name), segment start and position.

    Text files carry no line numbers, so the order comes from the record key suffix
    (``yyyyMMddHHmmss-N``); feed the result to ``operators.replay``.
    """
    from mentionlab.functions.times import segment_time
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("segment"))
    key = F.substring_index(F.col("value"), "\t", 1)
    number = F.regexp_extract(F.substring_index(key, "-", -1), r"(\d+)$", 1).try_cast("bigint")
    return lines.select("segment", segment_time(F.col("segment")).alias("seg_start"), key.alias("record_key"),
                        number.alias("seq"), "value",
                        # a total order, whatever the suffix looks like
                        F.struct(number.alias("n"), key.alias("k"), "value").alias("line_order"))
