"""Keyed record streams.

The article topic carries ``key`` (first tab field), ``value`` (whole line) and the
record ``timestamp``.  :func:`kafka_stream` holds every Kafka option in one place (the
connector jar must be on the classpath); :func:`file_stream` reads the same three
columns from Parquet files, which is what the tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_SCHEMA = "key STRING, value STRING, timestamp TIMESTAMP"


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool = True) -> DataFrame:
    """``fail_on_data_loss=False`` skips offsets that the topic no longer holds."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return r.load().select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"), "timestamp")


def file_stream(spark: SparkSession, path: str, schema: str = RECORD_SCHEMA,
                max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
