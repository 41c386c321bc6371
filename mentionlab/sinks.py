"""Sinks: run-stamped JSON (K1), daily documents (K2), keyed stream output (K3, K4)."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlab.operators.topk import daily_documents


def write_json_run(df: DataFrame, base: str, stamp: int | None = None, mode: str = "errorifexists") -> str:
    """K1: JSON lines into ``base/<unix seconds>``; refuses to overwrite an earlier run."""
    path = f"{base.rstrip('/')}/{stamp if stamp is not None else int(time.time())}"
    df.write.mode(mode).json(path)
    return path


def write_daily_documents(topk: DataFrame, path: str, mode: str = "overwrite") -> str:
    """K2: one ``{"data", "result"}`` document per day, written by the tasks that rank the days."""
    daily_documents(topk).write.mode(mode).json(path)
    return path


def keyed_records(df: DataFrame, key_col: str, ts_col: str | None = None) -> DataFrame:
    """K3/K4: ``key``/``value`` columns for a Kafka or file sink; the value is JSON of the row.

    A Kafka sink cannot set the record time, so it travels inside the value.
    """
    value = F.to_json(F.struct(*df.columns))
    cols = [F.col(key_col).cast("string").alias("key"), value.alias("value")]
    if ts_col:
        cols.append(F.col(ts_col).alias("timestamp"))
    return df.select(*cols)


def publish_updates(updates: DataFrame, batch_id: int, path: str | None = None, kafka: str | None = None,
                    topic: str = "histogram") -> None:
    """K4: the last update of each name of a batch (W8), keyed by name, JSON
    ``{"name","count","us","batch"}`` as the value; to ``path/batch=<id>`` or a Kafka topic."""
    last = updates.groupBy("name").agg(F.max_by(F.struct("count", "us"), F.struct(
        "us", F.col("event_id").isNull().alias("closing"))).alias("_last")) \
        .select("name", "_last.count", "_last.us", F.lit(batch_id).cast("long").alias("batch"))
    keyed = last.select(F.col("name").alias("key"), F.to_json(F.struct("name", "count", "us", "batch")).alias("value"))
    if kafka:
        keyed.write.format("kafka").option("kafka.bootstrap.servers", kafka).option("topic", topic).save()
    else:
        keyed.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")


def published_updates(records: DataFrame) -> DataFrame:
    """Published ``(key, value)`` records -> updates for the top-100 writer; unreadable values are left out."""
    parsed = records.select(F.from_json("value", "name STRING, count LONG, us LONG, batch LONG").alias("u")).select("u.*")
    return parsed.filter(F.col("count").isNotNull()).withColumn("event_id", F.lit(None).cast("long"))


def write_keyed(records: DataFrame, path: str | None = None, kafka: str | None = None,
                topic: str = "articles") -> None:
    """K3: ``key, value, timestamp`` records to a Parquet folder or a Kafka topic.

    Kafka assigns its own record time, so there the time also travels as a header.
    """
    if kafka:
        out = records.select("key", "value", F.array(F.struct(
            F.lit("ts").alias("key"), F.col("timestamp").cast("string").cast("binary").alias("value")))
            .alias("headers"))
        out.write.format("kafka").option("kafka.bootstrap.servers", kafka).option("topic", topic) \
            .option("includeHeaders", "true").save()
    else:
        records.write.mode("errorifexists").parquet(path)
