"""Re-read daily result documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.schemas import DAILY_DOCUMENT_SCHEMA


def read_daily_json(spark: SparkSession, path: str) -> DataFrame:
    """``{"data", "result": [{topic, count}]}`` -> flat ``(date, rank, topic, count)``."""
    docs = spark.read.schema(DAILY_DOCUMENT_SCHEMA).json(path)
    return (docs.select(F.to_date("data", "yyyy-MM-dd").alias("date"),
                        F.posexplode("result").alias("pos", "entry"))
            .select("date", (F.col("pos") + 1).cast("bigint").alias("rank"),
                    F.col("entry.topic").alias("topic"), F.col("entry.count").alias("count")))
