"""Sensor CSV example: eight typed columns, custom time pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mentionlab.schemas import SENSOR_SCHEMA, SENSOR_TIME_FORMAT


def read_sensor_csv(spark: SparkSession, path: str, time_format: str = SENSOR_TIME_FORMAT) -> DataFrame:
    return (spark.read.schema(SENSOR_SCHEMA)
            .option("header", "false")
            .option("timestampFormat", time_format)
            .option("mode", "PERMISSIVE")
            .csv(path))
