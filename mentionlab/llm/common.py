"""Small helpers that the training-data operators share."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_SPACE = " \t\n\x0b\f\r"

# One byte to one byte: A-Z to a-z, and every byte that is no letter, digit or part of a
# non-ASCII character to a space, so that bytes.split() gives the words.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only (``lower`` would change other alphabets as well)."""
    return F.translate(c, UPPER, LOWER)


def null_safe(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = left[cols[0]].eqNullSafe(right[cols[0]])
    for c in cols[1:]:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use, whatever its letter case."""
    used = {c.lower() for c in df.columns}
    name = base
    while name.lower() in used:
        name = f"{base}_{uuid.uuid4().hex[:6]}"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet under the shared checkpoint folder and reads it back.

    Cuts the lineage like ``checkpoint()``, but later readers get column pruning and the
    table survives lost executors.  The folder goes when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def bounded_broadcast(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """Hints a broadcast of ``df``, a written table of one number a row, up to ``rows`` rows
    (a few MB); a longer one is left to a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def emit(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class Rows:
    """Collects output rows in bounded Arrow batches."""

    def __init__(self, schema: pa.Schema, limit: int = 20_000):
        self.schema, self.limit = schema, limit
        self.rows: list[tuple] = []

    def full(self) -> bool:
        return len(self.rows) >= self.limit

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [[] for _ in self.schema]
        self.rows = []
        return emit(self.schema, columns)
