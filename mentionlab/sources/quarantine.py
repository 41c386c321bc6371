"""S1 with a quarantine: lines that are no record are kept, with file name and reason.

One scan of the text judges every line: the good ones become typed records, the others keep
the line as it was read.  :func:`split_records` writes both in the same job, in folders
of their own, so nothing is read twice and no line is lost or turned into nulls unseen.

Reasons, the first that holds: ``short`` (fewer than 27 fields), ``long`` (more, a stray tab),
``key`` (no record key), ``date`` (no time of the form yyyyMMddHHmmss).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.schemas import GKG_COLUMNS, GKG_DATE_FORMAT, GKG_SCHEMA
from mentionlab.sources.gkg import TAB

REASONS = ("short", "long", "key", "date")


def judged(lines: DataFrame, value_col: str = "value", file_col: str | None = None) -> DataFrame:
    """The 27 typed columns of every line, ``reason`` (null: a good record), ``line`` (of bad ones) and ``file``."""
    file = F.col(file_col) if file_col else F.lit(None).cast("string")
    fields = lines.select(F.split(value_col, TAB).alias("f"), F.col(value_col).alias("line"), file.alias("file"))

    def field(i: int) -> Column:
        return F.get("f", i)

    at = GKG_COLUMNS.index("date")
    width = F.size("f")
    time = F.when(F.length(field(at)) == len("yyyyMMddHHmmss"), F.try_to_timestamp(field(at), F.lit(GKG_DATE_FORMAT)))
    reason = (F.when(width < len(GKG_COLUMNS), "short").when(width > len(GKG_COLUMNS), "long")
              .when(F.trim(field(0)) == "", "key").when(time.isNull(), "date"))
    known = fields.withColumn("reason", reason)
    good = F.col("reason").isNull()

    def typed(i: int, name: str) -> Column:
        value = time if name == "date" else F.nullif(field(i), F.lit("")).try_cast(GKG_SCHEMA[name].dataType)
        return F.when(good, value).alias(name)

    return known.select(*[typed(i, c) for i, c in enumerate(GKG_COLUMNS)], "reason",
                        F.when(~good, F.col("line")).alias("line"), F.when(~good, F.col("file")).alias("file"))


def read_gkg_judged(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Lines of record files, judged, with the name of the file that a bad one comes from."""
    p = paths if isinstance(paths, str) else list(paths)
    return judged(spark.read.text(p).select("value", F.col("_metadata.file_name").alias("_file")), "value", "_file")


def split_records(rows: DataFrame, path: str, mode: str = "errorifexists") -> tuple[DataFrame, DataFrame]:
    """Writes judged rows once and gives (records, quarantine ``(file, reason, line)``)."""
    verdict = F.when(F.col("reason").isNull(), "good").otherwise("bad")
    rows.withColumn("verdict", verdict).write.mode(mode).partitionBy("verdict").parquet(path)
    written = rows.sparkSession.read.schema(f"{_ddl(rows)}, verdict STRING").parquet(path)
    return (written.filter("verdict = 'good'").select(*GKG_COLUMNS),
            written.filter("verdict = 'bad'").select("file", "reason", "line"))


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)


def bad_line_counts(quarantine: DataFrame) -> DataFrame:
    """``(file, reason, lines)``: what a run should look into."""
    return quarantine.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("lines"))
