"""Knowledge-graph records: 27 tab-separated columns, no header.

Two readers, as in the reference:

* :func:`read_gkg_csv` - the CSV reader with the fixed schema (S1).  Quoting is
  switched off, so a stray ``"`` cannot swallow the rest of a line.
* :func:`read_gkg_text` - raw lines split on tab with Java ``split`` width rules (S2).

Both keep the work on the executors; a later ``select`` prunes the other columns.
For repeated scans convert the text once to Parquet (partitioned by day) and read that.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentionlab.functions.text import drop_undecodable
from mentionlab.functions.times import SEGMENT_MINUTES
from mentionlab.schemas import (DATE_INDEX, GKG_COLUMNS, GKG_DATE_FORMAT, GKG_SCHEMA,
                                NAMES_INDEX, type_from_name)

TAB = "\t"


def read_gkg_csv(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType | None = None,
                 **options) -> DataFrame:
    """Typed reader; bad dates and short rows give nulls (PERMISSIVE)."""
    reader = (spark.read.schema(schema or GKG_SCHEMA)
              .option("sep", TAB)
              .option("header", "false")
              .option("quote", "")
              .option("timestampFormat", GKG_DATE_FORMAT)
              .option("mode", "PERMISSIVE"))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def java_width(line: Column) -> Column:
    """Field count of ``line.split("\\t")`` in Java: trailing empty fields are dropped."""
    return F.size(F.split(F.regexp_replace(line, F.lit(TAB + "+$"), F.lit("")), TAB))


def has_field_from(fields: Column, index: int) -> Column:
    """``java_width > index`` without a regex: some field at ``index`` or later is non-empty."""
    tail = F.slice(fields, index + 1, F.greatest(F.size(fields) - F.lit(index), F.lit(0)))
    return F.array_join(tail, "") != F.lit("")


def text_records(lines: DataFrame, value_col: str = "value", clean_bytes: bool = True,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Lines wide enough to hold ``allNames`` -> ``(record_key, date_text, all_names, *keep)``.

    One split per line; the width rule and the byte cleanup touch only what is used.
    """
    fields = lines.select(F.split(F.col(value_col), TAB).alias("fields"), *keep)

    def field(i: int) -> Column:
        f = F.get("fields", i)
        return drop_undecodable(f) if clean_bytes else f

    return (fields.filter(has_field_from(F.col("fields"), NAMES_INDEX))
            .select(field(0).alias("record_key"), field(DATE_INDEX).alias("date_text"),
                    field(NAMES_INDEX).alias("all_names"), *keep))


def read_gkg_text(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """``spark.read.text`` + tab split; see :func:`text_records`."""
    p = list(paths) if not isinstance(paths, str) else paths
    return text_records(spark.read.text(p))


def gkg_line(cols: dict[str, Column]) -> Column:
    """Build one 27-column tab-separated line; columns not given are empty.

    Runs of separators and empty columns become one literal, so a line is a single
    ``concat`` of the given columns and a few constants.
    """
    parts: list = []
    for i, c in enumerate(GKG_COLUMNS):
        if i:
            parts.append(TAB)
        if c in cols:
            parts.append(F.coalesce(cols[c].cast("string"), F.lit("")))
    merged: list = []
    for p in parts:
        if isinstance(p, str) and merged and isinstance(merged[-1], str):
            merged[-1] += p
        else:
            merged.append(p)
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in merged])


# ---------------------------------------------------------------- S3: size tiers
# Tier names of the reference's input sizes, smallest first, and what each
# reads from its first segment on: one segment, the month, January to June, the year, everything.
# "local" is everything of a local folder.
TIERS = {"small": "segment", "medium": "month", "large": "half", "xlarge": "year", "full": "all", "local": "all"}
TIER_NAMES = list(TIERS)


def _tier_span(tier: str) -> str:
    if tier not in TIERS:
        raise ValueError(f"unknown tier {tier!r}; one of {TIER_NAMES}")
    return TIERS[tier]


def _segment_no(ts: Column) -> Column:
    us = F.unix_micros(ts.cast("timestamp"))
    width = F.lit(SEGMENT_MINUTES * 60_000_000)
    return us - F.pmod(us, width)


def tier_filter(ts: Column, start: Column, tier: str) -> Column:
    """Rows of a tier by their time; ``start`` lies in the first segment."""
    span = _tier_span(tier)
    if span == "segment":
        return _segment_no(ts) == _segment_no(start)
    if span == "month":
        return F.trunc(ts, "month") == F.trunc(start, "month")
    if span == "half":
        return (F.year(ts) == F.year(start)) & (F.month(ts) <= 6)
    if span == "year":
        return F.year(ts) == F.year(start)
    return ts.isNotNull()


def tier_counts(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Rows per tier in one scan: conditional counts, then unpivot to ``(tier, n)``."""
    start = df.select(F.min(ts_col)).scalar()
    ts = F.col(ts_col)
    wide = df.agg(*[F.count_if(tier_filter(ts, start, t)).alias(t) for t in TIER_NAMES])
    return wide.unpivot([], TIER_NAMES, "tier", "n")


def tier_paths(base: str, tier: str, first_segment: str) -> list[str]:
    """Path globs for a tier, starting at ``first_segment`` (``yyyyMMddHHmmss``).

    Reading by glob lets the file listing do the pruning, as in the reference.
    """
    span = _tier_span(tier)
    year, month = first_segment[:4], first_segment[4:6]
    names = {"segment": first_segment, "month": f"{year}{month}*", "half": f"{year}0[1-6]*", "year": f"{year}*",
             "all": "*"}
    return [f"{base}/{names[span]}.gkg.csv"]


# ---------------------------------------------------------------- S5: schema as data
MAX_SCHEMA_LINES = 1000


def schema_from_headers(spark: SparkSession, path: str) -> T.StructType:
    """Fold a ``name TAB type TAB mode TAB`` file into a StructType.

    A schema description is a few dozen lines, so it is read to the driver; data is not, and
    a file of more than ``MAX_SCHEMA_LINES`` raises.
    """
    rows = (spark.read.option("sep", TAB).option("header", "false")
            .schema("name STRING, type STRING, mode STRING, rest STRING")
            .csv(path).filter(F.col("name").isNotNull())
            .withColumn("_pos", F.monotonically_increasing_id())
            .orderBy("_pos").limit(MAX_SCHEMA_LINES + 1).collect())
    if len(rows) > MAX_SCHEMA_LINES:
        raise ValueError(f"{path} is no schema file: more than {MAX_SCHEMA_LINES} lines")
    fields = [T.StructField(r["name"].strip(), type_from_name(r["type"]),
                            (r["mode"] or "NULLABLE").strip().upper() != "REQUIRED") for r in rows]
    return T.StructType(fields)


def record_schema_from_headers(spark: SparkSession, path: str) -> T.StructType:
    """Schema file -> reader schema under our column names, matched without case; the ``date``
    column is read as TIMESTAMP (it holds times) whatever the file says, and the file must have
    the 27 record columns in order."""
    fields = schema_from_headers(spark, path).fields
    if [f.name.lower() for f in fields] != [c.lower() for c in GKG_COLUMNS]:
        raise ValueError("schema file does not describe the 27 record columns in order")
    return T.StructType([T.StructField(c, T.TimestampType() if c == "date" else f.dataType, f.nullable)
                         for c, f in zip(GKG_COLUMNS, fields)])


# ---------------------------------------------------------------- one-time conversion
def convert_to_parquet(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write typed records as Parquet partitioned by day: later scans read two columns and
    prune days by directory instead of tokenising every CSV line again.

    The ``rebalance`` hint groups rows by day so a day is not scattered over thousands of
    small files, and lets AQE split a hot day's partition over several writers.
    """
    day = F.to_date("date")
    (records.withColumn("day", day)
     .hint("rebalance", "day")
     .write.mode(mode).partitionBy("day").parquet(path))


def _first_day(spark: SparkSession, path: str) -> str | None:
    """The earliest ``day=`` folder of converted records: a listing, no file is opened."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listing = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    names = [s.getPath().getName() for s in listing]
    return min((n[len("day="):] for n in names if n.startswith("day=") and not n.startswith("day=__")), default=None)


def _month_after(first: dt.date, months: int) -> dt.date:
    n = first.year * 12 + first.month - 1 + months
    return dt.date(n // 12, n % 12 + 1, 1)


def tier_days(tier: str, start: dt.datetime) -> tuple[dt.date, dt.date] | None:
    """First day of a tier and the first one after it; None: all days."""
    span, day = _tier_span(tier), start.date()
    if span == "segment":
        return day, day + dt.timedelta(days=1)
    if span == "month":
        return day.replace(day=1), _month_after(day.replace(day=1), 1)
    if span == "half":
        return dt.date(day.year, 1, 1), dt.date(day.year, 7, 1)
    if span == "year":
        return dt.date(day.year, 1, 1), dt.date(day.year + 1, 1, 1)
    return None


def read_gkg_parquet(spark: SparkSession, path: str, tier: str | None = None, first_segment: str | None = None) -> DataFrame:
    """Converted records, all or those of a tier (S3).

    A tier is a span of the partition column, so other days' folders are not read.  Without
    ``first_segment`` (``yyyyMMddHHmmss``) the first one comes from the earliest folder, of
    which the time column alone is read.
    """
    records = spark.read.parquet(path)
    if tier is None or _tier_span(tier) == "all":
        return records if tier is None else records.filter(F.col("day").isNotNull())
    if first_segment:
        start = dt.datetime.strptime(first_segment, "%Y%m%d%H%M%S")
    else:
        day = _first_day(spark, path)
        if day is None:
            return records.filter(F.lit(False))
        text = records.filter(F.col("day") == F.to_date(F.lit(day))).agg(
            F.date_format(F.min("date"), GKG_DATE_FORMAT)).first()[0]
        start = dt.datetime.strptime(text, "%Y%m%d%H%M%S")
    low, high = tier_days(tier, start)
    kept = records.filter((F.col("day") >= F.lit(low)) & (F.col("day") < F.lit(high)))
    if _tier_span(tier) == "segment":
        begin = start - dt.timedelta(minutes=start.minute % SEGMENT_MINUTES, seconds=start.second)
        end = begin + dt.timedelta(minutes=SEGMENT_MINUTES)
        edges = [F.to_timestamp(F.lit(t.strftime("%Y%m%d%H%M%S")), GKG_DATE_FORMAT) for t in (begin, end)]
        kept = kept.filter((F.col("date") >= edges[0]) & (F.col("date") < edges[1]))
    return kept
