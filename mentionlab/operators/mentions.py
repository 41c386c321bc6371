"""Any source -> ``mentions(record_id, ts, date, topic)``: projection, null filters, split, explode, names.

All steps are narrow (no shuffle); Catalyst merges the filters and prunes the scan to
the two columns read (P1-P3, F1, F3-F6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlab.functions.names import name_of, split_mentions
from mentionlab.functions.times import RECORD_KEY_FORMAT, day_of

TOPIC_PATTERN = "([A-Z][a-z]+)"


def project_records(df: DataFrame, ts_col: str = "date", names_col: str = "allNames",
                    id_col: str | None = "gkgrecordid") -> DataFrame:
    """Keep the id, time and names columns, under contract names."""
    cols = [F.col(ts_col).alias("ts"), F.col(names_col).alias("all_names")]
    if id_col:
        cols.insert(0, F.col(id_col).cast("string").alias("record_id"))
    else:
        cols.insert(0, F.lit(None).cast("string").alias("record_id"))
    return df.select(*cols)


def drop_null_records(records: DataFrame) -> DataFrame:
    """A record needs a time and a names field; an empty names field counts as null."""
    return records.filter(F.col("ts").isNotNull() & F.col("all_names").isNotNull()
                          & (F.col("all_names") != ""))


def explode_items(records: DataFrame, with_pos: bool = False) -> DataFrame:
    """one row per mention item (``pos`` is 1-based when asked for)."""
    items = split_mentions(F.col("all_names"))
    keep = [c for c in records.columns if c != "all_names"]
    if with_pos:
        return records.select(*keep, F.posexplode(items).alias("pos", "item")) \
            .withColumn("pos", (F.col("pos") + 1).cast("bigint"))
    return records.select(*keep, F.explode(items).alias("item"))


def mentions_from_records(records: DataFrame, name_rule: str = "last_offset") -> DataFrame:
    """``(record_id, ts, all_names)`` -> mentions; empty items and empty names are dropped."""
    items = explode_items(drop_null_records(records)).filter(F.col("item") != "")
    return (items.select("record_id", "ts", day_of(F.col("ts")).alias("date"),
                         name_of(F.col("item"), name_rule).alias("topic"))
            .filter(F.col("topic") != ""))


def mentions_from_gkg(df: DataFrame, name_rule: str = "last_offset") -> DataFrame:
    """Typed GKG frame (S1) -> mentions."""
    return mentions_from_records(project_records(df), name_rule)


def text_records_to_records(text: DataFrame) -> DataFrame:
    """Text path (S2) -> ``(record_id, ts, all_names)``.  The day is the first eight digits of the
    date; a date with a day but no readable time counts from the day's start, one without drops the record."""
    ts = F.coalesce(F.try_to_timestamp(F.substring("date_text", 1, 14), F.lit(RECORD_KEY_FORMAT)),
                    F.try_to_timestamp(F.substring("date_text", 1, 8), F.lit("yyyyMMdd")))
    return text.select(F.col("record_key").alias("record_id"), ts.alias("ts"), "all_names")


def mentions_from_text(text: DataFrame, name_rule: str = "head") -> DataFrame:
    """Text path: the reference's RDD version takes the text before the first comma."""
    return mentions_from_records(text_records_to_records(text), name_rule)


def mentions_from_events(events: DataFrame, id_col: str = "event_id", ts_col: str = "ts",
                         topic_col: str = "event_type") -> DataFrame:
    """A table with a time and a name column is already one mention per row."""
    return (events.select(F.col(id_col).cast("string").alias("record_id"),
                          F.col(ts_col).cast("timestamp").alias("ts"),
                          F.col(topic_col).alias("topic"))
            .select("record_id", "ts", day_of(F.col("ts")).alias("date"), "topic"))


def topics_from_text(df: DataFrame, text_col: str, pattern: str = TOPIC_PATTERN,
                     keep: list[str] | None = None) -> DataFrame:
    """Article text -> one row per capitalised word (whole text, JVM regex)."""
    keep = keep or []
    return df.select(*keep, F.explode(F.regexp_extract_all(F.col(text_col), F.lit(pattern), 1))
                     .alias("topic"))
