"""Stand-ins built from the driver tables (the archive itself is not available here).

* events -> ``articles``: one knowledge-graph record per user, day and block of event
  ids, its ``allNames`` field listing ``event_type,event_id`` items in id order.  The block
  (``event_id div 256``) bounds a record to 256 mentions, so no record grows with a hot user.
* articles -> tab-separated 27-column lines for the text path and the file readers.
* documents -> topics (capitalised words of the whole text) on seven synthetic days.

Each has a twin CTE in :mod:`mentionlab.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.functions.times import record_key
from mentionlab.operators.mentions import topics_from_text
from mentionlab.sources.gkg import gkg_line

ARTICLE_BLOCK = 256
DOC_DAY0 = "2015-02-18"
DOC_DAYS = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(events: DataFrame) -> DataFrame:
    """``(record_id BIGINT, rec_ts TIMESTAMP, all_names STRING, first_type STRING)``."""
    item = F.struct(F.col("event_id"), F.concat(F.col("event_type"), F.lit(","),
                                                F.col("event_id").cast("string")).alias("item"))
    grouped = events.groupBy("user_id", F.to_date("ts").alias("_day"),
                             F.floor(F.col("event_id") / ARTICLE_BLOCK).alias("_blk"))
    return grouped.agg(
        F.min("event_id").alias("record_id"),
        F.date_trunc("second", F.min("ts")).alias("rec_ts"),
        F.array_join(F.sort_array(F.collect_list(item))["item"], ";").alias("all_names"),
        F.min_by("event_type", "event_id").alias("first_type"),
    ).drop("user_id", "_day", "_blk")


def article_key(a: DataFrame) -> Column:
    return record_key(a["rec_ts"], a["record_id"])


def gkg_records(a: DataFrame, date: Column | None = None, names: Column | None = None) -> DataFrame:
    """Articles as the typed record view ``(gkgrecordid, date, allNames)``."""
    return a.select(article_key(a).alias("gkgrecordid"),
                    (date if date is not None else a["rec_ts"]).alias("date"),
                    (names if names is not None else a["all_names"]).alias("allNames"))


def gkg_lines(a: DataFrame, short_when: Column | None = None,
              empty_names_when: Column | None = None) -> DataFrame:
    """Articles as raw 27-column lines ``(record_key, value)``.

    ``short_when`` cuts a line to its first four columns; ``empty_names_when`` blanks ``allNames``.
    """
    names = a["all_names"]
    if empty_names_when is not None:
        names = F.when(empty_names_when, F.lit("")).otherwise(names)
    cols = {"gkgrecordid": article_key(a), "date": F.date_format(a["rec_ts"], "yyyyMMddHHmmss"),
            "sourceCollectionIdentifier": F.lit(1), "sourceCommonName": F.lit("events"),
            "allNames": names}
    line = gkg_line(cols)
    if short_when is not None:
        short = F.concat_ws("\t", *[cols[c].cast("string") for c in
                                    ("gkgrecordid", "date", "sourceCollectionIdentifier", "sourceCommonName")])
        line = F.when(short_when, short).otherwise(line)
    return a.select(article_key(a).alias("record_key"), line.alias("value"))


def doc_day(doc_id: Column) -> Column:
    return F.date_add(F.lit(DOC_DAY0).cast("date"), F.pmod(doc_id, F.lit(DOC_DAYS)).cast("int"))


def document_topics(documents: DataFrame) -> DataFrame:
    """``(doc_id, date, topic)`` for every capitalised word of every document."""
    return topics_from_text(documents.withColumn("date", doc_day(F.col("doc_id"))), "text",
                            keep=["doc_id", "date"])
