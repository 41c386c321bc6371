"""Line stream to name stream with the batch column functions (one code path)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlab.functions.times import minute_key
from mentionlab.operators.mentions import mentions_from_records
from mentionlab.sources.gkg import text_records


def stream_mentions(records: DataFrame, name_rule: str = "head", time_col: str = "timestamp") -> DataFrame:
    """``(key, value, timestamp)`` records -> mentions with the record's minute key.

    Same split, width filter, name rule and explode as the batch text path; the event
    time is the record's own timestamp (set by the replay), as on the article topic.
    Works on a streaming or a static frame.
    """
    text = text_records(records, keep=(time_col,))
    recs = text.select(F.col("record_key").alias("record_id"), F.col(time_col).alias("ts"), "all_names")
    return mentions_from_records(recs, name_rule).withColumn("minute_key", minute_key(F.col("record_id")))
