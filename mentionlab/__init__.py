"""Mention counting and trending topics on Spark DataFrames and Structured Streaming.

Every source turns its records into one ``mentions`` frame
(``record_id, ts, date, topic``); counts, rankings, histograms and the
streaming state all start from there, so batch and stream share code.

Typical use::

    from mentionlab import build_session, read_gkg_csv, mentions_from_gkg, daily_topk
    spark = build_session()
    top = daily_topk(mentions_from_gkg(read_gkg_csv(spark, "archive/*.gkg.csv")))
"""

from mentionlab.operators.histogram import trailing_counts
from mentionlab.operators.mentions import (mentions_from_events, mentions_from_gkg,
                                           mentions_from_text)
from mentionlab.operators.topk import article_counts, daily_topk, daily_topk_articles, mention_counts
from mentionlab.session import build_session, checkpoint_root, scratch_path
from mentionlab.sources.gkg import convert_to_parquet, read_gkg_csv, read_gkg_parquet, read_gkg_text
from mentionlab.streaming.mentions import stream_mentions
from mentionlab.streaming.split_state import SplitHistogram, split_parts
from mentionlab.streaming.trailing_batches import TrailingHourBatches

__all__ = [
    "build_session", "checkpoint_root", "scratch_path",
    "read_gkg_csv", "read_gkg_text", "read_gkg_parquet", "convert_to_parquet",
    "mentions_from_gkg", "mentions_from_text", "mentions_from_events",
    "mention_counts", "article_counts", "daily_topk", "daily_topk_articles", "trailing_counts",
    "stream_mentions", "split_parts", "SplitHistogram", "TrailingHourBatches",
]
