"""Jobs for ``spark-submit`` or ``python -m mentionlab``.

* ``topk``: daily top-k topics from records (``--format csv`` typed reader, ``text`` split
  path, or ``parquet`` after ``convert``); ``--tier`` picks a size tier by path glob or, of
  converted records, by day folders; ``--quarantine`` keeps unreadable lines, ``--stoplist``
  leaves topics out.
* ``convert``: records to day-partitioned Parquet.
* ``replay``: segment files to ``key, value, timestamp`` records, times spread evenly over
  each segment (to Parquet or Kafka).
* ``histogram``: the streaming trailing-hour histogram with top-100 change messages,
  from a Kafka topic or a folder of ``key, value, timestamp`` Parquet files; ``--publish``
  writes its keyed updates.
* ``top100``: the top-100 messages from such published updates.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

FIRST_SEGMENT = "20150218230000"


def _session():
    from mentionlab.session import build_session
    return build_session()


def run_topk(args) -> None:
    from mentionlab.operators.mentions import mentions_from_gkg, mentions_from_text
    from mentionlab.operators.topk import daily_topk
    from mentionlab.sinks import write_daily_documents, write_json_run
    from mentionlab.sources.gkg import (read_gkg_csv, read_gkg_parquet, read_gkg_text,
                                        record_schema_from_headers, tier_paths)
    spark = _session()
    paths = args.input
    if args.tier and args.format != "parquet":
        paths = tier_paths(args.input, args.tier, args.first_segment or FIRST_SEGMENT)
    if args.format == "csv" and args.quarantine:
        from mentionlab.sources.quarantine import read_gkg_judged, split_records
        good, bad = split_records(read_gkg_judged(spark, paths), args.quarantine)
        print(f"{bad.count()} lines in quarantine under {args.quarantine}/verdict=bad", file=sys.stderr)
        mentions = mentions_from_gkg(good, args.name_rule)
    elif args.format == "csv":
        schema = record_schema_from_headers(spark, args.schema) if args.schema else None
        mentions = mentions_from_gkg(read_gkg_csv(spark, paths, schema), args.name_rule)
    elif args.format == "text":
        mentions = mentions_from_text(read_gkg_text(spark, paths), args.name_rule)
    else:
        mentions = mentions_from_gkg(read_gkg_parquet(spark, args.input, args.tier, args.first_segment), args.name_rule)
    if args.stoplist:
        from mentionlab.operators.stoplist import daily_topk_without_patterns
        patterns = spark.read.option("sep", "\t").schema("kind STRING, pattern STRING").csv(args.stoplist)
        top = daily_topk_without_patterns(mentions, patterns, args.k)
    else:
        top = daily_topk(mentions, args.k)
    if args.reference_shape:
        from mentionlab.operators.topk import top_ten_rows
        write_json_run(top_ten_rows(top), args.output)
    elif args.documents:
        write_daily_documents(top, args.output, mode="errorifexists")
    else:
        write_json_run(top, args.output)


def run_convert(args) -> None:
    from mentionlab.sources.gkg import convert_to_parquet, read_gkg_csv
    spark = _session()
    convert_to_parquet(read_gkg_csv(spark, args.input), args.output)


def _run_stream(writer, args) -> None:
    from mentionlab.streaming.increments import poll_trigger
    writer = writer.option("checkpointLocation", args.checkpoint)
    q = (writer.trigger(availableNow=True) if args.once else poll_trigger(writer, args.every)).start()
    q.awaitTermination()


def run_histogram(args) -> None:
    from mentionlab.sinks import publish_updates
    from mentionlab.streaming.mentions import stream_mentions
    from mentionlab.streaming.sources import RECORD_SCHEMA, file_stream, kafka_stream
    from mentionlab.streaming.top100 import Top100Writer
    from mentionlab.streaming.trailing_batches import TrailingHourBatches
    spark = _session()
    if args.kafka:
        records = kafka_stream(spark, args.kafka, args.topic, max_offsets_per_trigger=args.max_per_trigger)
    else:
        records = file_stream(spark, args.input, RECORD_SCHEMA, max_files_per_trigger=args.max_per_trigger)
    m = stream_mentions(records).select(F.col("record_id").alias("event_id_text"), "ts",
                                        F.col("topic").alias("name"))
    # record keys are text; label each mention by a hash of key, name and time
    m = m.withColumn("event_id", F.xxhash64("event_id_text", "name", "ts"))
    top = Top100Writer(args.output)

    def then(updates, batch_id):
        top(updates, batch_id)
        if args.publish or args.publish_topic:
            publish_updates(updates, batch_id, args.publish, args.kafka if args.publish_topic else None,
                            args.publish_topic)

    if args.split_state:
        from mentionlab.streaming.split_state import SplitHistogram, split_parts
        _run_stream(split_parts(m).writeStream.foreachBatch(SplitHistogram(f"{args.output}/trailing", then)), args)
    else:
        _run_stream(m.writeStream.foreachBatch(TrailingHourBatches(f"{args.output}/trailing", then=then)), args)


def run_top100(args) -> None:
    from mentionlab.sinks import published_updates
    from mentionlab.streaming.sources import file_stream, kafka_stream
    from mentionlab.streaming.top100 import Top100Writer
    spark = _session()
    if args.kafka:
        records = kafka_stream(spark, args.kafka, args.topic, starting="earliest")
    else:
        records = file_stream(spark, f"{args.input.rstrip('/')}/batch=*", "key STRING, value STRING")
    _run_stream(published_updates(records).writeStream.foreachBatch(Top100Writer(args.output)), args)


def run_replay(args) -> None:
    from mentionlab.operators.replay import spread_timestamps
    from mentionlab.sinks import write_keyed
    from mentionlab.sources.segments import segment_lines
    spark = _session()
    lines = segment_lines(spark, args.input)
    spread = spread_timestamps(lines, "segment", F.col("seg_start"), "line_order")
    records = spread.select(F.col("record_key").alias("key"), "value",
                            F.timestamp_millis("ms").alias("timestamp"))
    write_keyed(records, args.output, args.kafka, args.topic)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="mentionlab")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("topk", help="daily top-k topics")
    t.add_argument("--input", required=True)
    t.add_argument("--output", required=True)
    t.add_argument("--format", choices=["csv", "text", "parquet"], default="csv")
    t.add_argument("--tier", choices=["small", "medium", "large", "xlarge", "full", "local"])
    t.add_argument("--first-segment", help="yyyyMMddHHmmss; default: the archive's first, or that of the converted records")
    t.add_argument("--quarantine", help="folder for records and for lines that are none, with file and reason (csv)")
    t.add_argument("--stoplist", help="file of kind TAB pattern (equals, prefix, suffix, contains): topics left out")
    t.add_argument("--name-rule", choices=["last_offset", "all_offsets", "head"], default="last_offset")
    t.add_argument("--k", type=int, default=10)
    t.add_argument("--schema", help="headers file (name TAB type TAB mode) for the csv reader")
    t.add_argument("--reference-shape", action="store_true",
                   help="write rows as {date, topTenTopics: [{_1, _2}]} for existing readers")
    t.add_argument("--documents", action="store_true", help="write one {data, result} document per day")
    t.set_defaults(fn=run_topk)
    c = sub.add_parser("convert", help="records to day-partitioned Parquet")
    c.add_argument("--input", required=True)
    c.add_argument("--output", required=True)
    c.set_defaults(fn=run_convert)
    r = sub.add_parser("replay", help="segment files -> key, value, timestamp records spread over each segment")
    r.add_argument("--input", required=True)
    r.add_argument("--output", help="Parquet folder (without --kafka)")
    r.add_argument("--kafka", help="bootstrap servers")
    r.add_argument("--topic", default="articles")
    r.set_defaults(fn=run_replay)
    h = sub.add_parser("histogram", help="streaming trailing-hour histogram and top-100 messages")
    h.add_argument("--kafka", help="bootstrap servers; without it --input is a Parquet folder")
    h.add_argument("--topic", required=False, default="articles")
    h.add_argument("--input")
    h.add_argument("--output", required=True)
    h.add_argument("--checkpoint", required=True)
    h.add_argument("--max-per-trigger", type=int)
    h.add_argument("--publish", help="folder for keyed updates, a row per name and batch")
    h.add_argument("--publish-topic", help="Kafka topic for keyed updates (with --kafka)")
    h.add_argument("--split-state", action="store_true",
                   help="counts in RocksDB state by (name, minute) and name, in place of a log of recent mentions")
    h.add_argument("--every", default="1 second")
    h.add_argument("--once", action="store_true", help="process what is there and stop")
    h.set_defaults(fn=run_histogram)
    c = sub.add_parser("top100", help="top-100 messages from published histogram updates")
    c.add_argument("--kafka", help="bootstrap servers; without it --input is the folder of --publish")
    c.add_argument("--topic", default="histogram")
    c.add_argument("--input")
    c.add_argument("--output", required=True)
    c.add_argument("--checkpoint", required=True)
    c.add_argument("--every", default="1 second")
    c.add_argument("--once", action="store_true", help="process what is there and stop")
    c.set_defaults(fn=run_top100)
    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main(sys.argv[1:])
