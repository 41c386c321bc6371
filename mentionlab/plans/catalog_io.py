"""Catalogue entries that go through files or streams.

Each writes data derived from the driver tables with one Spark job into a fresh folder
under the shared checkpoint root, reads it back with the reader under test (or runs a
stream over it to completion with ``availableNow``) and returns the result frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mentionlab.functions import times as TM
from mentionlab.operators import topk
from mentionlab.operators.mentions import mentions_from_events, mentions_from_gkg
from mentionlab.plans import derived as D
from mentionlab.plans import oracle as O
from mentionlab.operators import sketches, stoplist
from mentionlab.operators.daily_state import DailyTopk
from mentionlab.plans.catalog import SLIDING_SQL, TIER_SQL, TRAILING_SQL, query
from mentionlab.schemas import MENTION_SCHEMA, require_columns
from mentionlab.session import scratch_path
from mentionlab.sinks import write_daily_documents, write_json_run
from mentionlab.sources.daily_json import read_daily_json
from mentionlab.sources.gkg import (TIER_NAMES, convert_to_parquet, gkg_line, read_gkg_csv, read_gkg_parquet,
                                    read_gkg_text)
from mentionlab.sources.quarantine import read_gkg_judged, split_records
from mentionlab.sources.sensor import read_sensor_csv
from mentionlab.streaming.deltas import move
from mentionlab.streaming.increments import CurrentTable, running_totals
from mentionlab.streaming.mentions import stream_mentions
from mentionlab.streaming.sliding import sliding_counts_stream
from mentionlab.streaming.sources import RECORD_SCHEMA, file_stream
from mentionlab.streaming.split_state import DAY_MS, SplitHistogram, read_late, split_parts
from mentionlab.streaming.split_state import read_updates as split_updates
from mentionlab.streaming.top100 import Top100Writer, latest_snapshot, messages
from mentionlab.streaming.trailing_batches import TrailingHourBatches, read_updates

_LINES_CTE = O.with_(O.ARTICLES, f"lines AS (SELECT record_key, rec_ts, {O.gkg_line_sql(O.LINE_COLS)} AS value FROM ank)")


def _write_lines(spark: SparkSession, d: str, fmt: str = "text") -> str:
    a = D.articles(D.table(spark, d, "events"))
    path = scratch_path(spark, "gkg")
    lines = D.gkg_lines(a)
    if fmt == "text":
        lines.select("value").write.text(path)
    else:  # the article topic: key, whole line, record time
        lines.select(F.col("record_key").alias("key"), "value",
                     F.to_timestamp(F.substring("record_key", 1, 14), "yyyyMMddHHmmss").alias("timestamp")) \
            .write.parquet(path)
    return path


def run_to_end(writer) -> None:
    """Run a streaming write over everything available, then stop (raises on failure)."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# ------------------------------------------------------------------ file readers
@query("scan_gkg", O.with_(O.ARTICLES) + "SELECT record_key AS record_id, epoch_us(rec_ts) AS ts_us, all_names FROM ank")
def q_scan_gkg(spark, d):
    df = read_gkg_csv(spark, _write_lines(spark, d))
    return df.select(F.col("gkgrecordid").alias("record_id"), TM.micros(F.col("date")).alias("ts_us"),
                     F.col("allNames").alias("all_names"))


@query("scan_text_fields", O.with_(O.ARTICLES)
       + "SELECT record_key, strftime(rec_ts, '%Y%m%d%H%M%S') AS date_text, all_names FROM ank")
def q_scan_text_fields(spark, d):
    return read_gkg_text(spark, _write_lines(spark, d))


@query("scan_sensor", """SELECT event_type AS sensorname, epoch_us(date_trunc('minute', ts)) AS ts_us,
  value AS numA, user_id AS numC, event_id AS numE FROM events""")
def q_scan_sensor(spark, d):
    ev = D.table(spark, d, "events")
    line = F.concat_ws(",", F.col("event_type"), F.date_format("ts", "M/d/yy:H:mm"), F.col("value").cast("string"),
                       (F.col("value") * 2).cast("string"), F.col("user_id").cast("string"),
                       F.lit("0.5"), F.col("event_id").cast("string"), F.lit("1.0"))
    path = scratch_path(spark, "sensor")
    ev.select(line.alias("value")).write.text(path)
    s = read_sensor_csv(spark, path)
    return s.select("sensorname", TM.micros(F.col("timestamp")).alias("ts_us"), "numA", "numC", "numE")


_TOPK_CTE = O.with_(O.ARTICLES, O.article_mentions(), O.counts_cte("am"), "t AS (" + O.topk_select("c") + ")")


@query("read_daily_json", _TOPK_CTE + "SELECT date, rank, topic, count FROM t")
def q_read_daily_json(spark, d):
    top = topk.daily_topk(mentions_from_gkg(D.gkg_records(D.articles(D.table(spark, d, "events")))))
    path = write_daily_documents(top, scratch_path(spark, "daily"))
    return read_daily_json(spark, path)


@query("daily_document", _TOPK_CTE + """SELECT strftime(date, '%Y-%m-%d') AS data,
  CAST(to_json(struct_pack(data := strftime(date, '%Y-%m-%d'),
                      result := list(struct_pack(topic := topic, count := count) ORDER BY rank))) AS VARCHAR) AS document
FROM t GROUP BY date""")
def q_daily_document(spark, d):
    top = topk.daily_topk(mentions_from_gkg(D.gkg_records(D.articles(D.table(spark, d, "events")))))
    return topk.document_json(topk.daily_documents(top))


# ------------------------------------------------------------------ streams
@query("stream_source", _LINES_CTE + "SELECT record_key AS key, value FROM lines")
def q_stream_source(spark, d):
    src = _write_lines(spark, d, fmt="parquet")
    out, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    s = file_stream(spark, src, RECORD_SCHEMA).select("key", "value")
    run_to_end(s.writeStream.format("parquet").option("checkpointLocation", ckpt).option("path", out))
    return spark.read.parquet(out)


@query("stream_mentions", O.with_(O.ARTICLES, O.article_mentions("head")) + "SELECT record_id, date, topic FROM am")
def q_stream_mentions(spark, d):
    src = _write_lines(spark, d, fmt="parquet")
    out, ckpt = scratch_path(spark, "out"), scratch_path(spark, "ckpt")
    m = stream_mentions(file_stream(spark, src, RECORD_SCHEMA)).select("record_id", "date", "topic")
    run_to_end(m.writeStream.format("parquet").option("checkpointLocation", ckpt).option("path", out))
    return spark.read.parquet(out)


EVENT_STREAM_SCHEMA = "event_id LONG, ts TIMESTAMP, name STRING"
SLICES = 4


def _slice_number(ev: DataFrame, delay: str = "0") -> Column:
    """Which of four equal time slices a row (with ``_us``) comes with: ``delay`` slices after its
    own, if there is such a slice; rows without time come first."""
    lo, hi = ev.agg(F.min("_us"), F.max("_us")).first()
    number = F.expr(f"(_us - {lo or 0}L) * {SLICES} div {(hi or 0) - (lo or 0) + 1}L")
    later = number + F.coalesce(F.expr(delay), F.lit(0))
    return F.coalesce(F.when(later < SLICES, later).otherwise(number), F.lit(0))


def _run_slices(spark: SparkSession, ev: DataFrame, schema: str, writer) -> None:
    """Feeds ``ev`` (with ``_us``) to a stream in time order: each slice is one run from the
    checkpoint, and thus a micro-batch of as many files as it needs."""
    src, ckpt = scratch_path(spark, "slices"), scratch_path(spark, "ckpt")
    number = _slice_number(ev)
    for k in range(SLICES):
        ev.filter(number == k).drop("_us").write.mode("append").parquet(src)
        run_to_end(writer(file_stream(spark, src, schema)).option("checkpointLocation", ckpt))


def _run_moved_slices(spark: SparkSession, ev: DataFrame, schema: str, writer, delay: str = "0") -> None:
    """As :func:`_run_slices`, but in one run: all slices are written at once, and each one's folder is
    moved under the stream's path when the batches before, also those without rows, are through.
    Spark plans a Python state operator by starting a worker in the driver, at every start of a
    query.  Streaming checkpoints, in the same file system, need renames to be atomic as well.

    A slice all of whose rows are later than stream time is moved as soon as the slice before is written:
    Spark then fires the timers that are due in that slice's batch, at the same stream time as in
    one without rows, and rows later than stream time don't count in closing updates.  ``writer`` gets the
    stream and what it has to call with each batch it has written."""
    ready, src = scratch_path(spark, "ready"), scratch_path(spark, "slices")
    spans = Observation()
    of = [F.when(F.col("_slice") == k, F.col("_us")) for k in range(SLICES)]
    ev.withColumn("_slice", _slice_number(ev, delay)).observe(
        spans, *[F.min(us).alias(f"first{k}") for k, us in enumerate(of)], *[F.max(us).alias(f"last{k}") for k, us in enumerate(of)]) \
        .drop("_us").write.partitionBy("_slice").parquet(ready)
    span = spans.get
    waiting = list(range(SLICES))

    def put() -> None:
        k = waiting.pop(0)
        if not move(spark, f"{ready}/_slice={k}", f"{src}/{k}"):  # a slice without rows is a batch too
            move(spark, _written(spark.createDataFrame([], schema), f"{ready}/none={k}"), f"{src}/{k}")

    def put_if_later(updates: DataFrame, batch_id: int) -> None:
        if waiting and (first := span[f"first{waiting[0]}"]) is not None:
            now = max((t for k in range(waiting[0]) if (t := span[f"last{k}"]) is not None), default=None)
            if now is not None and first > -(-now // 1000) * 1000:  # stream time is in whole milliseconds, rounded up
                put()

    q = writer(file_stream(spark, f"{src}/*", schema), put_if_later) \
        .option("checkpointLocation", scratch_path(spark, "ckpt")).start()
    try:
        while waiting:
            put()
            q.processAllAvailable()
    finally:
        q.stop()


def _event_mentions(spark: SparkSession, d: str) -> DataFrame:
    ev = D.table(spark, d, "events")
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("name"),
                     TM.micros(F.col("ts").cast("timestamp")).alias("_us"))


def _split_run(spark: SparkSession, d: str, horizon_ms: int = DAY_MS, delay: str = "0") -> str:
    base = scratch_path(spark, "split")
    _run_moved_slices(spark, _event_mentions(spark, d), EVENT_STREAM_SCHEMA, lambda s, then: split_parts(
        s, horizon_ms=horizon_ms).writeStream.foreachBatch(SplitHistogram(base, then)), delay)
    return base


@query("stream_trailing_hour", TRAILING_SQL)
def q_stream_trailing_hour(spark, d):
    updates = split_updates(spark, _split_run(spark, d))
    return updates.filter(F.col("kind") == "arrival").select("event_id", "name", "count")


def _batches_run(spark: SparkSession, d: str, then=None) -> DataFrame:
    base = scratch_path(spark, "trailing_batches")
    sink = TrailingHourBatches(base, then=then)
    _run_slices(spark, _event_mentions(spark, d), EVENT_STREAM_SCHEMA, lambda s: s.writeStream.foreachBatch(sink))
    return read_updates(spark, base)


@query("stream_trailing_hour_batches", TRAILING_SQL)
def q_stream_trailing_hour_batches(spark, d):
    return _batches_run(spark, d).filter(F.col("kind") == "arrival").select("event_id", "name", "count")


# the slices of _run_slices, stream time after each, and every name's count in the hour that ends there
def _clock_sql(now: str = "max(us)") -> str:
    return f"""WITH b AS (SELECT event_id, event_type AS name, epoch_us(ts) AS us FROM events),
s AS (SELECT min(us) AS lo, max(us) AS hi FROM b),
r AS (SELECT b.*, (us - lo) * {SLICES} // (hi - lo + 1) AS batch FROM b, s),
clock AS (SELECT batch, {now} AS now, lag({now}) OVER (ORDER BY batch) AS before FROM r GROUP BY batch),
closing AS (SELECT c.batch, c.now, r.name, count(*) FILTER (r.us > c.now - 3600000000) AS count,
    bool_or(r.us <= c.now - 3600000000 AND (r.batch = c.batch OR r.us > c.before - 3600000000)) AS gone
  FROM clock c JOIN r ON r.batch <= c.batch GROUP BY 1, 2, 3),
changelog AS (SELECT event_id, name, count(*) OVER (
    PARTITION BY name ORDER BY us RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS count, us, 'arrival' AS kind FROM r
  UNION ALL SELECT NULL, name, count, now, 'expire' FROM closing WHERE gone),
live AS (SELECT batch, name, count FROM closing WHERE count > 0
  QUALIFY row_number() OVER (PARTITION BY batch ORDER BY count DESC, name) <= 100)
"""


_CLOCK_SQL = _clock_sql()
_MESSAGE_SQL = """CAST(to_json(list(struct_pack(name := name, count := count) ORDER BY name)) AS VARCHAR) AS message,
  count(*) AS entries"""


@query("histogram_changelog", _CLOCK_SQL + "SELECT event_id, name, count, us, kind FROM changelog")
def q_histogram_changelog(spark, d):
    return _batches_run(spark, d).select("event_id", "name", "count", "us", "kind")


# the split-state stream keeps time in whole milliseconds, rounded up
_MS_NOW = "((max(us) + 999) // 1000 * 1000)"


@query("split_histogram_changelog", _clock_sql(_MS_NOW) + "SELECT event_id, name, count, us, kind FROM changelog")
def q_split_histogram_changelog(spark, d):
    return split_updates(spark, _split_run(spark, d)).select("event_id", "name", "count", "us", "kind")


# every eleventh mention comes one or two slices late
_DELAY = "CASE WHEN event_id % 11 = 0 THEN 1 + event_id % 2 ELSE 0 END"


@query("late_rows", f"""WITH b AS (SELECT event_id, event_type AS name, epoch_us(ts) AS us FROM events),
s AS (SELECT min(us) AS lo, max(us) AS hi FROM b),
o AS (SELECT b.*, (us - lo) * {SLICES} // (hi - lo + 1) AS own FROM b, s),
r AS (SELECT event_id, name, us, CASE WHEN own + {_DELAY} < {SLICES} THEN own + {_DELAY} ELSE own END AS batch FROM o),
clock AS (SELECT k.batch, (SELECT {_MS_NOW} FROM r WHERE r.batch < k.batch) AS before FROM (SELECT DISTINCT batch FROM r) k),
judged AS (SELECT r.*, before, coalesce(us <= before - 3600000000, false) AS late FROM r JOIN clock USING (batch))
SELECT j.event_id, j.name, j.late, CASE WHEN j.late THEN before - us END AS lag_us,
  CASE WHEN j.late THEN (SELECT count(*) FROM judged o WHERE o.name = j.name AND NOT o.late AND o.batch <= j.batch
                         AND o.us > j.before - 3600000000 AND o.us <= j.before) END AS count
FROM judged j""")
def q_late_rows(spark, d):
    """Every mention is counted or kept as late, with its lag and its name's count at that time."""
    base = _split_run(spark, d, horizon_ms=400 * DAY_MS, delay=_DELAY)
    updates = split_updates(spark, base).filter(F.col("event_id").isNotNull()).select("event_id", "name", "kind", "count")
    lag = read_late(spark, base).select("event_id", "lag_us")
    late = F.col("kind") == "late"
    return updates.join(lag, "event_id", "left").select("event_id", "name", late.alias("late"), "lag_us",
                                                        F.when(late, F.col("count")).alias("count"))


@query("changelog_least", _CLOCK_SQL + "SELECT kind, min(count) AS least, count(*) AS updates FROM changelog GROUP BY kind")
def q_changelog_least(spark, d):
    """No update of the histogram is below zero."""
    return _batches_run(spark, d).groupBy("kind").agg(F.min("count").alias("least"),
                                                      F.count(F.lit(1)).alias("updates"))


def _top100_run(spark: SparkSession, d: str) -> str:
    base = scratch_path(spark, "top100")
    _batches_run(spark, d, then=Top100Writer(base))
    return base


@query("delta_message", _CLOCK_SQL + f""", changes AS (
  SELECT coalesce(c.batch, p.batch + 1) AS batch, coalesce(c.name, p.name) AS name, coalesce(c.count, 0) AS count
  FROM live c FULL JOIN live p ON c.batch = p.batch + 1 AND c.name = p.name
  WHERE c.count IS DISTINCT FROM p.count)
SELECT batch AS batch_id, {_MESSAGE_SQL} FROM changes WHERE batch < {SLICES} GROUP BY batch""")
def q_delta_message(spark, d):
    return messages(spark, _top100_run(spark, d))


@query("snapshot_message", _CLOCK_SQL + f"""SELECT batch AS batch_id, {_MESSAGE_SQL}
FROM live WHERE batch = (SELECT max(batch) FROM clock) GROUP BY batch""")
def q_snapshot_message(spark, d):
    return latest_snapshot(spark, _top100_run(spark, d))


@query("stream_sliding_histogram", SLIDING_SQL)
def q_stream_sliding_histogram(spark, d):
    # update mode: windows still open are in the table too
    table = CurrentTable(scratch_path(spark, "sliding"), "ws LONG, name STRING, count LONG", ["ws", "name"])
    _run_slices(spark, _event_mentions(spark, d), EVENT_STREAM_SCHEMA,
                lambda s: sliding_counts_stream(s, "1 hour", "15 minutes").writeStream.outputMode("update")
                .foreachBatch(table))
    return table.current(spark)


@query("stream_apply_increments", """SELECT event_type AS name, CAST(sum(1 + CAST(floor(value) AS BIGINT) % 3) AS BIGINT) AS count
FROM events GROUP BY 1""")
def q_stream_apply_increments(spark, d):
    ev = D.table(spark, d, "events")
    inc = ev.select(F.col("event_type").alias("name"),
                    (F.lit(1) + F.pmod(F.floor("value").cast("bigint"), F.lit(3))).cast("int").alias("increment"),
                    TM.micros(F.col("ts").cast("timestamp")).alias("_us"))
    table = CurrentTable(scratch_path(spark, "totals"), "name STRING, count LONG", ["name"])
    _run_slices(spark, inc, "name STRING, increment INT",
                lambda s: running_totals(s).writeStream.outputMode("update").foreachBatch(table))
    return table.current(spark)


# ------------------------------------------------------------------ files written and read again
@query("read_bad_bytes", "SELECT event_id, event_type || ',' || CAST(user_id AS VARCHAR) AS item FROM events")
def q_read_bad_bytes(spark, d):
    """Bytes that aren't UTF-8 (in every third user's names) disappear, the rest of the line stays."""
    ev = D.table(spark, d, "events")
    bad = F.when(F.col("user_id") % 3 == 0, F.unhex(F.lit("FFC3"))).otherwise(F.unhex(F.lit("")))
    item = F.concat(bad, F.concat_ws(",", "event_type", F.col("user_id").cast("string")).cast("binary"), bad)
    cols = {"gkgrecordid": F.col("event_id").cast("string"), "date": F.date_format("ts", "yyyyMMddHHmmss"),
            "allNames": item.cast("string")}
    path = scratch_path(spark, "bad_bytes")
    ev.select(gkg_line(cols).alias("value")).write.text(path)
    return read_gkg_text(spark, path).select(F.col("record_key").cast("bigint").alias("event_id"),
                                             F.col("all_names").alias("item"))


@query("run_stamped_json", _TOPK_CTE + "SELECT date, topic, count, rank FROM t")
def q_run_stamped_json(spark, d):
    """K1: a run written as JSON lines under its stamp and read back."""
    top = topk.daily_topk(mentions_from_gkg(D.gkg_records(D.articles(D.table(spark, d, "events")))))
    path = write_json_run(top.select("date", "topic", "count", "rank"), scratch_path(spark, "runs"))
    return spark.read.schema("date DATE, topic STRING, count LONG, rank INT").json(path) \
        .withColumn("rank", F.col("rank").cast("bigint"))


@query("typed_view", """SELECT CAST(event_id AS VARCHAR) AS record_id, epoch_us(ts) AS ts_us, CAST(ts AS DATE) AS date,
  event_type AS topic FROM events""")
def q_typed_view(spark, d):
    """P5: the contract columns of a table with others beside them, checked by name and type."""
    wide = mentions_from_events(D.table(spark, d, "events")).withColumn("extra", F.lit(1))
    return require_columns(wide, MENTION_SCHEMA).select("record_id", TM.micros(F.col("ts")).alias("ts_us"), "date", "topic")


# ------------------------------------------------------------------ kept state and quarantine
@query("quarantined_lines", O.with_(O.ARTICLES) + """SELECT record_key, CASE WHEN record_id % 7 = 0 THEN 'short'
  WHEN record_id % 13 = 0 THEN 'long' WHEN record_id % 17 = 0 THEN 'key' WHEN record_id % 11 = 0 THEN 'date' END AS reason,
  CASE WHEN record_id % 7 <> 0 AND record_id % 13 <> 0 AND record_id % 17 <> 0 AND record_id % 11 <> 0
       THEN epoch_us(rec_ts) END AS ts_us
FROM ank""")
def q_quarantined_lines(spark, d):
    """Lines cut short, with stray tabs, without key or with a bad date beside good ones; none is lost."""
    a = D.articles(D.table(spark, d, "events"))
    n = F.col("record_id")
    key = D.article_key(a)
    cols = {"gkgrecordid": F.when(n % 17 == 0, "").otherwise(key), "extras": key,
            "date": F.when(n % 11 == 0, "2015021X").otherwise(F.date_format("rec_ts", "yyyyMMddHHmmss")),
            "allNames": F.col("all_names")}
    line = gkg_line(cols)
    line = F.when(n % 7 == 0, F.concat_ws("\t", key, F.lit("20150218"))).when(n % 13 == 0, F.concat(line, F.lit("\t"))) \
        .otherwise(line)
    path, out = scratch_path(spark, "lines"), scratch_path(spark, "judged")
    a.select(line.alias("value")).write.text(path)
    good, bad = split_records(read_gkg_judged(spark, path), out)
    fields = F.split("line", "\t")
    where = F.when(F.col("reason") == "short", fields[0]).otherwise(fields[26])
    return bad.select(where.alias("record_key"), "reason", F.lit(None).cast("bigint").alias("ts_us")).unionByName(
        good.select(F.col("gkgrecordid").alias("record_key"), F.lit(None).cast("string").alias("reason"),
                    TM.micros(F.col("date")).alias("ts_us")))


@query("tiers_over_parquet", TIER_SQL)
def q_tiers_over_parquet(spark, d):
    """S3 over converted records: a tier reads its days' folders only."""
    ev = D.table(spark, d, "events")
    path = scratch_path(spark, "records")
    convert_to_parquet(ev.select(F.col("event_id").cast("string").alias("gkgrecordid"),
                                 F.col("ts").cast("timestamp").alias("date"), F.col("event_type").alias("allNames")), path)
    parts = [read_gkg_parquet(spark, path, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tier"), "n")
             for t in TIER_NAMES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# phrases of the benchmark texts: what a topic may contain, or start or end with
_PATTERNS_SQL = """w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '([A-Z][a-z]+)', 1)) AS word FROM benchmark),
p AS (SELECT DISTINCT CASE length(word) % 4 WHEN 0 THEN 'contains' WHEN 1 THEN 'prefix' WHEN 2 THEN 'suffix' ELSE 'equals' END AS kind,
  CASE WHEN length(word) % 4 = 3 THEN word WHEN length(word) % 4 = 2 THEN right(word, 4) WHEN length(word) % 4 = 1 THEN left(word, 4)
       ELSE substr(word, 2, 4) END AS pattern FROM w WHERE length(word) >= 4)"""


@query("topk_pattern_stoplist", O.with_(O.DOC_TOPICS, _PATTERNS_SQL, """bad AS (SELECT DISTINCT topic FROM
  (SELECT DISTINCT topic FROM dt) t JOIN p ON CASE kind WHEN 'contains' THEN contains(topic, pattern)
    WHEN 'prefix' THEN starts_with(topic, pattern) WHEN 'suffix' THEN suffix(topic, pattern) ELSE topic = pattern END)""",
    "c AS (SELECT date, topic, count(*) AS count FROM dt WHERE topic NOT IN (SELECT topic FROM bad) GROUP BY 1, 2)")
    + O.topk_select("c"))
def q_topk_pattern_stoplist(spark, d):
    """A stoplist of phrases, run over the distinct topics in one pass."""
    bench = D.table(spark, d, "benchmark")
    word = bench.select(F.explode(F.regexp_extract_all("text", F.lit("([A-Z][a-z]+)"), F.lit(1))).alias("word")) \
        .filter(F.length("word") >= 4).distinct()
    rest = F.length("word") % 4
    kind = F.when(rest == 0, "contains").when(rest == 1, "prefix").when(rest == 2, "suffix").otherwise("equals")
    pattern = (F.when(rest == 3, F.col("word")).when(rest == 2, F.right("word", F.lit(4)))
               .when(rest == 1, F.left("word", F.lit(4))).otherwise(F.substring("word", 2, 4)))
    return stoplist.daily_topk_without_patterns(D.document_topics(D.table(spark, d, "documents")),
                                                word.select(pattern.alias("pattern"), kind.alias("kind")))


SKETCH_DAYS = ("2024-01-08", "2024-01-21")


@query("article_sketch_range", O.with_(O.ARTICLES, O.article_mentions()) + f"""SELECT topic, count(DISTINCT record_id) AS articles,
  true AS near FROM am WHERE date BETWEEN DATE '{SKETCH_DAYS[0]}' AND DATE '{SKETCH_DAYS[1]}' GROUP BY topic""")
def q_article_sketch_range(spark, d):
    """A8 over a range of days from stored sketches, with the exact count beside it; ``near``: within three sigmas."""
    m = mentions_from_gkg(D.gkg_records(D.articles(D.table(spark, d, "events"))))
    path = scratch_path(spark, "sketches")
    sketches.store_sketches(sketches.article_sketches(m), path)
    kept = sketches.articles_between(spark, path, *SKETCH_DAYS).withColumnRenamed("articles", "estimate")
    exact = m.filter(F.col("date").between(*[F.to_date(F.lit(x)) for x in SKETCH_DAYS])) \
        .groupBy("topic").agg(F.count_distinct("record_id").alias("articles"))
    off = F.abs(F.col("estimate") - F.col("articles"))
    return exact.join(kept, "topic").select("topic", "articles", (off <= F.col("articles") * sketches.relative_error()).alias("near"))


@query("incremental_topk", O.with_(O.ARTICLES, O.article_mentions(), O.counts_cte("am")) + O.topk_select("c"))
def q_incremental_topk(spark, d):
    """T1 over S8: the records come in four slices of time, each merged into the stored counts."""
    records = D.gkg_records(D.articles(D.table(spark, d, "events"))).withColumn("_us", TM.micros(F.col("date")))
    records = spark.read.parquet(_written(records, scratch_path(spark, "records")))
    lo, hi = records.agg(F.min("_us"), F.max("_us")).first()
    store = DailyTopk(scratch_path(spark, "daily"))
    for k in range(SLICES):
        mine = F.coalesce(F.expr(f"(_us - {lo or 0}L) * {SLICES} div {(hi or 0) - (lo or 0) + 1}L"), F.lit(0)) == k
        store.update(spark, mentions_from_gkg(records.filter(mine).drop("_us")), k)
    return store.top(spark, SLICES - 1)


def _written(df: DataFrame, path: str) -> str:
    df.write.parquet(path)
    return path
