"""The query catalogue: every operator of the inventory over the driver tables.

Each entry is ``name -> (build(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
Queries read whole tables; a ``limit`` appears only where top-n is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.functions import names as N
from mentionlab.functions import times as TM
from mentionlab.functions.text import format_row
from mentionlab.operators import basics, changes, histogram, profile, replay, topk
from mentionlab.operators.mentions import (explode_items, mentions_from_events, mentions_from_gkg,
                                           mentions_from_text, project_records)
from mentionlab.plans import derived as D
from mentionlab.plans import oracle as O
from mentionlab.plans.ranking import stable
from mentionlab.sources import segments
from mentionlab.sources.gkg import java_width, text_records, tier_counts
from mentionlab.sources.letters import letters_from

Builder = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Builder, str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        if name in CATALOG:
            raise KeyError(f"duplicate query {name}")
        CATALOG[name] = (fn, sql)
        return fn
    return deco


def _events(spark, d):
    return D.table(spark, d, "events")


def _articles(spark, d):
    return D.articles(_events(spark, d))


def _article_mentions(spark, d, rule="last_offset"):
    return mentions_from_gkg(D.gkg_records(_articles(spark, d)), rule)


def _doc_hist(spark, d):
    return histogram.totals(D.document_topics(D.table(spark, d, "documents")))


# ------------------------------------------------------------------ top-k
@query("daily_topk", O.with_(O.ARTICLES, O.article_mentions(), O.counts_cte("am")) + O.topk_select("c"))
def q_daily_topk(spark, d):
    return topk.daily_topk(_article_mentions(spark, d))


@query("daily_topk_text", O.with_(O.ARTICLES, O.article_mentions("head"), O.counts_cte("am"))
       + O.topk_select("c"))
def q_daily_topk_text(spark, d):
    lines = D.gkg_lines(_articles(spark, d))
    return topk.daily_topk(mentions_from_text(text_records(lines)))


@query("document_topk", O.with_(O.DOC_TOPICS, "c AS (SELECT date, topic, count(*) AS count FROM dt GROUP BY 1, 2)")
       + O.topk_select("c"))
def q_document_topk(spark, d):
    return topk.daily_topk(D.document_topics(D.table(spark, d, "documents")))


@query("shipday_topk", O.with_("""c AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date, p.p_name AS topic, count(*) AS count
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2)""") + O.topk_select("c"))
def q_shipday_topk(spark, d):
    li = D.table(spark, d, "lineitem")
    part = D.table(spark, d, "part")
    # pre-aggregate before the join: a hot part key shrinks to one row per day
    per_part = li.groupBy(F.to_date("l_shipdate").alias("date"), "l_partkey").agg(
        F.count(F.lit(1)).alias("n"))
    joined = per_part.join(part.select("p_partkey", "p_name"), per_part.l_partkey == part.p_partkey)
    counts = joined.groupBy("date", F.col("p_name").alias("topic")).agg(F.sum("n").cast("bigint").alias("count"))
    return topk.rank_topics(counts).select("date", "topic", "count", "rank")


# ------------------------------------------------------------------ counts
@query("mention_counts", O.with_(O.EVENT_MENTIONS) + "SELECT date, topic, count(*) AS count FROM m GROUP BY 1, 2")
def q_mention_counts(spark, d):
    return topk.mention_counts(mentions_from_events(_events(spark, d)))


@query("mention_counts_text", O.with_(O.ARTICLES, O.article_mentions("head"))
       + "SELECT date, topic, count(*) AS count FROM am GROUP BY 1, 2")
def q_mention_counts_text(spark, d):
    lines = D.gkg_lines(_articles(spark, d))
    return topk.mention_counts(mentions_from_text(text_records(lines)))


@query("article_counts", O.with_(O.ARTICLES, O.article_mentions())
       + "SELECT date, topic, count(DISTINCT record_id) AS articles FROM am GROUP BY 1, 2")
def q_article_counts(spark, d):
    return topk.article_counts(_article_mentions(spark, d))


@query("daily_topk_articles", O.with_(O.ARTICLES, O.article_mentions(),
                                     "c AS (SELECT date, topic, count(DISTINCT record_id) AS count FROM am GROUP BY 1, 2)")
       + O.topk_select("c"))
def q_daily_topk_articles(spark, d):
    return topk.daily_topk_articles(_article_mentions(spark, d))


# ------------------------------------------------------------------ stoplist, pivot, extent, spine
STOPLIST = ["error"]


@query("topk_stoplist", O.with_(O.ARTICLES, O.article_mentions(),
                               "c AS (SELECT date, topic, count(*) AS count FROM am WHERE topic NOT IN ('error') GROUP BY 1, 2)")
       + O.topk_select("c"))
def q_topk_stoplist(spark, d):
    stop = spark.createDataFrame([(s,) for s in STOPLIST], "topic STRING")
    return topk.daily_topk_without(_article_mentions(spark, d), stop)


_PIVOT_SQL = O.with_(O.ARTICLES, O.article_mentions(), O.counts_cte("am"), "t AS (" + O.topk_select("c") + ")") + \
    "SELECT date, " + ", ".join(f"max(CASE WHEN rank = {i} THEN topic END) AS r{i}" for i in range(1, 11)) + \
    " FROM t GROUP BY date"


@query("topk_pivot", _PIVOT_SQL)
def q_topk_pivot(spark, d):
    return topk.topk_pivot(topk.daily_topk(_article_mentions(spark, d)))


@query("date_extent", O.with_(O.ARTICLES, O.article_mentions(), O.counts_cte("am"), "t AS (" + O.topk_select("c") + ")")
       + "SELECT min(date) AS first_date, max(date) AS last_date FROM t")
def q_date_extent(spark, d):
    return topk.date_extent(topk.daily_topk(_article_mentions(spark, d)))


_SPINE_SQL = O.with_(
    O.ARTICLES, O.article_mentions(),
    "c AS (SELECT date, topic, count(*) AS count FROM am GROUP BY 1, 2)",
    "t AS (" + O.topk_select("c") + ")",
    "days AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM t)",
    "slots AS (SELECT date, unnest(range(1, 11)) AS rank FROM days)",
) + """SELECT s.date, CAST(s.rank AS BIGINT) AS rank, coalesce(t.topic, '') AS topic
FROM slots s LEFT JOIN t ON s.date = t.date AND s.rank = t.rank"""


@query("date_spine_topics", _SPINE_SQL)
def q_date_spine_topics(spark, d):
    # every day of the span gets ten label rows; ranks past a day's topics (and days
    # without mentions) read ''
    return topk.spine_topics(topk.daily_topk(_article_mentions(spark, d)))


# ------------------------------------------------------------------ projections and filters
@query("project_mentions", O.with_(O.ARTICLES)
       + "SELECT record_key AS record_id, epoch_us(rec_ts) AS ts_us, all_names FROM ank")
def q_project_mentions(spark, d):
    rec = project_records(D.gkg_records(_articles(spark, d)))
    return rec.select("record_id", TM.micros(F.col("ts")).alias("ts_us"), "all_names")


_WIDTH_SQL = O.with_(O.ARTICLES, f"""lines AS (
  SELECT record_key,
         CASE WHEN first_type = 'signup'
              THEN concat_ws(chr(9), record_key, strftime(rec_ts, '%Y%m%d%H%M%S'), '1', 'events')
              ELSE {O.gkg_line_sql({**O.LINE_COLS, 'allNames': "CASE WHEN first_type = 'view' THEN '' ELSE all_names END"})}
         END AS value
  FROM ank)""") + \
    "SELECT record_key FROM lines WHERE len(string_split(regexp_replace(value, '\\t+$', ''), chr(9))) > 23"


@query("filter_width", _WIDTH_SQL)
def q_filter_width(spark, d):
    a = _articles(spark, d)
    lines = D.gkg_lines(a, short_when=a["first_type"] == "signup", empty_names_when=a["first_type"] == "view")
    return lines.filter(java_width(F.col("value")) > 23).select("record_key")


@query("filter_nulls", O.with_(O.ARTICLES) + """SELECT record_key AS record_id, CAST(rec_ts AS DATE) AS date
FROM (SELECT record_key, CASE WHEN first_type = 'signup' THEN NULL ELSE rec_ts END AS rec_ts,
             CASE WHEN first_type = 'view' THEN NULL ELSE all_names END AS all_names FROM ank)
WHERE rec_ts IS NOT NULL AND all_names IS NOT NULL""")
def q_filter_nulls(spark, d):
    a = _articles(spark, d)
    recs = D.gkg_records(a, date=F.when(a["first_type"] != "signup", a["rec_ts"]),
                         names=F.when(a["first_type"] != "view", a["all_names"]))
    kept = project_records(recs).filter(F.col("ts").isNotNull() & F.col("all_names").isNotNull())
    return kept.select("record_id", TM.day_of(F.col("ts")).alias("date"))


FILTER_TS = "1997-08-23 00:00:00"
_TS_SQL = f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate = TIMESTAMP '{FILTER_TS}'"


@query("filter_ts_sql", _TS_SQL)
def q_filter_ts_sql(spark, d):
    D.table(spark, d, "orders").createOrReplaceTempView("orders_for_filter")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM orders_for_filter "
                     f"WHERE o_orderdate = TIMESTAMP_NTZ '{FILTER_TS}'")


@query("filter_ts_df", _TS_SQL)
def q_filter_ts_df(spark, d):
    o = D.table(spark, d, "orders")
    return o.filter(F.col("o_orderdate") == F.to_timestamp_ntz(F.lit(FILTER_TS))) \
        .select("o_orderkey", "o_totalprice")


# ------------------------------------------------------------------ letters
_LETTERS_CTE = "lt AS (SELECT chr(CAST(97 + event_id % 26 AS INTEGER)) AS chr, event_id + 1 AS num FROM events)"


def _letters(spark, d):
    ev = _events(spark, d)
    return letters_from(ev, F.col("event_id") + 1)


@query("letters_fixture", O.with_(_LETTERS_CTE) + "SELECT chr, num FROM lt")
def q_letters_fixture(spark, d):
    return _letters(spark, d)


@query("map_increment", O.with_(_LETTERS_CTE) + "SELECT chr, num + 1 AS num FROM lt")
def q_map_increment(spark, d):
    return basics.map_increment(_letters(spark, d))


@query("letter_sums", O.with_(_LETTERS_CTE) + "SELECT chr, CAST(sum(num) AS BIGINT) AS total FROM lt GROUP BY chr")
def q_letter_sums(spark, d):
    return basics.sum_by_key(_letters(spark, d), "chr", "num")


# ------------------------------------------------------------------ scalar functions
@query("day_of", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def q_day_of(spark, d):
    return _events(spark, d).select("event_id", TM.day_of(F.col("ts")).alias("day"))


_KEY_SQL = "(strftime(ts, '%Y%m%d%H%M%S') || '-' || CAST(event_id AS VARCHAR))"


@query("prefix_keys", f"SELECT event_id, substr({_KEY_SQL}, 1, 8) AS day_key, substr({_KEY_SQL}, 1, 12) AS minute_key FROM events")
def q_prefix_keys(spark, d):
    ev = _events(spark, d)
    key = TM.record_key(F.col("ts"), F.col("event_id"))
    return ev.select("event_id", TM.day_key(key).alias("day_key"), TM.minute_key(key).alias("minute_key"))


@query("split_mentions", O.with_(O.ARTICLES)
       + "SELECT record_key AS record_id, len(regexp_extract_all(all_names, '[^;]+', 0)) AS n_items FROM ank")
def q_split_mentions(spark, d):
    rec = project_records(D.gkg_records(_articles(spark, d)))
    return rec.select("record_id", N.mention_count(F.col("all_names")).cast("bigint").alias("n_items"))


def _items_sql(expr: str) -> str:
    return O.with_(O.ARTICLES, """items AS (
  SELECT record_key, unnest(string_split(all_names, ';')) AS item,
         unnest(range(1, len(string_split(all_names, ';')) + 1)) AS pos FROM ank)""") + \
        f"SELECT record_key AS record_id, CAST(pos AS BIGINT) AS pos, {expr} FROM items"


def _items(spark, d):
    rec = project_records(D.gkg_records(_articles(spark, d)))
    return explode_items(rec, with_pos=True)


@query("explode_mentions", _items_sql("item"))
def q_explode_mentions(spark, d):
    return _items(spark, d).select("record_id", "pos", "item")


@query("strip_offset_regex", _items_sql("regexp_replace(item, ',[0-9]+', '', 'g') AS topic"))
def q_strip_offset_regex(spark, d):
    return _items(spark, d).select("record_id", "pos", N.strip_all_offsets(F.col("item")).alias("topic"))


@query("strip_offset_head", _items_sql("split_part(item, ',', 1) AS topic"))
def q_strip_offset_head(spark, d):
    return _items(spark, d).select("record_id", "pos", N.head_name(F.col("item")).alias("topic"))


_RAWKEY = ("CAST(event_id AS VARCHAR) || '-' || CASE event_type WHEN 'error' THEN 'x' || CAST(user_id AS VARCHAR) "
           "WHEN 'view' THEN CAST(user_id AS VARCHAR) || '-0' WHEN 'signup' THEN '' ELSE CAST(user_id AS VARCHAR) END")


@query("parse_record_key", f"""WITH k AS (SELECT event_id, {_RAWKEY} AS key FROM events),
p AS (SELECT event_id, split_part(key, '-', 1) AS pa, split_part(key, '-', 2) AS pb,
             len(string_split(key, '-')) AS parts FROM k),
q AS (SELECT event_id, parts, TRY_CAST(pa AS BIGINT) AS a0, TRY_CAST(pb AS BIGINT) AS b0,
             regexp_matches(pa, '^\\+?[0-9]+$') AND regexp_matches(pb, '^\\+?[0-9]+$') AS digits FROM p)
SELECT event_id, CASE WHEN parts = 2 AND digits AND a0 IS NOT NULL AND b0 IS NOT NULL THEN a0 ELSE 0 END AS a,
       CASE WHEN parts = 2 AND digits AND a0 IS NOT NULL AND b0 IS NOT NULL THEN b0 ELSE 0 END AS b FROM q""")
def q_parse_record_key(spark, d):
    ev = _events(spark, d)
    uid = F.col("user_id").cast("string")
    tail = (F.when(F.col("event_type") == "error", F.concat(F.lit("x"), uid))
            .when(F.col("event_type") == "view", F.concat(uid, F.lit("-0")))
            .when(F.col("event_type") == "signup", F.lit(""))
            .otherwise(uid))
    key = F.concat(F.col("event_id").cast("string"), F.lit("-"), tail)
    return ev.select("event_id", TM.parse_record_key(key).alias("k")).select("event_id", "k.a", "k.b")


_BOUNDARY_SQL = "(time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE)"


@query("next_boundary", f"SELECT event_id, epoch_us({_BOUNDARY_SQL}) AS boundary_us FROM events")
def q_next_boundary(spark, d):
    return _events(spark, d).select("event_id", TM.micros(TM.next_boundary(F.col("ts"))).alias("boundary_us"))


@query("seconds_to_boundary",
       f"SELECT event_id, greatest((epoch_us({_BOUNDARY_SQL}) // 1000 - epoch_us(ts) // 1000) // 1000, 1) AS seconds FROM events")
def q_seconds_to_boundary(spark, d):
    return _events(spark, d).select("event_id", TM.seconds_to_boundary(F.col("ts")).alias("seconds"))


@query("format_rows", "SELECT o_orderkey, concat_ws(' ', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), "
       "o_orderstatus, o_orderpriority) AS line FROM orders")
def q_format_rows(spark, d):
    o = D.table(spark, d, "orders")
    return o.select("o_orderkey", format_row(F.col("o_orderkey"), F.col("o_custkey"),
                                             F.col("o_orderstatus"), F.col("o_orderpriority")).alias("line"))


# ------------------------------------------------------------------ segments
@query("segment_grid", """WITH polls AS (SELECT DISTINCT time_bucket(INTERVAL 15 MINUTE, ts) AS q FROM events)
SELECT strftime(q, '%Y%m%d%H%M00') AS poll, strftime(s, '%Y%m%d%H%M00') || '.gkg.csv' AS file_name
FROM (SELECT q, unnest(generate_series(q - INTERVAL 60 MINUTE, q - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS s FROM polls)""")
def q_segment_grid(spark, d):
    polls = _events(spark, d).select(TM.interval_start(F.col("ts")).alias("q")).distinct()
    grid = polls.select("q", F.explode(TM.lookback_segments(F.col("q"))).alias("s"))
    return grid.select(F.date_format("q", TM.SEGMENT_NAME_FORMAT).alias("poll"),
                       TM.segment_name(F.col("s")).alias("file_name"))


MANIFEST_N = 100


@query("segment_manifest", f"""SELECT page_id, regexp_extract(url, '{segments.HOST_PATTERN}', 1) AS host,
  regexp_extract(url, '{segments.PATH_PATTERN}', 1) AS path,
  regexp_extract(url, '{segments.SEGMENT_PATH_PATTERN}', 0) AS segment_path
FROM pages ORDER BY page_id LIMIT {MANIFEST_N}""")
def q_segment_manifest(spark, d):
    return segments.manifest(D.table(spark, d, "pages"), "page_id", n=MANIFEST_N)


LAST_SEGMENT = "20240115000000"


@query("incremental_segments", f"""SELECT event_id, seg FROM (
  SELECT event_id, strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M00') || '.gkg.csv' AS seg FROM events)
WHERE substr(seg, 1, 14) > '{LAST_SEGMENT}'""")
def q_incremental_segments(spark, d):
    ev = _events(spark, d).select("event_id", TM.segment_name(TM.interval_start(F.col("ts"))).alias("seg"))
    return ev.filter(segments.newer_than(F.col("seg"), LAST_SEGMENT))


TIER_SQL = """WITH s AS (SELECT min(ts) AS t0 FROM events)
SELECT t.tier, count(*) FILTER (CASE t.tier
    WHEN 'small' THEN time_bucket(INTERVAL 15 MINUTE, ts) = time_bucket(INTERVAL 15 MINUTE, t0)
    WHEN 'medium' THEN date_trunc('month', ts) = date_trunc('month', t0)
    WHEN 'large' THEN year(ts) = year(t0) AND month(ts) <= 6
    WHEN 'xlarge' THEN year(ts) = year(t0)
    ELSE ts IS NOT NULL END) AS n
FROM events, s, (VALUES ('small'), ('medium'), ('large'), ('xlarge'), ('full'), ('local')) t(tier) GROUP BY t.tier"""


@query("scan_tiers", TIER_SQL)
def q_scan_tiers(spark, d):
    return tier_counts(_events(spark, d))


@query("last_key", f"""SELECT user_id, coalesce(arg_max({_KEY_SQL}, event_id), '{TM.DEFAULT_LAST_KEY}') AS last_key
FROM events GROUP BY user_id""")
def q_last_key(spark, d):
    ev = _events(spark, d).withColumn("key", TM.record_key(F.col("ts"), F.col("event_id")))
    return segments.last_keys(ev, "user_id", "key", "event_id")


# ------------------------------------------------------------------ profile (K7)
@query("dataset_profile", O.with_(O.EVENT_MENTIONS) + """, p AS (SELECT
  CAST(count(*) AS VARCHAR) AS "rows", CAST(count_if(date IS NULL) AS VARCHAR) AS null_dates,
  CAST(count_if(topic IS NULL) AS VARCHAR) AS null_topics, CAST(count(DISTINCT topic) AS VARCHAR) AS topics,
  CAST(count(DISTINCT record_id) AS VARCHAR) AS records, CAST(min(date) AS VARCHAR) AS first_date,
  CAST(max(date) AS VARCHAR) AS last_date FROM m)
UNPIVOT p ON "rows", null_dates, null_topics, topics, records, first_date, last_date INTO NAME metric VALUE value""")
def q_dataset_profile(spark, d):
    return profile.mentions_profile(mentions_from_events(_events(spark, d)))


# ------------------------------------------------------------------ histograms
@query("histogram_sorted", O.with_(O.DOC_TOPICS)
       + "SELECT name, count, row_number() OVER (ORDER BY count DESC, name) AS pos FROM doc_hist")
def q_histogram_sorted(spark, d):
    return histogram.sorted_histogram(_doc_hist(spark, d))


@query("first_n", O.with_(O.DOC_TOPICS)
       + "SELECT name, count, row_number() OVER (ORDER BY count DESC, name) AS pos FROM doc_hist ORDER BY count DESC, name LIMIT 10")
def q_first_n(spark, d):
    return histogram.first_n(_doc_hist(spark, d), 10)


@query("histogram_top100", O.with_(O.DOC_TOPICS)
       + "SELECT name, count, row_number() OVER (ORDER BY count DESC, name) AS rank FROM doc_hist ORDER BY count DESC, name LIMIT 100")
def q_histogram_top100(spark, d):
    return histogram.top_entries(_doc_hist(spark, d), 100)


@query("histogram_max", O.with_(O.DOC_TOPICS) + "SELECT name, count FROM doc_hist ORDER BY count DESC, name LIMIT 1")
def q_histogram_max(spark, d):
    return histogram.histogram_max(_doc_hist(spark, d))


@query("histogram_min", O.with_(O.DOC_TOPICS) + "SELECT name, count FROM doc_hist ORDER BY count, name LIMIT 1")
def q_histogram_min(spark, d):
    return histogram.histogram_min(_doc_hist(spark, d))


# ------------------------------------------------------------------ replay
def _segmented_events(spark, d):
    return _events(spark, d).select("event_id", TM.interval_start(F.col("ts")).alias("seg_start"))


_SEG_SQL = """WITH s AS (SELECT event_id, time_bucket(INTERVAL 15 MINUTE, ts) AS seg FROM events),
r AS (SELECT event_id, seg, row_number() OVER (PARTITION BY seg ORDER BY event_id) - 1 AS i,
             count(*) OVER (PARTITION BY seg) AS n FROM s)
"""


@query("spread_timestamps", _SEG_SQL + "SELECT event_id, epoch_ms(seg) + i * (900000 // n) AS ms FROM r")
def q_spread_timestamps(spark, d):
    ev = _segmented_events(spark, d)
    return replay.spread_timestamps(ev, "seg_start", F.col("seg_start"), "event_id").select("event_id", "ms")


@query("replay_schedule", _SEG_SQL + "SELECT event_id, (i * 900) // n AS send_second FROM r")
def q_replay_schedule(spark, d):
    return replay.replay_schedule(_segmented_events(spark, d), "seg_start", "event_id") \
        .select("event_id", "send_second")


# ------------------------------------------------------------------ windows over time
TRAILING_SQL = """SELECT event_id, event_type AS name, count(*) OVER (
  PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW) AS count
FROM events"""


@query("trailing_hour_counts", TRAILING_SQL)
def q_trailing_hour_counts(spark, d):
    out = histogram.trailing_counts(_events(spark, d), "event_type", "ts", "event_id")
    return out.select("event_id", F.col("event_type").alias("name"), "count")


SLIDING_SQL = """WITH b AS (SELECT event_type AS name,
  unnest([time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 45 MINUTE, time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 30 MINUTE,
          time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE, time_bucket(INTERVAL 15 MINUTE, ts)]) AS ws FROM events)
SELECT epoch_us(ws) AS ws, name, count(*) AS count FROM b GROUP BY ws, name"""


@query("sliding_hour_histogram", SLIDING_SQL)
def q_sliding_hour_histogram(spark, d):
    from mentionlab.streaming.sliding import sliding_counts
    m = _events(spark, d).select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("name"))
    return sliding_counts(m, "1 hour", "15 minutes")


@query("late_data_policy", """SELECT event_id, (epoch_us((SELECT max(ts) FROM events)) // 1000 - epoch_us(ts) // 1000) // 1000 < 3600 AS admitted
FROM events""")
def q_late_data_policy(spark, d):
    ev = _events(spark, d)
    now = ev.select(F.max("ts")).scalar()
    return ev.select("event_id", TM.admitted(F.col("ts"), now).alias("admitted"))


# ------------------------------------------------------------------ change logs
_TOPCHANGE_SQL = O.with_(
    "dt AS (SELECT doc_id, DATE '2015-02-18' + CAST(doc_id % 7 AS INTEGER) AS date, "
    "unnest(regexp_extract_all(text, '([A-Z][a-z]+)', 1)) AS topic FROM documents)",
    "prev AS (SELECT topic AS name, count(*) AS count FROM dt WHERE date < DATE '2015-02-24' GROUP BY 1 ORDER BY count DESC, name LIMIT 100)",
    "cur AS (SELECT topic AS name, count(*) AS count FROM dt GROUP BY 1 ORDER BY count DESC, name LIMIT 100)",
) + """SELECT coalesce(c.name, p.name) AS name, CASE WHEN c.name IS NULL THEN 0 ELSE c.count END AS count
FROM prev p FULL OUTER JOIN cur c ON p.name = c.name
WHERE c.name IS NULL OR p.name IS NULL OR p.count <> c.count"""


@query("top100_changes", _TOPCHANGE_SQL)
def q_top100_changes(spark, d):
    t = D.document_topics(D.table(spark, d, "documents"))
    # both snapshots from one pass over the texts; the per-name table is materialised once
    # so the two branches do not each run the regex
    both = stable(t.groupBy(F.col("topic").alias("name")).agg(
        F.count_if(F.col("date") < F.lit("2015-02-24").cast("date")).alias("_prev"),
        F.count(F.lit(1)).alias("_cur")))
    prev = both.filter(F.col("_prev") > 0).select("name", F.col("_prev").alias("count"))
    cur = both.select("name", F.col("_cur").alias("count"))
    return changes.top_changes(prev, cur, 100)


def _updates(spark, d):
    ev = _events(spark, d)
    return ev.select(F.col("event_id").alias("seq"), F.col("event_type").alias("name"),
                     F.floor("value").cast("bigint").alias("count"),
                     TM.micros(F.date_trunc("hour", "ts")).alias("bucket"),
                     F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"))


@query("latest_per_name", """SELECT epoch_us(date_trunc('hour', ts)) AS bucket, event_type AS name,
  arg_max(CAST(floor(value) AS BIGINT), event_id) AS count FROM events GROUP BY 1, 2""")
def q_latest_per_name(spark, d):
    return changes.latest_per_name(_updates(spark, d), "bucket")


@query("apply_changelog", """SELECT name, count FROM (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS name, arg_max(CAST(floor(value) AS BIGINT), event_id) AS count
  FROM events GROUP BY 1) WHERE count <> 0""")
def q_apply_changelog(spark, d):
    return changes.apply_changelog(_updates(spark, d), name_col="user")


@query("apply_increments", """SELECT event_type AS name, CAST(sum(1 + CAST(floor(value) AS BIGINT) % 3) AS BIGINT) AS count
FROM events GROUP BY 1""")
def q_apply_increments(spark, d):
    ev = _events(spark, d).select(F.col("event_type").alias("name"),
                                  (F.lit(1) + F.pmod(F.floor("value").cast("bigint"), F.lit(3))).alias("increment"))
    return changes.apply_increments(ev)


# ------------------------------------------------------------------ manual operations
_JOIN_SQL = "SELECT o.o_orderkey, c.c_custkey, c.c_mktsegment FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"


def _join(spark, d, strategy):
    o = D.table(spark, d, "orders")
    c = D.table(spark, d, "customer")
    return basics.join_inner(o, c, "o_custkey", "c_custkey", strategy).select("o_orderkey", "c_custkey", "c_mktsegment")


@query("join_inner", _JOIN_SQL)
def q_join_inner(spark, d):
    return _join(spark, d, None)


@query("join_merge", _JOIN_SQL)
def q_join_merge(spark, d):
    return _join(spark, d, "merge")


@query("cogroup_counts", """WITH l AS (SELECT o_custkey AS key, count(*) AS n_left FROM orders GROUP BY 1),
r AS (SELECT c_custkey AS key, count(*) AS n_right FROM customer GROUP BY 1)
SELECT coalesce(l.key, r.key) AS key, coalesce(n_left, 0) AS n_left, coalesce(n_right, 0) AS n_right
FROM l FULL OUTER JOIN r ON l.key = r.key""")
def q_cogroup_counts(spark, d):
    return basics.cogroup_counts(D.table(spark, d, "orders"), D.table(spark, d, "customer"), "o_custkey", "c_custkey")


@query("group_collect", """WITH r AS (SELECT o_custkey, o_orderkey,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders)
SELECT o_custkey, i // 1024 AS part, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS items
FROM r GROUP BY 1, 2""")
def q_group_collect(spark, d):
    return basics.group_collect(D.table(spark, d, "orders"), "o_custkey", "o_orderkey")


@query("combine_mean", """SELECT l_returnflag, count(l_quantity) AS n, sum(l_quantity) AS total,
  sum(l_quantity) / count(l_quantity) AS mean FROM lineitem GROUP BY 1""")
def q_combine_mean(spark, d):
    return basics.combine_mean(D.table(spark, d, "lineitem"), "l_returnflag", "l_quantity")


@query("distinct_topics", O.with_(O.DOC_TOPICS) + "SELECT DISTINCT topic FROM dt")
def q_distinct_topics(spark, d):
    return basics.distinct_values(D.document_topics(D.table(spark, d, "documents")), "topic")


@query("topics_both_days", O.with_(O.DOC_TOPICS)
       + "SELECT topic FROM dt WHERE date < DATE '2015-02-21' INTERSECT SELECT topic FROM dt WHERE date >= DATE '2015-02-21'")
def q_topics_both_days(spark, d):
    t = D.document_topics(D.table(spark, d, "documents"))
    # topics seen both before and from 2015-02-21: the two periods cover every document
    split = F.lit("2015-02-21").cast("date")
    return basics.values_in_both(t, "topic", F.col("date") < split, F.col("date") >= split)


@query("partition_map", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem")
def q_partition_map(spark, d):
    return basics.partition_map(D.table(spark, d, "lineitem"))


@query("repartition_identity", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders""")
def q_repartition_identity(spark, d):
    o = D.table(spark, d, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return basics.reshuffle(o, keys=["o_orderkey"])


def catalog() -> dict[str, tuple[Builder, str | None]]:
    # streaming and file-backed entries register themselves on import
    from mentionlab.plans import catalog_io  # noqa: F401
    return CATALOG


# ------------------------------------------------------------------ variants of the same operators
@query("histogram_by_name", O.with_(O.DOC_TOPICS)
       + "SELECT name, count, row_number() OVER (ORDER BY name) AS pos FROM doc_hist")
def q_histogram_by_name(spark, d):
    return histogram.sorted_histogram(_doc_hist(spark, d), by="name", descending=False)


@query("combine_mean_pandas", "SELECT l_returnflag, sum(l_quantity) / count(l_quantity) AS mean FROM lineitem GROUP BY 1")
def q_combine_mean_pandas(spark, d):
    return basics.combine_mean_pandas(D.table(spark, d, "lineitem"), "l_returnflag", "l_quantity")


@query("segment_times", """SELECT DISTINCT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M00') || '.gkg.csv' AS file_name,
  epoch_us(time_bucket(INTERVAL 15 MINUTE, ts)) AS start_us FROM events""")
def q_segment_times(spark, d):
    names = _events(spark, d).select(TM.segment_name(TM.interval_start(F.col("ts"))).alias("file_name")).distinct()
    return names.select("file_name", TM.micros(TM.segment_time(F.col("file_name"))).alias("start_us"))
