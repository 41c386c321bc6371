"""Quarantine, tiers over converted records, pattern stoplists, article sketches, incremental top-k."""

import datetime as dt
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mentionlab.__main__ import main
from mentionlab.operators import sketches, stoplist, topk
from mentionlab.operators.daily_state import DailyTopk
from mentionlab.schemas import GKG_COLUMNS
from mentionlab.sources.gkg import convert_to_parquet, read_gkg_csv, read_gkg_parquet
from mentionlab.sources.quarantine import bad_line_counts, read_gkg_judged, split_records
from tests.test_segments import write_segment
from tests.test_sources import gkg_row, write_lines

MENTIONS = "record_id STRING, date DATE, topic STRING"


# ---------------------------------------------------------------- quarantine
def test_bad_lines_are_kept_with_reason_and_file(spark, workdir):
    good = gkg_row("20150218230000-0", "20150218230000", 'Ann "A" Lee,3;B,9')
    lines = [good, "", "a\tb", good + "\tstray", gkg_row(" ", "20150218230000", "A,1"), gkg_row("k-1", "2015", "A,1"),
             gkg_row("k-2", "20151318230000", "A,1"), gkg_row("k-3", "20150219000000", "")]
    path = write_lines(workdir + "/gkg", lines)
    records, bad = split_records(read_gkg_judged(spark, path), workdir + "/out")
    assert records.columns == GKG_COLUMNS
    rows = {r["gkgrecordid"]: r for r in records.collect()}
    assert set(rows) == {"20150218230000-0", "k-3"} and rows["k-3"]["allNames"] is None
    assert rows["20150218230000-0"]["allNames"] == 'Ann "A" Lee,3;B,9'
    assert rows["20150218230000-0"]["date"] == dt.datetime(2015, 2, 18, 23, 0)
    kept = bad.collect()
    assert sorted((r["reason"], r["line"]) for r in kept) == sorted(zip(
        ["short", "short", "long", "key", "date", "date"], lines[1:7], strict=True))
    assert {r["file"] for r in kept} == {"20150218230000.gkg.csv"}
    assert {r["reason"]: r["lines"] for r in bad_line_counts(bad).collect()} == {"short": 2, "long": 1, "key": 1, "date": 2}
    # good records equal those of the typed reader
    typed = {r["gkgrecordid"]: r for r in read_gkg_csv(spark, path).collect()}
    assert rows["20150218230000-0"].asDict() == typed["20150218230000-0"].asDict()


def test_topk_job_with_quarantine_and_stoplist(spark, workdir):
    lines = [gkg_row(f"k-{i}", "20150218230000", "New York,1;Type ContentType,2;Ann,3") for i in range(3)] + ["broken"]
    src = write_lines(workdir + "/gkg", lines)
    with open(workdir + "/stop.tsv", "w") as f:
        f.write("contains\tContentType\nequals\tAnn\n")
    main(["topk", "--input", src, "--output", workdir + "/top", "--quarantine", workdir + "/judged",
          "--stoplist", workdir + "/stop.tsv"])
    run = os.listdir(workdir + "/top")[0]
    assert [(r.topic, r["count"]) for r in spark.read.json(f"{workdir}/top/{run}").collect()] == [("New York", 3)]
    assert [r.line for r in spark.read.parquet(workdir + "/judged/verdict=bad").collect()] == ["broken"]


# ---------------------------------------------------------------- tiers over converted records
def converted(spark, workdir):
    days = ["20150218230000", "20150218231459", "20150218231500", "20150228235959", "20150301000000", "20150630120000",
            "20150701000000", "20151231235959", "20160101000000"]
    src = write_lines(workdir + "/gkg", [gkg_row(f"k-{d}", d, "A,1") for d in days] + [gkg_row("k-none", "x", "A,1")])
    convert_to_parquet(read_gkg_csv(spark, src), workdir + "/pq")
    return workdir + "/pq"


def test_tiers_prune_folders(spark, workdir):
    path = converted(spark, workdir)
    counts = {t: read_gkg_parquet(spark, path, t).count() for t in ("small", "medium", "large", "xlarge", "full")}
    assert counts == {"small": 2, "medium": 4, "large": 6, "xlarge": 8, "full": 9}
    assert read_gkg_parquet(spark, path).count() == 10
    assert read_gkg_parquet(spark, path, "small", "20150701000000").count() == 1
    assert read_gkg_parquet(spark, path, "medium", "20160110000000").count() == 1
    plan = read_gkg_parquet(spark, path, "medium")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "2015-02-01" in plan and "2015-03-01" in plan
    with pytest.raises(ValueError):
        read_gkg_parquet(spark, path, "tiny")


def test_tier_option_takes_parquet(spark, workdir):
    main(["topk", "--input", converted(spark, workdir), "--output", workdir + "/top", "--format", "parquet", "--tier", "medium"])
    run = os.listdir(workdir + "/top")[0]
    assert sorted((r.date, r["count"]) for r in spark.read.json(f"{workdir}/top/{run}").collect()) == [
        ("2015-02-18", 3), ("2015-02-28", 1)]


# ---------------------------------------------------------------- pattern stoplist
def matches(topic, pattern, kind):
    return {"equals": topic == pattern, "prefix": topic.startswith(pattern), "suffix": topic.endswith(pattern),
            "contains": pattern in topic}[kind]


WORDS = st.text(alphabet="abAé", min_size=1, max_size=5)


@settings(max_examples=300, deadline=None)
@given(st.lists(WORDS, max_size=12), st.lists(WORDS, max_size=12))
def test_automaton_equals_plain_search(phrases, texts):
    automaton = stoplist.Automaton(phrases)
    for t in texts:
        assert automaton.found_in(t) == any(p in t for p in phrases)


def test_no_block_is_taken_for_an_earlier_one():
    assert len({stoplist._Shipped(object()).id for _ in range(100)}) == 100


@pytest.mark.parametrize("ignore_case,block", [(False, 200_000), (True, 200_000), (False, 7)])
def test_thousands_of_patterns_in_one_pass(spark, ignore_case, block):
    r = random.Random(5)
    word = lambda n: "".join(r.choice("abcdEF") for _ in range(n))
    topics = [word(r.randint(1, 9)) for _ in range(400)] + [None, "", "Ann\tLee"]
    patterns = [(word(r.randint(3, 6)), r.choice(stoplist.KINDS)) for _ in range(3000 if block > 7 else 40)]
    patterns += [("", "contains"), (None, "prefix"), ("n\tL", "contains")]
    df = spark.createDataFrame([("1", dt.date(2024, 1, 1), t) for t in topics for _ in range(2)], MENTIONS)
    stop = spark.createDataFrame(patterns, "pattern STRING, kind STRING")
    low = (lambda s: s.lower()) if ignore_case else (lambda s: s)
    want = {t for t in topics if t is not None and any(p and matches(low(t), low(p), k) for p, k in patterns)}
    got = stoplist.matching_topics(df, stop, ignore_case, block_phrases=block).collect()
    assert {x["topic"] for x in got} == want and len(got) == len(want)
    if not ignore_case and block > 7:
        left = stoplist.exclude_matching(topk.mention_counts(df), stop).collect()
        assert {x["topic"] for x in left} == set(topics) - want


def test_stoplist_of_nothing_and_unknown_kinds(spark):
    df = spark.createDataFrame([("1", dt.date(2024, 1, 1), "a")], MENTIONS)
    none = spark.createDataFrame([], "pattern STRING, kind STRING")
    assert [r.topic for r in stoplist.daily_topk_without_patterns(df, none).collect()] == ["a"]
    with pytest.raises(ValueError):
        stoplist.matching_topics(df, spark.createDataFrame([("a", "like")], "pattern STRING, kind STRING"))


# ---------------------------------------------------------------- article sketches
def test_sketches_merge_over_days_within_their_bound(spark, workdir):
    rows = spark.range(60_000).select(
        F.concat(F.lit("r"), (F.col("id") % 20_000).cast("string")).alias("record_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("date"),
        F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("topic"))
    path = workdir + "/sketches"
    sketches.store_sketches(sketches.article_sketches(rows), path)
    # a day that is counted again replaces itself only
    again = sketches.article_sketches(rows.filter("date = '2024-01-02'"))
    sketches.store_sketches(again, path)
    exact = {r.topic: r.n for r in rows.filter("date between '2024-01-02' and '2024-01-04'").groupBy("topic")
             .agg(F.count_distinct("record_id").alias("n")).collect()}
    near = {r.topic: r.articles for r in sketches.articles_between(spark, path, "2024-01-02", "2024-01-04").collect()}
    assert near.keys() == exact.keys()
    assert all(abs(near[t] - n) <= n * sketches.relative_error() for t, n in exact.items())
    whole = sketches.estimated(sketches.merged(spark.read.parquet(path), [])).first().articles
    assert abs(whole - 20_000) <= 20_000 * sketches.relative_error()
    plan = sketches.articles_between(spark, path, "2024-01-02", "2024-01-04")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_sketches_of_no_rows_and_null_ids(spark, workdir):
    m = spark.createDataFrame([(None, dt.date(2024, 1, 1), "a"), ("x", dt.date(2024, 1, 1), "b")], MENTIONS)
    assert {r.topic: r.articles for r in sketches.estimated(sketches.article_sketches(m)).collect()} == {"a": 0, "b": 1}
    assert sketches.estimated(sketches.article_sketches(m.limit(0))).collect() == []


# ---------------------------------------------------------------- daily top-k kept up to date
def as_set(df):
    return {tuple(r) for r in df.select("date", "topic", "count", "rank").collect()}


def test_updates_equal_the_batch_form(spark, workdir):
    r, store, seen = random.Random(8), DailyTopk(workdir + "/daily", k=3, buckets=8), []
    for update in range(5):
        days = [None, *(dt.date(2024, 1, update + d) for d in (1, 2))]
        new = [(str(i), r.choice(days), r.choice(["a", "b", "c", "d", "e", None])) for i in range(0 if update == 3 else 60)]
        seen += new
        for _ in range(2 if update in (1, 4) else 1):  # an update that runs again
            store.update(spark, spark.createDataFrame(new, MENTIONS), update)
        want = as_set(topk.daily_topk(spark.createDataFrame(seen, MENTIONS), 3))
        assert as_set(store.top(spark, update)) == want
        counted = {(x.date, x.topic): x["count"] for x in store.counts(spark, update).collect()}
        assert sum(counted.values()) == len(seen)
        # only the days of the new mentions were ranked again
        ranked = {x.date for x in store.ranked.changed(spark, update).collect()}
        assert ranked == {d for _, d, _ in new}
    assert len(os.listdir(workdir + "/daily/counts")) == 2
    with pytest.raises(RuntimeError):
        store.top(spark, 9)


def test_stored_counts_go_through_no_exchange(spark, workdir):
    store = DailyTopk(workdir + "/daily", buckets=16)
    m = spark.createDataFrame([(str(i), dt.date(2024, 1, 1 + i % 9), f"t{i % 50}") for i in range(500)], MENTIONS)
    store.update(spark, m, 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        merged = store.merged(spark, topk.mention_counts(m), 1)
        merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = plan.split("== Initial Plan ==")[0]
    lines = [x.strip(" +-:*()0123456789") for x in final.splitlines()]
    scan = next(i for i, x in enumerate(lines) if "mentionlab_counts" in x)
    join = next(i for i, x in enumerate(lines) if "Join" in x)
    assert join < scan and not any("Exchange" in x or "ShuffleQueryStage" in x for x in lines[join + 1:scan]), final
    assert "Bucketed: true" in lines[scan]


def test_new_segments_are_picked_up(spark, workdir):
    base, store = workdir + "/seg", DailyTopk(workdir + "/daily", buckets=4)
    write_segment(base, "20150219000000.gkg.csv", [("20150219000000-0", "A,1;B,2")])
    assert store.pick_up(spark, base, 0).startswith("20150219000000")
    write_segment(base, "20150219001500.gkg.csv", [("20150219001500-0", "A,1"), ("20150219001500-1", "C,1")])
    store.pick_up(spark, base, 1)
    assert {(r.topic, r["count"]) for r in store.top(spark, 1).collect()} == {("A", 2), ("B", 1), ("C", 1)}
    store.pick_up(spark, base, 2)  # nothing new
    assert {(r.topic, r["count"]) for r in store.top(spark, 2).collect()} == {("A", 2), ("B", 1), ("C", 1)}
