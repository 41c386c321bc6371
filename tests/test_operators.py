"""Operators: ranking helpers against naive forms, top-k ties, the manual's letter sums, changes."""

import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from mentionlab.operators import basics, changes, histogram, topk
from mentionlab.plans.ranking import broadcast_if_small, number_rows
from mentionlab.sources.letters import letters

# Sums per letter over the pairs (a,1) .. (200000th letter, 200000), as printed in the manual.
LETTER_SUMS = {
    "a": 769276921, "b": 769284614, "c": 769292307, "d": 769300000, "e": 769307693,
    "f": 769315386, "g": 769323079, "h": 769330772, "i": 769138464, "j": 769146156,
    "k": 769153848, "l": 769161540, "m": 769169232, "n": 769176924, "o": 769184616,
    "p": 769192308, "q": 769200000, "r": 769207692, "s": 769215384, "t": 769223076,
    "u": 769230768, "v": 769238460, "w": 769246152, "x": 769253844, "y": 769261536,
    "z": 769269228,
}


def test_letter_sums_match_manual(spark):
    pairs = letters(spark)
    assert pairs.rdd.getNumPartitions() == 20
    assert [tuple(r) for r in pairs.orderBy("num").limit(3).collect()] == [("a", 1), ("b", 2), ("c", 3)]
    got = {r.chr: r.total for r in basics.sum_by_key(pairs, "chr", "num").collect()}
    assert got == LETTER_SUMS
    inc = basics.map_increment(pairs).agg(F.sum("num")).first()[0]
    assert inc == sum(range(1, 200001)) + 200000


def hot_frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        g = "hot" if rnd.random() < 0.4 else f"g{rnd.randint(0, 30)}"
        rows.append((i, g, rnd.randint(0, 50)))
    return spark.createDataFrame(rows, "id LONG, g STRING, v INT")


def test_number_rows_matches_row_number(spark):
    df = hot_frame(spark).repartition(7)
    ours = number_rows(df, ["g"], [F.col("v").desc(), F.col("id")], out="pos", size_col="n", base=1)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id"))
    ref = df.withColumn("pos", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("g")))
    a = sorted((r.id, r.pos, r.n) for r in ours.collect())
    b = sorted((r.id, r.pos, r.n) for r in ref.collect())
    assert a == b


def test_number_rows_global(spark):
    df = hot_frame(spark, 1000)
    ours = number_rows(df, [], [F.col("v"), F.col("id")], base=1)
    ref = df.withColumn("pos", F.row_number().over(Window.orderBy("v", "id")))
    assert sorted((r.id, r.pos) for r in ours.collect()) == sorted((r.id, r.pos) for r in ref.collect())


def test_trailing_counts_matches_range_window(spark):
    rnd = random.Random(3)
    base = 1_700_000_000
    rows = [(i, rnd.choice(["a", "a", "a", "b", "c"]), base + rnd.randint(0, 4 * 3600)) for i in range(2000)]
    rows += [(5000, "a", base + 100), (5001, "a", base + 100), (5002, "a", base + 100 + 3600)]
    rows += [(6000, "d", -100), (6001, "d", -3700), (6002, "d", 10), (6003, "d", -3600)]  # before 1970
    df = spark.createDataFrame(rows, "id LONG, k STRING, s LONG").withColumn("ts", F.col("s").cast("timestamp"))
    simple = sorted(map(tuple, one_window_per_key(df).collect()))
    for bucket_us in (1_000_000, 60_000_000, 600_000_000, 3_600_000_000):
        got = histogram.trailing_counts(df, "k", "ts", "id", bucket_us=bucket_us)
        assert sorted(map(tuple, got.collect())) == simple
    with pytest.raises(ValueError):
        histogram.trailing_counts(df, "k", "ts", "id", bucket_us=7_000_000_000)


def one_window_per_key(df, width_us=3_600_000_000):
    w = Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-(width_us - 1), 0)
    return df.select("id", "k", F.count(F.lit(1)).over(w).alias("count"))


def test_topk_ties_break_by_topic(spark):
    rows = [("2015-02-18", t, c) for t, c in [("b", 3), ("a", 3), ("c", 5), ("d", 1)]]
    counts = spark.createDataFrame(rows, "d STRING, topic STRING, count LONG").withColumn("date", F.to_date("d"))
    top = topk.rank_topics(counts, 3).orderBy("rank").collect()
    assert [r.topic for r in top] == ["c", "a", "b"]


def test_topk_plan_limits_before_shuffle(spark):
    rows = [("2015-02-18", f"t{i}", i) for i in range(100)]
    counts = spark.createDataFrame(rows, "d STRING, topic STRING, count LONG").withColumn("date", F.to_date("d"))
    plan = topk.rank_topics(counts, 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_stoplist_and_spine(spark):
    rows = [("2015-02-18", "error", 9), ("2015-02-18", "x", 2), ("2015-02-20", "y", 1)]
    counts = spark.createDataFrame(rows, "d STRING, topic STRING, count LONG").withColumn("date", F.to_date("d"))
    stop = spark.createDataFrame([("error",)], "topic STRING")
    kept = topk.exclude_topics(counts, stop)
    assert {r.topic for r in kept.collect()} == {"x", "y"}
    top = topk.rank_topics(kept, 10).select("date", "topic", "count", "rank")
    spine = topk.spine_topics(top, 2).collect()
    assert len(spine) == 6
    assert {(str(r.date), r.rank, r.topic) for r in spine if r.topic} == {("2015-02-18", 1, "x"), ("2015-02-20", 1, "y")}


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert "broadcast" in str(broadcast_if_small(small, 100)._jdf.queryExecution().analyzed()).lower()
    assert broadcast_if_small(big, 100) is big


def test_changes_apply_to_snapshot(spark):
    prev = spark.createDataFrame([(f"n{i}", 200 - i) for i in range(150)], "name STRING, count LONG")
    cur = spark.createDataFrame([(f"n{i}", 200 - i + (30 if i % 7 == 0 else 0)) for i in range(20, 170)],
                                "name STRING, count LONG")
    diff = changes.top_changes(prev, cur, 100)
    # apply the changes to the previous top 100 and compare with the current top 100
    old = {r.name: r["count"] for r in histogram.top_entries(prev, 100).collect()}
    for r in diff.collect():
        if r["count"] == 0:
            old.pop(r.name)
        else:
            old[r.name] = r["count"]
    new = {r.name: r["count"] for r in histogram.top_entries(cur, 100).collect()}
    assert old == new


def test_changelog_and_increments(spark):
    ch = spark.createDataFrame([("a", 3, 1), ("a", 0, 2), ("b", 5, 1), ("b", 6, 3), ("c", 0, 1)],
                               "name STRING, count LONG, seq LONG")
    assert sorted(map(tuple, changes.apply_changelog(ch).collect())) == [("b", 6)]
    inc = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2)], "name STRING, increment INT")
    assert sorted(map(tuple, changes.apply_increments(inc).collect())) == [("a", 4), ("b", 2)]
    msg = changes.change_message(spark.createDataFrame([('say "hi"', 2)], "name STRING, count LONG")).first()
    assert msg.message == '[{"name":"say \\"hi\\"","count":2}]'


def test_basics(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 3.0)], "k INT, v DOUBLE")
    assert sorted(map(tuple, basics.combine_mean(df, "k", "v").collect())) == [(1, 2, 6.0, 3.0), (2, 1, 3.0, 3.0)]
    assert sorted(map(tuple, basics.combine_mean_pandas(df, "k", "v").collect())) == [(1, 3.0), (2, 3.0)]
    g = basics.group_collect(spark.createDataFrame([(1, i) for i in range(5)], "k INT, v INT"), "k", "v", max_items=2)
    assert sorted(map(tuple, g.collect())) == [(1, 0, "0,1"), (1, 1, "2,3"), (1, 2, "4")]
    re = basics.reshuffle(df, 5, ["k"], then_coalesce=2)
    assert sorted(re.collect()) == sorted(df.collect())


def test_trailing_counts_keeps_repeated_ids_and_null_names(spark):
    rows = [(1, "a", "2020-01-01 00:00:00"), (1, "a", "2020-01-01 00:10:00"), (2, "a", "2020-01-01 00:20:00"),
            (3, None, "2020-01-01 00:20:00"), (4, None, "2020-01-01 00:30:00"), (5, "a", None)]
    df = spark.createDataFrame(rows, "id int, k string, t string").withColumn("ts", F.col("t").cast("timestamp"))
    want = [(1, "a", 1), (1, "a", 2), (2, "a", 3), (3, None, 1), (4, None, 2)]
    assert sorted(map(tuple, histogram.trailing_counts(df, "k", "ts", "id").collect()), key=repr) == want
    # a third of all rows in one minute of one name
    hot = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 50)).alias("k"),
                                   F.timestamp_seconds(F.when(F.col("id") % 3 == 0, F.col("id") % 60).otherwise(F.col("id") * 7)).alias("ts"))
    assert sorted(map(tuple, histogram.trailing_counts(hot, "k", "ts", "id").collect())) == \
        sorted(map(tuple, one_window_per_key(hot).collect()))
