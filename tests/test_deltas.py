"""Merge-on-read tables, the incremental top 100 on them, replayed batches and bounded folders."""

import json
import os
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mentionlab.operators.changes import change_message, top_changes
from mentionlab.streaming.deltas import DeltaTable
from mentionlab.streaming.increments import CurrentTable
from mentionlab.streaming.top100 import Shard, Top100Writer, messages, place, rescans, to_rescan

SCHEMA = "name STRING, count LONG"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def as_dict(df):
    rows = df.collect()
    assert len(rows) == len({r["name"] for r in rows})
    return {r["name"]: r["count"] for r in rows}


def test_table_merges_compacts_and_replays(spark, workdir):
    table = DeltaTable(workdir + "/t", SCHEMA, ["name"], shards=4, every=3)
    rng, expected, folders = random.Random(1), {}, []
    for batch in range(11):
        changes = {rng.choice(["a", "b", "c", "d", "e", None]): rng.randrange(3) for _ in range(4)}
        for _ in range(2 if batch in (2, 5, 6) else 1):  # a batch that runs again leaves the same table
            table.append(spark, frame(spark, list(changes.items())), batch, newest=batch, gone=F.col("count") == 0)
        expected = {n: c for n, c in {**expected, **changes}.items() if c}
        rows, newest = table.read(spark, batch)
        assert as_dict(rows) == expected and newest == batch
        assert as_dict(table.latest(spark)[1]) == expected
        one = table.read(spark, batch, [2])[0].withColumn("s", table.shard()).collect()
        assert {r["name"] for r in one} == {r["name"] for r in rows.withColumn("s", table.shard()).filter("s = 2").collect()}
        folders.append(len(os.listdir(workdir + "/t/rows")))
    assert max(folders) <= 2 * 3 + 2
    assert len([f for f in os.listdir(workdir + "/t/commits") if f.endswith("json") and not f.startswith(".")]) == 2


def test_uncommitted_batch_is_not_read(spark, workdir):
    table = DeltaTable(workdir + "/t", SCHEMA, ["name"])
    table.append(spark, frame(spark, [("a", 1)]), 0)
    # a batch that got as far as its rows: no manifest names them
    frame(spark, [("a", 9)]).write.parquet(workdir + "/t/rows/delta=1")
    assert as_dict(table.latest(spark)[1]) == {"a": 1}
    table.append(spark, frame(spark, [("b", 2)]), 1)
    assert as_dict(table.latest(spark)[1]) == {"a": 1, "b": 2}


def test_log_keeps_all_rows_and_drops_old_ones_when_compacted(spark, workdir):
    log = DeltaTable(workdir + "/l", SCHEMA, every=2)
    for batch in range(4):
        log.append(spark, frame(spark, [("a", batch), ("a", batch)]), batch, newest=batch, keep=F.col("count") >= batch - 1)
    log.append(spark, None, 4, newest=4)
    rows, newest = log.read(spark, 4)
    assert sorted(r["count"] for r in rows.collect()) == [2, 2, 3, 3] and newest == 4


def test_current_table_without_rows(spark, workdir):
    table = CurrentTable(workdir + "/c", "a LONG, b STRING, v DOUBLE", ["a", "b"])
    empty = spark.createDataFrame([], "a LONG, b STRING, v DOUBLE")
    table(empty, 0)
    assert table.current(spark).count() == 0
    table(spark.createDataFrame([(1, None, 0.5), (None, "x", 1.5)], "a LONG, b STRING, v DOUBLE"), 1)
    table(spark.createDataFrame([(1, None, 2.5)], "a LONG, b STRING, v DOUBLE"), 2)
    assert {tuple(r) for r in table.current(spark).collect()} == {(1, None, 2.5), (None, "x", 1.5)}


def test_top_of_random_streams_equals_the_batch_form(spark, workdir):
    rng = random.Random(3)
    names = [f"n{i:02d}" for i in range(60)] + [None]
    writer, previous, current = Top100Writer(workdir + "/top", n=5, slack=1), {}, {}
    for batch in range(9):
        # rising counts first, then the leaders fall, so that lists run dry
        changes = {n: (rng.randrange(1, 50) if batch < 5 else rng.randrange(0, 3)) for n in rng.sample(names, 25)}
        if batch >= 5:
            changes |= {n: 0 for n, _ in sorted(current.items(), key=place)[:8]}
        current = {n: c for n, c in {**previous, **changes}.items() if c}
        updates = spark.createDataFrame([(None, n, c, batch) for n, c in changes.items()],
                                        "event_id LONG, name STRING, count LONG, us LONG")
        for _ in range(2 if batch == 6 else 1):
            writer(updates, batch)
        expected = change_message(top_changes(frame(spark, list(previous.items())), frame(spark, list(current.items())), 5)).first()
        got = messages(spark, workdir + "/top").filter(F.col("batch_id") == batch).first()
        assert (got["message"] if got else "[]") == expected["message"], batch
        previous = current
    seen = rescans(spark, workdir + "/top", 8)
    assert seen["batches"] == 9 and 0 < seen["rescans"] < 9 * 16
    kept = [f for f in os.listdir(workdir + "/top/tops") if not f.startswith(".")]
    assert sorted(kept) == ["7.json", "8.json"] and json.load(open(workdir + "/top/tops/8.json"))["batches"] == 9


CHANGES = st.lists(st.dictionaries(st.sampled_from([*"abcdefghijkl", None]), st.integers(0, 6), max_size=6), max_size=12)


@settings(max_examples=300, deadline=None)
@given(CHANGES, st.integers(1, 4))
def test_lists_and_bounds_always_give_the_top(batches, n):
    """The driver's part alone, against the whole table: after rescans the lists hold the top."""
    limit, shards, table = n, {0: Shard(), 1: Shard(), 2: Shard()}, {}

    def shard_of(name):
        return (ord(name[0]) if name else 0) % 3

    for changes in batches:
        table = {k: v for k, v in {**table, **changes}.items() if v}
        for i, s in shards.items():
            own = {k: v for k, v in changes.items() if shard_of(k) == i}
            listed = {k: v for k, v in own.items() if k in dict(s.entries)}
            best = dict(sorted(((k, v) for k, v in own.items() if v), key=place)[:limit + 1])
            s.change({**best, **listed}, limit)
        for i in to_rescan(shards, n):
            shards[i].reset(sorted(((k, v) for k, v in table.items() if shard_of(k) == i), key=place)[:limit + 1], limit)
        top = sorted((e for s in shards.values() for e in s.entries), key=place)[:n]
        assert top == sorted(table.items(), key=place)[:n]
