"""The split-state histogram: counts, expiry, late rows and restarts against brute force."""

import datetime as dt
import json
import random
import tempfile
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.streaming import StreamingQueryListener

from mentionlab.plans.catalog import catalog
from mentionlab.plans.catalog_io import run_to_end
from mentionlab.streaming.sources import file_stream
from mentionlab.streaming.split_state import DAY_MS, LANES, DroppedRows, SplitHistogram, read_late, read_updates, split_parts
from mentionlab.streaming.top100 import Top100Writer, latest_snapshot, messages
from tests.test_streaming import BATCHES, SCHEMA, T0, brute_force, live_at, write_batch

T0_US = T0.value // 1000


def run(spark, src, base, ckpt, then=None, horizon_ms=DAY_MS):
    s = split_parts(file_stream(spark, src, SCHEMA, max_files_per_trigger=1), horizon_ms=horizon_ms)
    run_to_end(s.writeStream.foreachBatch(SplitHistogram(base, then)).option("checkpointLocation", ckpt))


def test_counts_late_rows_expiry_and_restart(spark, workdir):
    src, base, ckpt = workdir + "/in", workdir + "/split", workdir + "/ckpt"
    top = Top100Writer(workdir + "/top")
    for i, b in enumerate(BATCHES[:3]):
        write_batch(src, i, b)
    run(spark, src, base, ckpt, top)
    assert read_updates(spark, base).filter("kind = 'arrival'").count() == 7
    for i, b in enumerate(BATCHES[3:], start=3):
        write_batch(src, i, b)
    write_batch(src, 9, [(13, 11990.0, None), (14, 11990.0, None), (None, 11991.0, "d")])
    run(spark, src, base, ckpt, top)  # goes on from the checkpoint
    rows = read_updates(spark, base).collect()
    every = [*BATCHES, [(13, 11990.0, None), (14, 11990.0, None), (None, 11991.0, "d")]]
    assert {r.event_id: r["count"] for r in rows if r.kind == "arrival"} == brute_force(every, dropped={10})
    # a@100 comes at stream time 7000 s: a's count there has 3599.999, 3600, 3601, 5000 and 7000 s
    assert [(r.event_id, r["count"]) for r in rows if r.kind == "late"] == [(10, 5)]
    assert [tuple(r)[:4] for r in read_late(spark, base).collect()] == [(10, "a", T0_US + 100_000_000, 6_900_000_000)]
    assert any(r.name == "b" and r["count"] == 0 for r in rows if r.kind == "expire")
    # mentions out of order get a closing update, and nothing is below zero
    assert any(r.name == "a" and r.kind in ("level", "expire") for r in rows) and all(r["count"] >= 0 for r in rows)
    # the last update of every name is its count at the end of the stream
    last = {}
    for r in sorted(rows, key=lambda r: (r.us, r.event_id is None and r.kind != "arrival")):
        if r.kind != "late":
            last[r.name] = r["count"]
    seen = [r for b in every for r in b if r[0] != 10]
    assert {n: c for n, c in last.items() if c} == live_at(seen, 12000.0)
    snap = json.loads(latest_snapshot(spark, workdir + "/top").first().message)
    assert {e.get("name"): e["count"] for e in snap} == live_at(seen, 12000.0)
    assert messages(spark, workdir + "/top").count() >= 3


def test_no_task_sees_a_hot_name_whole(spark, workdir):
    """All mentions of one name: the operator by name gets a row a minute, and the lanes spread the rest."""
    src, base, ckpt = workdir + "/in", workdir + "/split", workdir + "/ckpt"
    rows = [(i, i * 0.05, "hot") for i in range(4000)]  # 200 seconds: four minutes
    write_batch(src, 0, rows)
    run(spark, src, base, ckpt)
    parts = spark.read.parquet(base + "/parts").groupBy("role").count().collect()
    by_role = {r["role"]: r["count"] for r in parts}
    assert by_role[0] == 4000 and by_role[4] == 4  # answers to mentions, and sums per minute
    got = {r.event_id: r["count"] for r in read_updates(spark, base).filter("kind = 'arrival'").collect()}
    assert got == {i: i + 1 for i in range(4000)}


class _StateUse(DroppedRows):
    """The most state rows that an operator held after a batch, and the timers that were set."""

    def __init__(self):
        super().__init__()
        self.most = self.timers = 0

    def onQueryProgress(self, event) -> None:
        for op in event.progress.stateOperators:
            self.most = max(self.most, int(op.numRowsTotal))
            self.timers += int(op.customMetrics["numRegisteredTimers"])


def watched_run(spark, src, base, ckpt):
    listener = _StateUse()
    spark.streams.addListener(listener)
    try:
        run(spark, src, base, ckpt)
        for _ in range(50):  # events come a little after the query's end
            if listener.finished:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    return listener


def test_state_is_kept_by_lane_and_ids_stay_whole(spark, workdir):
    """A batch over many minutes costs a state access a lane of a name, not one a minute."""
    src, base, ckpt = workdir + "/in", workdir + "/split", workdir + "/ckpt"
    minutes, big = 5 * LANES, 2 ** 53
    write_batch(src, 0, [(big + i, i * 60.0, "a") for i in range(1, minutes)] + [(None, 5.0, "a")])
    assert 0 < watched_run(spark, src, base, ckpt).most <= LANES
    rows = [r for r in read_updates(spark, base).collect() if r.kind == "arrival"]
    # the mention without id has come at 5 s; that of minute 60 is 3595 s later, that of minute 61 3655 s
    assert {r.event_id: r["count"] for r in rows} == {None: 1} | {
        big + i: i + 1 if i < 60 else 61 if i == 60 else 60 for i in range(1, minutes)}
    assert len(rows) == minutes


def test_expiry_over_many_minutes_sets_few_timers(spark, workdir):
    """Mentions of many minutes leave the hour at once: their lanes' timers say so, not one a minute."""
    src, base, ckpt = workdir + "/in", workdir + "/split", workdir + "/ckpt"
    minutes = 5 * LANES
    write_batch(src, 0, [(i, i * 60.0, "a") for i in range(minutes)])
    write_batch(src, 1, [(minutes, minutes * 60 + 2400.0, "b")])
    assert 0 < watched_run(spark, src, base, ckpt).timers <= 4 * (LANES + 1)
    closing = [(r.name, r["count"], r.us) for r in read_updates(spark, base).filter("kind = 'expire'").collect()]
    # the hour's last mentions; of them, those of the last 20 minutes are still within it 41 minutes later
    assert sorted(closing) == [("a", 19, T0_US + (minutes * 60 + 2400) * 1_000_000), ("a", 60, T0_US + (minutes - 1) * 60_000_000)]


def test_late_rows_of_many_minutes(spark, workdir):
    """Late and timely mentions of one name over many minutes: each gets its lag and the name's count, and state stays by lane."""
    src, base, ckpt = workdir + "/in", workdir + "/split", workdir + "/ckpt"
    minutes = 3 * LANES
    write_batch(src, 0, [(i, i * 60.0, "a") for i in range(minutes)])
    write_batch(src, 1, [(minutes + i, i * 60.0, "a") for i in range(minutes)])
    assert 0 < watched_run(spark, src, base, ckpt).most <= 2 * LANES  # a lane's list has an entry a batch
    late = {i: (minutes - 1 - i) * 60_000_000 for i in range(minutes - 60)}  # an hour or more behind
    assert {r.event_id - minutes: r.lag_us for r in read_late(spark, base).collect()} == late
    rows = [r for r in read_updates(spark, base).collect() if r.kind == "late"]
    assert len(rows) == len(late) and {r["count"] for r in rows} == {120}


class _Runs(StreamingQueryListener):
    """The queries started, and the rows of their batches."""

    def __init__(self):
        self.started, self.finished, self.batches = 0, 0, {}

    def onQueryStarted(self, event) -> None:
        self.started += 1

    def onQueryProgress(self, event) -> None:
        self.batches[event.progress.batchId] = event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.finished += 1


def query_run(spark, workdir, name, rows):
    """Rows of a registered query over ``rows`` (id, seconds, name) as its table of events, and what its stream did."""
    at = [(i, None if s is None else T0.tz_localize(None).to_pydatetime() + dt.timedelta(seconds=s), n) for i, s, n in rows]
    spark.createDataFrame(at, "event_id LONG, ts TIMESTAMP_NTZ, event_type STRING").write.parquet(workdir + "/events.parquet")
    runs = _Runs()
    spark.streams.addListener(runs)
    try:
        got = [tuple(r) for r in catalog()[name][0](spark, workdir).collect()]
        for _ in range(50):
            if runs.finished and runs.finished == runs.started:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(runs)
    return got, runs


def test_late_rows_query_starts_its_stream_once(spark, workdir):
    """Slices of two hours, a late mention and one without time: four batches of one run."""
    rows = [(1, 0.0, "a"), (11, 600.0, "a"), (2, 7300.0, "a"), (3, 7400.0, None), (4, 28799.0, "a"), (5, None, "a")]
    got, runs = query_run(spark, workdir, "late_rows", rows)
    assert runs.started == 1
    assert [n for _, n in sorted(runs.batches.items()) if n] == [2, 2, 1, 1]
    # 11 comes two slices late, when stream time is 7400 s: no mention is within the hour but that at 7300 s
    assert sorted(got) == [(1, "a", False, None, None), (2, "a", False, None, None), (3, None, False, None, None),
                           (4, "a", False, None, None), (11, "a", True, 6_800_000_000, 1)]


def test_split_changelog_query_starts_its_stream_once(spark, workdir):
    """The third of four slices has no rows: every mention and every loss is told, and the slices stay batches of their own."""
    rows = [(1, 0.0, "a"), (2, 7300.0, "a"), (3, 28799.0, "b")]
    got, runs = query_run(spark, workdir, "split_histogram_changelog", rows)
    assert runs.started == 1
    assert [n for _, n in sorted(runs.batches.items()) if n] == [1, 1, 1]
    assert sorted((k, n, c, (us - T0_US) / 1e6, i) for i, n, c, us, k in got) == [
        ("arrival", "a", 1, 0.0, 1), ("arrival", "a", 1, 7300.0, 2), ("arrival", "b", 1, 28799.0, 3),
        ("expire", "a", 0, 28799.0, None), ("expire", "a", 1, 7300.0, None)]


def test_split_changelog_closes_a_slice_with_the_next(spark, workdir):
    """Slices in order of time: what leaves the hour is told in the next slice's batch, and only the last needs one without rows."""
    rows = [(1, 0.0, "a"), (2, 7300.0, "a"), (3, 14500.0, "b"), (4, 28799.0, "a")]
    got, runs = query_run(spark, workdir, "split_histogram_changelog", rows)
    assert [n for _, n in sorted(runs.batches.items())] == [1, 1, 1, 1, 0]
    assert sorted((k, n, c, (us - T0_US) / 1e6, i) for i, n, c, us, k in got if k != "arrival") == [
        ("expire", "a", 0, 14500.0, None), ("expire", "a", 1, 7300.0, None), ("expire", "b", 0, 28799.0, None)]


def test_a_slice_not_later_than_stream_time_waits_for_the_closing_updates(spark, workdir):
    """The second slice begins in the millisecond to which stream time was rounded up: it isn't in the first one's closing count."""
    rows = [(1, 0.0, "a"), (2, 7199.7505, "a"), (3, 7199.750501, "a"), (4, 28799.002, "b")]
    got, runs = query_run(spark, workdir, "split_histogram_changelog", rows)
    assert [n for _, n in sorted(runs.batches.items()) if n] == [2, 1, 1]
    assert [n for _, n in sorted(runs.batches.items())][:3] == [2, 0, 1]
    assert sorted((k, n, c, us - T0_US, i) for i, n, c, us, k in got) == [
        ("arrival", "a", 1, 0, 1), ("arrival", "a", 1, 7_199_750_500, 2), ("arrival", "a", 2, 7_199_750_501, 3),
        ("arrival", "b", 1, 28_799_002_000, 4), ("expire", "a", 0, 28_799_002_000, None),
        ("expire", "a", 1, 7_199_751_000, None), ("level", "a", 2, 7_199_751_000, None)]


def test_rows_beyond_the_horizon_are_counted_as_dropped(spark, workdir):
    src, base, ckpt = workdir + "/in", workdir + "/split", workdir + "/ckpt"
    write_batch(src, 0, [(1, 10000.0, "a")])
    write_batch(src, 1, [(2, 100.0, "a"), (3, 10001.0, "a")])  # late, but before the watermark is that far
    write_batch(src, 2, [(4, 200.0, "a")])  # older than the watermark of the batch before
    listener = DroppedRows()
    spark.streams.addListener(listener)
    try:
        run(spark, src, base, ckpt, horizon_ms=3_600_000)
        for _ in range(50):  # events come a little after the query's end
            if listener.finished:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    kinds = {r.event_id: r.kind for r in read_updates(spark, base).collect() if r.event_id}
    assert kinds == {1: "arrival", 2: "late", 3: "arrival"}
    assert listener.read == 4 and listener.mentions == 1


def test_windows_are_whole_minutes(spark, workdir):
    write_batch(workdir + "/in", 0, [(1, 0.0, "a")])
    s = file_stream(spark, workdir + "/in", SCHEMA)
    with pytest.raises(ValueError):
        split_parts(s, window_us=90_000_000)
    with pytest.raises(ValueError):
        split_parts(s, horizon_ms=1000)


@settings(max_examples=2, deadline=None)
@given(st.integers(0, 10_000))
def test_random_streams_equal_brute_force(spark, seed):
    r, work, batches, eid = random.Random(seed), tempfile.mkdtemp(prefix="mentionlab-prop-"), [], 0
    for k in range(4):  # batches overlap by up to half an hour, so mentions come out of order
        rows = []
        for _ in range(r.randint(1, 12)):
            eid += 1
            rows.append((eid, k * 2400.0 + r.choice([r.uniform(-1800, 2400), r.randint(0, 40) * 60.0]) + 4000, r.choice(["a", "a", "b", None])))
        batches.append(rows)
    for i, b in enumerate(batches):
        write_batch(work + "/in", i, b)
    run(spark, work + "/in", work + "/split", work + "/ckpt")
    rows = read_updates(spark, work + "/split").collect()
    late = {x.event_id for x in rows if x.kind == "late"}
    assert {x.event_id: x["count"] for x in rows if x.kind == "arrival"} == \
        {i: c for i, c in brute_force(batches, dropped=late).items() if i not in late}
