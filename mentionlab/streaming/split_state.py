"""W2b-W6 with split state: the last-hour histogram as two chained stateful operators.

The first operator is keyed by (name, lane): the minutes of a name are dealt over ``LANES`` lanes, minute by
minute, so neighbouring minutes are in different groups.  A lane's state is the list of its minutes' mention
times, one appended array a batch, so a batch commits what it brought and not the window, and a group
is loaded, appended to and armed once a batch, however many minutes the batch spans.  It answers for
a mention at ``t`` how many of its own minute are not later, and, asked by a probe that each
mention sends to the minute an hour before, how many of that minute are less than an hour
older.  An event-time timer fires when the lane's oldest mention leaves the hour.

The second operator is keyed by name.  Its state is a count per minute: all mentions of the
minute (for the sum of the 59 whole minutes in between) and those still within the hour.  It gets
one row per changed minute, never a mention.  Answers that concern single mentions pass beside it
in the lanes, so neither operator ever holds a hot name's rows in one task.  Both take their rows as
Arrow batches and count with sorted arrays: no row object is made for a mention.

What both say is written once per batch and joined there: the count of a mention at ``t`` in
``(t - 1 hour, t]`` is own minute + whole minutes + probe.

Stream time is the newest mention time of the batches before, in whole milliseconds, rounded
up: Spark's watermark plus its delay.  After a batch Spark runs one without rows, so closing updates
hold at the stream time that the batch left.  Updates are as in
:mod:`mentionlab.streaming.trailing_batches`, and stream time stamps ``expire`` and ``level``:

* ``arrival``: a mention with its count;
* ``late``: a mention older than stream time less ``lateness`` (W3); it isn't logged, carries its
  name's count at stream time, and goes to the folder ``late`` with how late it came;
* ``expire``: a name that lost mentions, with its count at stream time (W4);
* ``level``: a name whose mentions came out of order.

The watermark trails stream time by ``horizon`` (longer than the lateness), so that late rows
reach the operators; what is later still is dropped by Spark, and :class:`DroppedRows` counts it.
Mentions without a time are left out; null names count as one name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from mentionlab.functions.times import micros
from mentionlab.operators.histogram import HOUR_US, MINUTE_US
from mentionlab.session import use_rocksdb_state
from mentionlab.streaming.deltas import delete

DAY_MS = 86_400_000
LANES = 64
CHUNK = 65_536
OWN, PROBE, MINUTE, LATE, BASE, EXPIRE, LEVEL, HERE = range(8)
# name: 'n' or 's' + name; n: the count a row carries; us: mention or stream time.  No column is null,
# so that pandas keeps whole numbers: no_id stands for a null event_id, and what a role doesn't use is 0.
PART_SCHEMA = "name STRING, minute LONG, event_id LONG, no_id BOOLEAN, us LONG, n LONG, role INT"
MINUTE_SCHEMA = f"{PART_SCHEMA}, live LONG, ahead LONG, asked BOOLEAN, shrunk BOOLEAN, behind BOOLEAN, lane INT, et TIMESTAMP"
LATE_SCHEMA = "event_id LONG, name STRING, us LONG, lag_us LONG"
UPDATE_SCHEMA = "event_id LONG, name STRING, count LONG, us LONG, kind STRING"
_DTYPES = {"STRING": object, "LONG": np.int64, "INT": np.int32, "BOOLEAN": np.bool_}


def _columns(schema: str) -> dict[str, str]:
    return dict(f.split() for f in schema.split(", "))


def _frame(schema: str, parts: list[dict]) -> pd.DataFrame:
    """Rows of ``schema`` from parts: each maps columns to arrays of the length of its ``n``, or to one value; others are 0."""
    columns = {}
    for c, kind in _columns(schema).items():
        if kind != "TIMESTAMP":
            columns[c] = np.concatenate([
                x if isinstance(x := part.get(c, 0), np.ndarray) else np.full(len(part["n"]), x, _DTYPES[kind])
                for part in parts])
    return pd.DataFrame(columns, copy=False)


class _Clock:
    """Stream time from the watermark: None before the first batch has passed."""

    def __init__(self, timer_values, horizon_ms: int):
        self.watermark_ms = int(timer_values.getCurrentWatermarkInMs())
        self.now_us = (self.watermark_ms + horizon_ms) * 1000 if self.watermark_ms > 0 else None
        # output must not be older than the watermark
        self.et = pd.Timestamp(max(self.watermark_ms, 0) + 1, unit="ms", tz="UTC")


class MinuteProcessor(StatefulProcessor):
    """Mention times of one name in the minutes of one lane."""

    def __init__(self, window_us: int, lateness_us: int, horizon_ms: int):
        self.window_us, self.lateness_us, self.horizon_ms = window_us, lateness_us, horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getListState("times", "us ARRAY<LONG>")
        self.fired = set()

    def _load(self) -> np.ndarray:
        return np.sort(np.concatenate([np.empty(0, np.int64), *(np.asarray(r[0], np.int64) for r in self.times.get())]))

    def _append(self, times: np.ndarray) -> None:
        self.times.appendList([(times[k:k + CHUNK].tolist(),) for k in range(0, len(times), CHUNK)])

    def _closed(self, minutes):
        """Stream time from which no mention, however late, asks for a minute."""
        return (minutes + 1) * MINUTE_US + self.window_us + self.lateness_us

    def _next(self, clock: _Clock, times: np.ndarray) -> int | None:
        """Stream time of the next change: a mention leaves the hour, or a minute is closed."""
        gone = 0 if clock.now_us is None else np.searchsorted(times, clock.now_us - self.window_us, "right")
        changes = [int(t) + self.window_us for t in times[gone:gone + 1]]
        changes += [t for t in (int(self._closed(m)) for m in times[:1] // MINUTE_US)
                    if clock.now_us is None or t > clock.now_us]
        return min(changes, default=None)

    def _timer(self, us: int) -> None:
        """A timer for the stream time ``us``, in terms of the watermark."""
        self.handle.registerTimer(-(-us // 1000) - self.horizon_ms)

    def _minute_rows(self, clock: _Clock, times: np.ndarray, minutes: np.ndarray, **flags) -> dict:
        now = clock.now_us
        first, end = np.searchsorted(times, minutes * MINUTE_US), np.searchsorted(times, (minutes + 1) * MINUTE_US)
        live, ahead = end - first, np.zeros_like(first)
        if now is not None:
            live = end - np.clip(np.searchsorted(times, now - self.window_us, "right"), first, end)
            ahead = end - np.clip(np.searchsorted(times, now, "right"), first, end)
        return {"minute": minutes, "us": now or 0, "n": end - first, "role": MINUTE, "live": live, "ahead": ahead,
                "no_id": True, **flags}

    def _out(self, key, clock: _Clock, parts: list[dict]) -> pd.DataFrame:
        out = _frame(MINUTE_SCHEMA, [{"name": key[0], **part} for part in parts])
        out["et"] = clock.et
        return out

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        clock = _Clock(timerValues, self.horizon_ms)
        now, beside = clock.now_us, 1 + key[1]  # rows for single mentions go in a lane beside the counts
        batches = [tuple(f[c].to_numpy() for c in ("us", "event_id", "no_id", "probe")) for f in rows]
        us, ids, no_id, probe = (np.concatenate(c) for c in zip(*batches))
        late = np.zeros(len(us), np.bool_) if now is None else us <= now - self.lateness_us
        fresh, old, probes = ~probe & ~late, ~probe & late, np.unique(us[probe & ~late])
        times, parts = self._load(), []
        if fresh.any():
            known, new = times, us[fresh]
            times = np.sort(np.concatenate([known, new]))
            self._append(np.sort(new))
            armed, change = self._next(clock, known), self._next(clock, times)
            if armed is None or change < armed:
                self._timer(change)
            minute = new // MINUTE_US
            parts.append({"minute": minute, "event_id": ids[fresh], "no_id": no_id[fresh], "us": new, "role": OWN, "lane": beside,
                          "n": np.searchsorted(times, new, "right") - np.searchsorted(times, minute * MINUTE_US)})
            changed = np.unique(minute)
            behind = np.zeros(len(changed), np.bool_) if now is None else np.isin(changed, minute[new < now])
            parts.append(self._minute_rows(clock, times, changed, asked=True, behind=behind))
        if len(times) and len(probes):
            since = probes - self.window_us
            younger = np.searchsorted(times, (since // MINUTE_US + 1) * MINUTE_US) - np.searchsorted(times, since, "right")
            asks = younger > 0  # no answer means none
            parts.append({"minute": probes[asks] // MINUTE_US, "no_id": True, "us": probes[asks], "n": younger[asks],
                          "role": PROBE, "lane": beside})
        if old.any():
            parts.append({"minute": us[old] // MINUTE_US, "event_id": ids[old], "no_id": no_id[old], "us": us[old],
                          "n": now - us[old], "role": LATE, "lane": beside})
            parts.append({"us": now, "n": np.zeros(1, np.int64), "role": HERE, "no_id": True})
        if any(len(part["n"]) for part in parts):
            yield self._out(key, clock, parts)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if tuple(key) in self.fired:  # an earlier timer of this lane, due in the same batch, has said it all
            return
        self.fired.add(tuple(key))
        clock = _Clock(timerValues, self.horizon_ms)
        times = self._load()
        minutes = np.unique(times // MINUTE_US)
        closed = self._closed(minutes) <= clock.now_us
        left = times[np.isin(times // MINUTE_US, minutes[~closed])]
        if len(left) < len(times):
            self.times.clear()
            if len(left):
                self._append(left)
        shrunk = minutes[~closed & (minutes * MINUTE_US <= clock.now_us - self.window_us)]
        parts = [self._minute_rows(clock, left, m, shrunk=True) for m in (minutes[closed], shrunk)]
        if any(len(part["n"]) for part in parts):
            yield self._out(key, clock, parts)
        if (change := self._next(clock, left)) is not None:
            self._timer(change)

    def close(self) -> None:
        pass


class NameProcessor(StatefulProcessor):
    """Counts per minute of one name (lane 0); rows of other lanes pass."""

    def __init__(self, window_us: int, horizon_ms: int):
        self.minutes_in_window, self.horizon_ms = window_us // MINUTE_US, horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", "minute ARRAY<LONG>, n ARRAY<LONG>, live ARRAY<LONG>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[1] != 0:
            for f in rows:
                yield f[list(_columns(PART_SCHEMA))]
            return
        clock = _Clock(timerValues, self.horizon_ms)
        state = self.counts.get()
        known = {} if state is None else {m: (n, live) for m, n, live in zip(*state)}
        before = dict(known)
        last: dict[int, tuple[int, int, int]] = {}
        asked, lost, behind, here = [], 0, False, False
        for f in rows:  # one row a changed minute; what a timer says comes last
            for role, minute, n, live, ahead, asks, shrunk, back in zip(
                    *(f[c].tolist() for c in ("role", "minute", "n", "live", "ahead", "asked", "shrunk", "behind"))):
                if role == HERE:
                    here = True
                    continue
                if asks:
                    asked.append(minute)
                behind |= back
                if shrunk and minute in known:
                    n_known, live_known = known[minute]
                    # a lane's timer also speaks for minutes that lost nothing since
                    if not n or n - live != n_known - live_known:
                        lost += live_known - live
                if minute not in last or shrunk:
                    last[minute] = (n, live, ahead)
        for minute, (n, live, _) in last.items():
            if n:
                known[minute] = (n, live)
            else:
                known.pop(minute, None)
        if known != before:
            if known:
                self.counts.update(([*known], [n for n, _ in known.values()], [live for _, live in known.values()]))
            else:
                self.counts.clear()
        parts = []
        if asked:
            minutes, asking = np.array(sorted(known), np.int64), np.array(asked, np.int64)
            upto = np.concatenate([[0], np.cumsum([known[m][0] for m in minutes.tolist()])])
            parts.append({"minute": asking, "role": BASE, "n": upto[np.searchsorted(minutes, asking)]
                          - upto[np.searchsorted(minutes, asking - self.minutes_in_window, "right")]})
        if lost > 0 or behind or here:
            count = sum(live for _, live in known.values()) - sum(ahead for _, _, ahead in last.values())
            now = {"us": clock.now_us, "n": np.array([count], np.int64)}
            if lost > 0 or behind:
                parts.append({**now, "role": EXPIRE if lost > 0 else LEVEL})
            if here:
                parts.append({**now, "role": HERE})
        if parts:
            yield _frame(PART_SCHEMA, [{"name": key[0], "no_id": True, **part} for part in parts])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return iter(())

    def close(self) -> None:
        pass


def split_parts(mentions: DataFrame, window_us: int = HOUR_US, lateness_us: int = HOUR_US, horizon_ms: int = DAY_MS,
                ts_col: str = "ts", name_col: str = "name", id_col: str = "event_id") -> DataFrame:
    """The streaming answers of both operators, joined per batch by :class:`SplitHistogram`."""
    if window_us % MINUTE_US or lateness_us % MINUTE_US:
        raise ValueError("window and lateness are whole minutes")
    if horizon_ms * 1000 < lateness_us:
        raise ValueError("the horizon must not be shorter than the lateness")
    use_rocksdb_state(mentions.sparkSession)
    us = micros(F.col(ts_col))
    event_id = F.col(id_col).cast("long")
    rows = mentions.select(F.coalesce(event_id, F.lit(0).cast("long")).alias("event_id"), event_id.isNull().alias("no_id"),
                           F.coalesce(F.concat(F.lit("s"), F.col(name_col)), F.lit("n")).alias("name"), us.alias("us"),
                           F.timestamp_millis(((us + F.pmod(-us, F.lit(1000))) / F.lit(1000)).cast("long")).alias("et")) \
        .filter(F.col("us").isNotNull()).withWatermark("et", f"{horizon_ms} milliseconds")
    minute = F.expr(f"(us - pmod(us, {MINUTE_US}L)) div {MINUTE_US}L")
    sent = F.explode(F.array(F.struct(minute.alias("minute"), F.lit(False).alias("probe")),
                             F.struct((minute - window_us // MINUTE_US).alias("minute"), F.lit(True).alias("probe"))))
    rows = rows.select("event_id", "no_id", "name", "us", "et", sent.alias("_to")) \
        .select("event_id", "no_id", "name", "us", "et", F.expr(f"int(pmod(_to.minute, {LANES}L))").alias("lane"), "_to.probe")
    first = rows.groupBy("name", "lane").transformWithStateInPandas(
        statefulProcessor=MinuteProcessor(window_us, lateness_us, horizon_ms), outputStructType=MINUTE_SCHEMA,
        outputMode="Append", timeMode="EventTime", eventTimeColumnName="et")
    return first.groupBy("name", "lane").transformWithStateInPandas(
        statefulProcessor=NameProcessor(window_us, horizon_ms), outputStructType=PART_SCHEMA,
        outputMode="Append", timeMode="EventTime")


class SplitHistogram:
    """Sink for :func:`split_parts`; ``then(updates, batch_id)`` gets each batch's updates."""

    def __init__(self, base: str, then: Callable[[DataFrame, int], None] | None = None):
        self.base = base.rstrip("/")
        self.then = then

    def _path(self, kind: str, batch_id: int) -> str:
        return f"{self.base}/{kind}/batch={batch_id}"

    def __call__(self, parts: DataFrame, batch_id: int) -> None:
        spark = parts.sparkSession
        seen = Observation()
        # the stateful plan runs once a batch
        parts.observe(seen, F.count_if(F.col("role") == OWN).alias("own"), F.count_if(F.col("role") == LATE).alias("late")) \
            .write.mode("overwrite").parquet(self._path("parts", batch_id))
        rows = seen.get
        p = spark.read.schema(PART_SCHEMA).parquet(self._path("parts", batch_id)) \
            .withColumn("event_id", F.expr("if(no_id, null, event_id)"))

        def of(role: int, *cols: str) -> DataFrame:
            return p.filter(F.col("role") == role).select(*cols)

        own = of(OWN, "name", "minute", "event_id", "us", "n").withColumnRenamed("n", "own")
        base = of(BASE, "name", "minute", "n").withColumnRenamed("n", "base")
        probe = of(PROBE, "name", "minute", "us", "n").withColumnRenamed("n", "probe")
        counted = own.join(base, ["name", "minute"]).join(probe, ["name", "minute", "us"], "left").select(
            "event_id", "name", (F.col("own") + F.col("base") + F.coalesce("probe", F.lit(0))).alias("count"), "us",
            F.lit("arrival").alias("kind"))
        closing = p.filter(F.col("role").isin(EXPIRE, LEVEL)).select(
            "event_id", "name", F.col("n").alias("count"), "us",
            F.when(F.col("role") == EXPIRE, "expire").otherwise("level").alias("kind"))
        late = of(LATE, "event_id", "name", "us", "n")
        here = of(HERE, "name", "n").withColumnRenamed("n", "count")
        lates = late.join(here, "name").select("event_id", "name", "count", "us", F.lit("late").alias("kind"))
        name = F.expr("if(name = 'n', null, substring(name, 2))")
        updates = closing
        for some, of_kind in ((rows["own"], counted), (rows["late"], lates)):
            updates = updates.unionByName(of_kind) if some else updates  # no join for what didn't come
        updates.withColumn("name", name) \
            .write.mode("overwrite").parquet(self._path("updates", batch_id))
        late.select("event_id", name.alias("name"), "us", F.col("n").alias("lag_us")) \
            .write.mode("overwrite").parquet(self._path("late", batch_id))
        if self.then:
            self.then(spark.read.schema(UPDATE_SCHEMA).parquet(self._path("updates", batch_id)), batch_id)
        if batch_id > 1:  # the answers are in the updates; those of the last two batches stay for a replay
            delete(spark, self._path("parts", batch_id - 2))


def read_updates(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(f"{UPDATE_SCHEMA}, batch LONG").parquet(f"{base.rstrip('/')}/updates")


def read_late(spark: SparkSession, base: str) -> DataFrame:
    """Every row that came later than the lateness, with how far it was behind stream time."""
    return spark.read.schema(f"{LATE_SCHEMA}, batch LONG").parquet(f"{base.rstrip('/')}/late")


class DroppedRows(StreamingQueryListener):
    """Sums the rows that Spark's watermark dropped before the operators, over whole runs."""

    def __init__(self):
        self.dropped = 0
        self.read = 0
        self.finished = False

    @property
    def mentions(self) -> int:
        """Dropped mentions: each stands twice before the first operator, as itself and as a probe."""
        return self.dropped // 2

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.read += int(event.progress.numInputRows or 0)
        self.dropped += sum(int(op.numRowsDroppedByWatermark or 0) for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.finished = True
