"""W7-W9, K5, K6 on a stream: the live histogram, its exact top 100, and change messages.

``foreachBatch`` gets the histogram updates of one micro-batch (of
:mod:`mentionlab.streaming.trailing_batches`, or read back from where they were published).
The last update of each name is appended to the live histogram, a merge-on-read table
(:mod:`mentionlab.streaming.deltas`) in shards by name.

The top is kept up to date without reading that table.  Each shard has a list of its largest
entries (at most ``2 n``) and, as a bound, the largest entry that is in no list.  A batch's
changes go into the lists: an entry that sorts before its shard's bound is certain; one
that doesn't is left out, and what is cut from a full list raises the bound.  The top is
answered from the lists; only a shard whose bound sorts before the answer's last entry could
hold more, and that shard alone is read again (its folders only).  How often that came is kept beside
the lists.  Lists, bounds and counter are one small file a batch, ``2 n`` entries a shard
however many names there are; the driver sees those and as many changed rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mentionlab.operators.changes import change_message
from mentionlab.streaming.deltas import DeltaTable, delete, read_json, write_json

TOP_N = 100
SHARDS = 16
LIVE_SCHEMA = "name STRING, count LONG"

Entry = tuple[str | None, int]


def place(entry: Entry) -> tuple:
    """Order of the top: count descending, then name ascending (null first)."""
    return -entry[1], entry[0] is not None, entry[0] or ""


@dataclass
class Shard:
    """A shard's largest entries, best first, and the largest one that is not among them."""

    entries: list[Entry] = field(default_factory=list)
    bound: Entry | None = None

    def change(self, changes: dict[str | None, int], limit: int) -> None:
        """Takes in changed counts (0: gone): all of listed names, and the best ``limit + 1`` of others."""
        pool = [e for e in self.entries if e[0] not in changes] + [e for e in changes.items() if e[1] > 0]
        pool.sort(key=place)
        sure = pool if self.bound is None else [e for e in pool if place(e) < place(self.bound)]
        # the bound stays: it sorts before all that isn't sure
        self.entries, cut = sure[:limit], sure[limit:]
        if cut:
            self.bound = cut[0]

    def reset(self, best: list[Entry], limit: int) -> None:
        """Takes the best ``limit + 1`` entries as they are in the table."""
        best = sorted(best, key=place)
        self.entries, self.bound = best[:limit], best[limit] if len(best) > limit else None


def to_rescan(shards: dict[int, Shard], n: int) -> list[int]:
    """Shards that could hold an entry of the top ``n`` which their lists don't show."""
    listed = sorted((e for s in shards.values() for e in s.entries), key=place)
    last = place(listed[n - 1]) if len(listed) >= n else None
    return [i for i, s in shards.items() if s.bound is not None and (last is None or place(s.bound) < last)]


class Tops:
    """The lists of all shards, as one file a batch; those of the last two batches are kept."""

    def __init__(self, base: str, n: int):
        self.base, self.n = base.rstrip("/"), n

    def _path(self, batch_id: int) -> str:
        return f"{self.base}/tops/{batch_id}.json"

    def load(self, spark: SparkSession, batch_id: int) -> tuple[dict[int, Shard], dict]:
        stored = read_json(spark, self._path(batch_id)) if batch_id >= 0 else None
        if stored is None:
            if batch_id >= 0:
                raise RuntimeError(f"{self.base} has no batch {batch_id}: the folder and the stream's "
                                   "checkpoint don't belong together")
            return {}, {"batches": 0, "rescans": 0}
        shards = {int(i): Shard([(n, c) for n, c in s["entries"]], tuple(s["bound"]) if s["bound"] else None)
                  for i, s in stored["shards"].items()}
        return shards, {"batches": stored["batches"], "rescans": stored["rescans"]}

    def save(self, spark: SparkSession, batch_id: int, shards: dict[int, Shard], counters: dict) -> None:
        write_json(spark, self._path(batch_id), {**counters, "shards": {
            str(i): {"entries": s.entries, "bound": s.bound} for i, s in shards.items()}})
        if batch_id > 1:
            delete(spark, self._path(batch_id - 2))

    def top(self, shards: dict[int, Shard]) -> list[Entry]:
        return sorted((e for s in shards.values() for e in s.entries), key=place)[:self.n]


def _live(base: str) -> DeltaTable:
    return DeltaTable(f"{base.rstrip('/')}/current", LIVE_SCHEMA, ["name"], shards=SHARDS)


def _best(rows: DataFrame, n: int) -> DataFrame:
    """The best ``n`` entries of every shard (a group limit before the shuffle, then one row number)."""
    order = Window.partitionBy("_shard").orderBy(F.col("count").desc(), F.col("name").asc())
    return rows.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= n)


class Top100Writer:
    def __init__(self, base: str, n: int = TOP_N, slack: int = 2):
        self.base = base.rstrip("/")
        self.n = n
        self.limit = slack * n
        self.live = _live(base)
        self.tops = Tops(base, n)

    def __call__(self, updates: DataFrame, batch_id: int) -> None:
        spark = updates.sparkSession
        # updates without an id (expire, level) hold at the end of their batch
        order = F.struct(*(["batch"] if "batch" in updates.columns else []), "us",
                         F.col("event_id").isNull().alias("closing"))
        latest = updates.groupBy("name").agg(F.max_by("count", order).cast("bigint").alias("count"))
        self.live.append(spark, latest, batch_id, gone=F.col("count") <= 0)
        shards, counters = self.tops.load(spark, batch_id - 1)
        before = dict(self.tops.top(shards))
        for i, changes in self._changes(spark, shards, batch_id).items():
            shards.setdefault(i, Shard()).change(changes, self.limit)
        again = to_rescan(shards, self.n)
        if again:
            self._rescan(spark, shards, again, batch_id)
        counters = {"batches": counters["batches"] + 1, "rescans": counters["rescans"] + len(again)}
        after = dict(self.tops.top(shards))
        moved = [(n, c) for n, c in after.items() if before.get(n) != c] + [(n, 0) for n in before if n not in after]
        msg = change_message(spark.createDataFrame(moved, LIVE_SCHEMA)).filter(F.col("entries") > 0)
        msg.withColumn("batch_id", F.lit(batch_id).cast("bigint")) \
            .write.mode("overwrite").parquet(f"{self.base}/messages/batch={batch_id}")
        self.tops.save(spark, batch_id, shards, counters)

    def _changes(self, spark: SparkSession, shards: dict[int, Shard], batch_id: int) -> dict[int, dict[str | None, int]]:
        """By shard: the changes of listed names, and the best of the others (one more than a list holds)."""
        rows = self.live.changed(spark, batch_id)
        listed = spark.createDataFrame([(n,) for s in shards.values() for n, _ in s.entries], "listed STRING")
        known = rows.join(F.broadcast(listed), rows["name"].eqNullSafe(listed["listed"]), "left_semi")
        found = _best(rows.filter("NOT _gone"), self.limit + 1).select("_shard", "name", "count") \
            .unionByName(known.select("_shard", "name", F.when(F.col("_gone"), 0).otherwise(F.col("count")).alias("count")))
        out: dict[int, dict[str | None, int]] = {}
        for r in found.collect():  # at most 2 * limit + 1 rows a shard
            out.setdefault(r["_shard"], {})[r["name"]] = r["count"]
        return out

    def _rescan(self, spark: SparkSession, shards: dict[int, Shard], again: list[int], batch_id: int) -> None:
        rows, _ = self.live.read(spark, batch_id, again)
        best: dict[int, list[Entry]] = {i: [] for i in again}
        for r in _best(rows.withColumn("_shard", self.live.shard()), self.limit + 1).collect():
            best[r["_shard"]].append((r["name"], r["count"]))
        for i, entries in best.items():
            shards[i].reset(entries, self.limit)


def messages(spark: SparkSession, base: str) -> DataFrame:
    """K5: every change message written so far, ``(batch_id, message, entries)``."""
    return spark.read.parquet(f"{base.rstrip('/')}/messages").select("batch_id", "message", "entries")


def live_histogram(spark: SparkSession, base: str) -> tuple[int, DataFrame]:
    """Newest batch and the whole live histogram, merged from its base and deltas."""
    return _live(base).latest(spark)


def latest_snapshot(spark: SparkSession, base: str, n: int = TOP_N) -> DataFrame:
    """K6: the top ``n`` of the newest batch as one JSON array, for a late subscriber."""
    batch_id, live = live_histogram(spark, base)
    snap = change_message(live.orderBy(F.col("count").desc(), F.col("name").asc()).limit(n).select("name", "count"))
    return snap.select(F.lit(batch_id).cast("bigint").alias("batch_id"), "message", "entries")


def rescans(spark: SparkSession, base: str, batch_id: int) -> dict:
    """How many batches were answered so far, and how many shards had to be read again for them."""
    return Tops(base, TOP_N).load(spark, batch_id)[1]
