"""A table that a ``foreachBatch`` sink keeps by appending: merge on read.

Every batch adds one folder with its changed rows, so what is written follows the batch and
not the table.  A manifest per batch names the folders that make up the table: the last compacted
base and the deltas after it.  It is written last, under its final name in one step, and so
is the commit record: without the manifest of batch ``n`` nobody reads the folders of batch ``n``.
A reader merges base and deltas: of the rows of one key the newest counts, and a row
marked as gone takes its key away.  After ``every`` deltas the merged rows become the new
base; folders that neither the newest manifest nor the one before it names are deleted, so there are
at most ``2 * every + 2`` of them however long the stream runs.

Replay: a batch that runs again reads the manifest of the batch before (which is kept) and
overwrites its own folders, so it leaves the same table.

With ``shards`` the rows are laid out in folders by a hash of the key, and a reader that names
shards lists only those.  Without ``keys`` the table is a log: all rows count, and ``keep`` drops
old ones at compaction.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVERY = 16


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_json(spark: SparkSession, path: str) -> dict | None:
    """A small JSON file of the shared folder, None if there is none."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, content: dict) -> None:
    """Writes beside the final name and renames, so that a reader sees all of it or nothing."""
    fs, part = _hadoop(spark, f"{path}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    _, p = _hadoop(spark, path)
    if fs.exists(p):  # a batch that runs again
        fs.delete(p, False)
    if not fs.rename(part, p):
        raise RuntimeError(f"could not commit {path}")


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Gives a file or folder another name in one step; False if there is none."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return False
    _, target = _hadoop(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise RuntimeError(f"could not move {path} to {to}")
    return True


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


class DeltaTable:
    def __init__(self, base: str, schema: str, keys: Sequence[str] = (), shards: int = 0, every: int = EVERY):
        self.base = base.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.shards = shards
        self.every = every

    # ---------------------------------------------------------------- manifests
    def manifest_path(self, batch_id: int) -> str:
        return f"{self.base}/commits/{batch_id}.json"

    def _manifest(self, spark: SparkSession, batch_id: int) -> dict:
        if batch_id < 0:
            return {"batch": batch_id, "newest": None, "base": None, "deltas": []}
        found = read_json(spark, self.manifest_path(batch_id))
        if found is None:
            raise RuntimeError(f"{self.base} has no batch {batch_id}: the folder and the stream's "
                               "checkpoint don't belong together")
        return found

    @staticmethod
    def _folders(manifest: dict) -> list[str]:
        base = [f"base={manifest['base']}"] if manifest["base"] is not None else []
        return base + [f"delta={d}" for d in manifest["deltas"]]

    # ---------------------------------------------------------------- reading
    def shard(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.shards)).cast("int")

    def _stored(self) -> str:
        return f"{self.schema}, _gone BOOLEAN, _batch LONG" + (", _shard INT" if self.shards else "")

    def _rows(self, spark: SparkSession, folders: Sequence[str], shards: Sequence[int] | None) -> DataFrame:
        """The merged rows of some folders."""
        if not folders:
            return spark.createDataFrame([], self.schema)
        rows = None
        for f in folders:  # each folder is a base path of its own: only _shard is a partition column
            one = spark.read.schema(self._stored()).parquet(f"{self.base}/rows/{f}")
            rows = one if rows is None else rows.unionByName(one)
        if shards is not None:
            rows = rows.filter(F.col("_shard").isin(list(shards)))
        names = [f.name for f in spark.createDataFrame([], self.schema).schema.fields]
        if not self.keys:
            return rows.select(*names)
        newest = rows.groupBy(*self.keys).agg(F.max_by(
            F.struct(*[c for c in names if c not in self.keys], "_gone"), "_batch").alias("_row"))
        return newest.filter(~F.col("_row._gone")).select(
            *[F.col(c) if c in self.keys else F.col(f"_row.{c}").alias(c) for c in names])

    def read(self, spark: SparkSession, batch_id: int, shards: Sequence[int] | None = None) -> tuple[DataFrame, int | None]:
        """The table as ``batch_id`` left it, and its stream time (nothing before the first batch)."""
        manifest = self._manifest(spark, batch_id)
        return self._rows(spark, self._folders(manifest), shards), manifest["newest"]

    def changed(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """The rows that ``batch_id`` wrote, with ``_gone``."""
        return spark.read.schema(self._stored()).parquet(f"{self.base}/rows/delta={batch_id}").drop("_batch")

    def latest(self, spark: SparkSession) -> tuple[int, DataFrame]:
        """Newest committed batch and its table, for a reader outside the stream."""
        fs, p = _hadoop(spark, f"{self.base}/commits")
        ids = [int(s.getPath().getName()[:-5]) for s in fs.listStatus(p) if s.getPath().getName().endswith(".json")]
        return max(ids), self.read(spark, max(ids))[0]

    # ---------------------------------------------------------------- writing
    def _write(self, rows: DataFrame, folder: str) -> None:
        writer = rows
        if self.shards:
            writer = rows.withColumn("_shard", self.shard()).repartition("_shard")
        out = writer.write.mode("overwrite")
        (out.partitionBy("_shard") if self.shards else out).parquet(f"{self.base}/rows/{folder}")

    def append(self, spark: SparkSession, changes: DataFrame | None, batch_id: int, newest: int | None = None,
               gone: Column | None = None, keep: Column | None = None) -> None:
        """Adds a batch's rows (at most one a key; None: no change) and commits them.

        ``gone`` marks rows that take their key away; ``keep`` is applied when the table is compacted.
        """
        before = self._manifest(spark, batch_id - 1)
        after = {"batch": batch_id, "newest": newest, "base": before["base"], "deltas": list(before["deltas"])}
        if changes is not None:
            names = [f.name for f in spark.createDataFrame([], self.schema).schema.fields]
            flag = F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)
            self._write(changes.withColumn("_gone", flag).select(*names, "_gone", F.lit(batch_id).cast("long").alias("_batch")),
                        f"delta={batch_id}")
            after["deltas"].append(batch_id)
        if len(after["deltas"]) >= self.every:
            merged = self._rows(spark, self._folders(after), None)
            merged = merged.filter(keep) if keep is not None else merged
            self._write(merged.withColumn("_gone", F.lit(False)).withColumn("_batch", F.lit(batch_id).cast("long")),
                        f"base={batch_id}")
            after["base"], after["deltas"] = batch_id, []
        write_json(spark, self.manifest_path(batch_id), after)
        self._clean(spark, batch_id, {*self._folders(before), *self._folders(after), f"delta={batch_id}"})

    def _clean(self, spark: SparkSession, batch_id: int, used: set[str]) -> None:
        """Deletes what only the manifest of two batches ago names, and that manifest."""
        old = read_json(spark, self.manifest_path(batch_id - 2)) if batch_id > 1 else None
        if old is not None:
            for folder in {*self._folders(old), f"delta={batch_id - 2}"} - used:
                delete(spark, f"{self.base}/rows/{folder}")
            delete(spark, self.manifest_path(batch_id - 2))
