"""Session defaults and the shared folders a job may write to.

A job never writes to a machine-local temporary folder on a cluster: lineage is
cut and streaming state is kept under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (tests, a laptop)
do we make one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# commit only the changes of each batch instead of uploading state snapshots every batch
CHANGELOG_KEY = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "mentionlab", extra: dict | None = None) -> SparkSession:
    """Session with UTC time, AQE (coalescing and skew-join splitting) and RocksDB state."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        CHANGELOG_KEY: "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; our own only when none is set."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        current = sc.getCheckpointDir()
        if current:
            # the context appends a run folder; keep our files beside it
            root = os.path.dirname(current.rstrip("/"))
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(checkpoints, written tables and stream state go there)")
        # local mode only (tests, a laptop): driver and executors share this machine
        root = tempfile.mkdtemp(prefix="mentionlab-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the checkpoint root for written tables and stream state."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "mentionlab", uuid.uuid4().hex, *parts])


def use_rocksdb_state(spark: SparkSession) -> None:
    """Stateful processors with several state variables need the RocksDB state store.

    Set on the session before a new streaming query starts (the choice is then kept in the
    query's checkpoint); a no-op when the session already uses it.
    """
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)
    if spark.conf.get(CHANGELOG_KEY, None) is None:
        spark.conf.set(CHANGELOG_KEY, "true")
