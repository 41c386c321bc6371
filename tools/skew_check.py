"""Skew check: one name with a third of all rows; naive per-name window vs the bucketed plan.

Reads task times from Spark's event log (written to a scratch folder) and prints, per plan,
wall time and the largest task's share of the busiest stage.
Usage: python tools/skew_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window
from pyspark.sql import functions as F  # noqa: E402

from mentionlab.functions.times import micros  # noqa: E402
from mentionlab.operators.histogram import HOUR_US, trailing_counts  # noqa: E402
from mentionlab.plans.ranking import number_rows  # noqa: E402
from mentionlab.session import build_session  # noqa: E402


def task_stats(log_dir: str, job_group: str):
    """Per stage of the given job group: (#tasks, max task ms, median task ms)."""
    stages_of_group, tasks = set(), defaultdict(list)
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    if props.get("spark.jobGroup.id") == job_group:
                        stages_of_group.update(ev.get("Stage IDs", []))
                elif kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    tasks[ev["Stage ID"]].append(info["Finish Time"] - info["Launch Time"])
    out = []
    for s in sorted(stages_of_group):
        t = sorted(tasks.get(s, []))
        if t:
            out.append((s, len(t), t[-1], t[len(t) // 2]))
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 20
    log_dir = tempfile.mkdtemp(prefix="mentionlab-eventlog-")
    spark = build_session("local[8]", 32, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
                                                  "spark.driver.memory": "8g"})
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    span = ev.agg(F.max(F.col("ts").cast("timestamp")).cast("long") - F.min(F.col("ts").cast("timestamp")).cast("long")).first()[0] + 1
    rep = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("r"))
    data = rep.select(
        (F.col("event_id") * copies + F.col("r")).alias("id"),
        (F.col("ts").cast("timestamp") + F.make_dt_interval(secs=F.col("r") * F.lit(span))).alias("ts"),
        F.when(F.pmod(F.col("event_id"), F.lit(3)) == 0, F.lit("hot"))
        .otherwise(F.concat(F.col("event_type"), F.pmod("user_id", F.lit(40)).cast("string"))).alias("name"))
    path = tempfile.mkdtemp(prefix="mentionlab-skew-") + "/data"
    data.write.parquet(path)
    df = spark.read.parquet(path)
    n = df.count()
    print(f"rows={n} hot={df.filter(F.col('name') == 'hot').count()}")
    plans = {
        "trailing_window": lambda: df.withColumn("count", F.count(F.lit(1)).over(
            Window.partitionBy("name").orderBy(micros(F.col("ts"))).rangeBetween(1 - HOUR_US, 0))),
        "trailing_counts": lambda: trailing_counts(df, "name", "ts", "id"),
        "rownum_window": lambda: df.withColumn("pos", F.row_number().over(
            Window.partitionBy("name").orderBy("ts", "id"))),
        "number_rows": lambda: number_rows(df, ["name"], [F.col("ts"), F.col("id")]),
    }
    for label, build in plans.items():
        spark.sparkContext.setJobGroup(label, label)
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        wall = time.perf_counter() - t0
        spark.sparkContext.setJobGroup("idle", "idle")
        print(f"{label}: {wall:.2f}s")
    spark.stop()
    for label in plans:
        stats = task_stats(log_dir, label)
        for st in stats:
            print(f"{label}: stage {st[0]}: {st[1]} tasks, max task {st[2]} ms, median {st[3]} ms")


if __name__ == "__main__":
    main()
