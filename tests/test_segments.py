"""Segment bookkeeping: incremental pick-up by file name (S8), tier globs (S3), grid (S7), observe (A4)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from mentionlab.functions import times as TM
from mentionlab.operators.profile import with_row_count
from mentionlab.sources.gkg import TIER_NAMES, read_gkg_text, tier_paths
from mentionlab.sources.segments import read_new_segments


def write_segment(base, name, rows):
    os.makedirs(base, exist_ok=True)
    with open(os.path.join(base, name), "w") as f:
        for key, names in rows:
            cols = [""] * 27
            cols[0], cols[1], cols[23] = key, key[:14], names
            f.write("\t".join(cols) + "\n")


def test_incremental_pickup_and_tiers(spark, workdir):
    base = workdir + "/seg"
    write_segment(base, "20150218230000.gkg.csv", [("20150218230000-1", "A,1")])
    write_segment(base, "20150218231500.gkg.csv", [("20150218231500-1", "B,1"), ("20150218231500-2", "C,1")])
    write_segment(base, "20150219000000.gkg.csv", [("20150219000000-1", "D,1")])
    new = read_new_segments(spark, base, "20150218230000")
    assert sorted(r.all_names for r in new.collect()) == ["B,1", "C,1", "D,1"]
    write_segment(base, "20150601000000.gkg.csv", [("20150601000000-1", "E,1")])
    write_segment(base, "20150701000000.gkg.csv", [("20150701000000-1", "F,1")])
    write_segment(base, "20160101000000.gkg.csv", [("20160101000000-1", "G,1")])
    rows = {t: read_gkg_text(spark, tier_paths(base, t, "20150218230000")).count() for t in TIER_NAMES}
    # one segment, the month, January to June, the year, everything
    assert rows == {"small": 1, "medium": 4, "large": 5, "xlarge": 6, "full": 7, "local": 7}
    with pytest.raises(ValueError):
        tier_paths(base, "huge", "20150218230000")


def test_lookback_grid(spark):
    now = spark.createDataFrame([(dt.datetime(2015, 2, 19, 0, 7, 30),)], "now TIMESTAMP")
    names = now.select(F.explode(TM.lookback_segments(F.col("now"))).alias("s")) \
        .select(TM.segment_name(F.col("s")).alias("n")).collect()
    # the newest full interval before 00:00-00:15 is 23:45-00:00; a 60-minute window holds four
    assert [r.n for r in names] == ["20150218230000.gkg.csv", "20150218231500.gkg.csv",
                                    "20150218233000.gkg.csv", "20150218234500.gkg.csv"]


def test_observed_count(spark):
    df, obs = with_row_count(spark.range(123))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 123


def test_segment_lines_spread_and_schedule(spark, workdir):
    from mentionlab.operators.replay import replay_schedule, spread_timestamps
    from mentionlab.sources.segments import segment_lines
    base = workdir + "/seg"
    write_segment(base, "20150218230000.gkg.csv", [(f"20150218230000-{i}", "A,1") for i in (2, 0, 1)])
    write_segment(base, "20150218231500.gkg.csv", [(f"20150218231500-{i}", "B,1") for i in (0, 1)])
    lines = segment_lines(spark, base)
    spread = spread_timestamps(lines, "segment", F.col("seg_start"), "seq").collect()
    start = int(dt.datetime(2015, 2, 18, 23, 0, tzinfo=dt.timezone.utc).timestamp() * 1000)
    got = {r.record_key: r.ms - start for r in spread}
    assert got == {"20150218230000-0": 0, "20150218230000-1": 300000, "20150218230000-2": 600000,
                   "20150218231500-0": 900000, "20150218231500-1": 1350000}
    sched = {r.record_key: r.send_second for r in replay_schedule(lines, "segment", "seq").collect()}
    assert sched["20150218230000-2"] == 600 and sched["20150218231500-1"] == 450
