"""The command-line jobs, run in-process on the test session."""

import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

from mentionlab.__main__ import main
from tests.test_sources import EDGE_LINES, gkg_row, write_lines


def test_topk_csv_text_and_parquet(spark, workdir):
    src = write_lines(workdir + "/gkg", EDGE_LINES)
    headers = workdir + "/headers.csv"
    from mentionlab.schemas import GKG_COLUMNS
    with open(headers, "w") as f:
        for c in GKG_COLUMNS:
            t = "TIMESTAMP" if c == "date" else ("INTEGER" if c == "sourceCollectionIdentifier" else "STRING")
            f.write(f"{c}\t{t}\tNULLABLE\t\n")
    main(["topk", "--input", src, "--output", workdir + "/csv", "--format", "csv", "--schema", headers])
    runs = os.listdir(workdir + "/csv")
    assert len(runs) == 1
    top = spark.read.json(f"{workdir}/csv/{runs[0]}")
    assert ("New York", 2) in {(r.topic, r["count"]) for r in top.collect()}
    main(["topk", "--input", src, "--output", workdir + "/docs", "--format", "text", "--documents",
          "--tier", "small", "--first-segment", "20150218230000"])
    assert spark.read.json(workdir + "/docs").count() == 2  # two days
    main(["convert", "--input", src, "--output", workdir + "/pq"])
    main(["topk", "--input", workdir + "/pq", "--output", workdir + "/fromparquet", "--format", "parquet"])
    runs = os.listdir(workdir + "/fromparquet")
    assert spark.read.json(f"{workdir}/fromparquet/{runs[0]}").count() == top.count()


def test_histogram_once(spark, workdir):
    lines = [gkg_row(f"2015021823{m:02d}00-{i}", f"2015021823{m:02d}00", "A,1;B,2;A,3") for i, m in enumerate([0, 15, 30])]
    table = pa.table({"key": [l.split("\t")[0] for l in lines], "value": lines,
                      "timestamp": pa.array([pd.Timestamp("2015-02-18 23:00", tz="UTC")] * 3, pa.timestamp("us", tz="UTC"))})
    os.makedirs(workdir + "/in")
    pq.write_table(table, workdir + "/in/part-0.parquet")
    main(["histogram", "--input", workdir + "/in", "--output", workdir + "/out", "--checkpoint",
          workdir + "/ckpt", "--once"])
    from mentionlab.streaming.top100 import latest_snapshot
    assert latest_snapshot(spark, workdir + "/out").first().message == '[{"name":"A","count":6},{"name":"B","count":3}]'


def test_replay_then_histogram(spark, workdir):
    from tests.test_segments import write_segment
    base = workdir + "/seg"
    write_segment(base, "20150218230000.gkg.csv", [(f"20150218230000-{i}", "A,1;B,2") for i in range(3)])
    write_segment(base, "20150219000000.gkg.csv", [("20150219000000-0", "A,1")])
    main(["replay", "--input", base, "--output", workdir + "/records"])
    rec = spark.read.parquet(workdir + "/records").orderBy("key").collect()
    assert [str(r.timestamp)[11:19] for r in rec] == ["23:00:00", "23:05:00", "23:10:00", "00:00:00"]
    main(["histogram", "--input", workdir + "/records", "--output", workdir + "/out", "--checkpoint",
          workdir + "/ckpt", "--once", "--publish", workdir + "/pub"])
    # in (23:00, 00:00]: A at 23:05, 23:10 and 00:00, B at 23:05 and 23:10
    want = '[{"name":"A","count":3},{"name":"B","count":2}]'
    from mentionlab.streaming.top100 import latest_snapshot
    assert latest_snapshot(spark, workdir + "/out").first().message == want
    main(["top100", "--input", workdir + "/pub", "--output", workdir + "/again", "--checkpoint", workdir + "/ckpt2", "--once"])
    assert latest_snapshot(spark, workdir + "/again").first().message == want
