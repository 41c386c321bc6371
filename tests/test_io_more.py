"""Remaining readers and sinks: undecodable bytes, typed view, keyed sinks, streaming increments."""

import os

import pytest
from pyspark.sql import functions as F

from mentionlab.plans.catalog_io import run_to_end
from mentionlab.schemas import MENTION_SCHEMA, require_columns
from mentionlab.sinks import keyed_records, publish_updates, published_updates
from mentionlab.sources.gkg import read_gkg_text
from mentionlab.streaming.increments import running_totals
from mentionlab.streaming.sources import file_stream


def test_text_path_drops_undecodable_bytes(spark, workdir):
    os.makedirs(workdir + "/raw")
    cols = [""] * 27
    cols[0], cols[1], cols[23] = "k1", "20150218230000", "Caf\xe9,1;Bar,2"
    with open(workdir + "/raw/x.gkg.csv", "wb") as f:
        f.write("\t".join(cols).encode("latin-1") + b"\n")  # 0xE9 alone is not UTF-8
    names = read_gkg_text(spark, workdir + "/raw").select("all_names").first()[0]
    assert names == "Caf,1;Bar,2"


def test_require_columns(spark):
    ok = spark.createDataFrame([("r", None, None, "t")], "record_id STRING, ts TIMESTAMP, date DATE, topic STRING")
    assert require_columns(ok.select("topic", "date", "ts", "record_id"), MENTION_SCHEMA).columns == \
        ["record_id", "ts", "date", "topic"]
    with pytest.raises(ValueError):
        require_columns(ok.drop("topic"), MENTION_SCHEMA)
    with pytest.raises(TypeError):
        require_columns(ok.withColumn("date", F.lit("x")), MENTION_SCHEMA)


def test_keyed_sinks(spark, workdir):
    df = spark.createDataFrame([("a", 3, 1), ('q"', 1, 2)], "name STRING, count LONG, ts LONG")
    rec = keyed_records(df, "name", "ts").orderBy("key").collect()
    assert rec[0].key == "a" and rec[0].value == '{"name":"a","count":3,"ts":1}' and rec[0].timestamp == 1
    updates = spark.createDataFrame([(1, "a", 1, 10), (2, "a", 2, 20), (None, "a", 1, 20), (3, 'q"', 1, 5)],
                                    "event_id LONG, name STRING, count LONG, us LONG")
    publish_updates(updates, 4, workdir + "/pub")
    h = spark.read.parquet(workdir + "/pub/batch=4").orderBy("key").collect()
    assert [r.value for r in h] == ['{"name":"a","count":1,"us":20,"batch":4}', '{"name":"q\\"","count":1,"us":5,"batch":4}']
    junk = spark.createDataFrame([("x", "no json"), ("y", None)], "key STRING, value STRING")
    back = published_updates(spark.createDataFrame(h).select("key", "value").union(junk)).collect()
    assert sorted((r.name, r["count"], r.us, r.batch) for r in back) == [("a", 1, 20, 4), ('q"', 1, 5, 4)]


def test_streaming_increments(spark, workdir):
    src, out, ckpt = workdir + "/in", workdir + "/out", workdir + "/ckpt"
    spark.createDataFrame([("n1", 1), ("n2", 3), ("n1", 2)], "name STRING, increment INT").write.parquet(src + "/a")
    stream = file_stream(spark, src + "/*", "name STRING, increment INT")
    q = running_totals(stream).writeStream.outputMode("update").format("memory").queryName("totals_t") \
        .option("checkpointLocation", ckpt)
    run_to_end(q)
    assert sorted(map(tuple, spark.sql("SELECT * FROM totals_t").collect())) == [("n1", 3), ("n2", 3)]


def test_library_helpers(spark):
    from mentionlab.operators.topk import article_counts
    from mentionlab.sources.gkg import java_width
    m = spark.createDataFrame([("r1", "2015-02-18", "A"), ("r1", "2015-02-18", "A"), ("r2", "2015-02-18", "A")],
                              "record_id STRING, d STRING, topic STRING").withColumn("date", F.to_date("d"))
    assert article_counts(m).first().articles == 2
    lines = spark.createDataFrame([("a\tb\t\t",), ("",)], "value STRING")
    assert sorted(r.width for r in lines.select(java_width(F.col("value")).alias("width")).collect()) == [1, 2]


def test_parse_record_key_is_strict(spark):
    from mentionlab.functions.times import parse_record_key
    keys = ["12-34", "+1-2", " 1-2", "12-", "-5", "1-2-3", "x-1", "99999999999999999999-1", "7-08"]
    df = spark.createDataFrame([(k,) for k in keys], "key STRING").select("key", parse_record_key(F.col("key")).alias("p"))
    got = {r.key: (r.p.a, r.p.b) for r in df.collect()}
    assert got == {"12-34": (12, 34), "+1-2": (1, 2), " 1-2": (0, 0), "12-": (0, 0), "-5": (0, 0),
                   "1-2-3": (0, 0), "x-1": (0, 0), "99999999999999999999-1": (0, 0), "7-08": (7, 8)}
