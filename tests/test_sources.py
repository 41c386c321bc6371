"""Readers: GKG edge rows (D2-D5), sensor rows of the manual, schema file, manifest, daily JSON."""

import os

import pytest
from pyspark.sql import functions as F

from mentionlab.operators.mentions import mentions_from_gkg, mentions_from_text
from mentionlab.operators.topk import article_counts, daily_topk
from mentionlab.schemas import GKG_COLUMNS, GKG_SCHEMA
from mentionlab.sinks import write_daily_documents, write_json_run
from mentionlab.sources.daily_json import read_daily_json
from mentionlab.sources.gkg import read_gkg_csv, read_gkg_text, schema_from_headers
from mentionlab.sources.segments import read_manifest
from mentionlab.sources.sensor import read_sensor_csv


def gkg_row(key, date, names, amounts="", width=27):
    cols = [""] * 27
    cols[0], cols[1], cols[2], cols[3] = key, date, "1", "src"
    cols[23], cols[24] = names, amounts
    return "\t".join(cols[:width])


EDGE_LINES = [
    gkg_row("r1", "20150218230000", "Islamic State,12;New York,40;New York,90"),
    gkg_row("r2", "20150218231500", "Foo, Bar,123"),
    gkg_row("r3", "20150218231500", "A,12B,3"),
    gkg_row("r4", "20150219000000", "United States,7;"),
    gkg_row("r5", "20150219000000", "", amounts="5,dollars,1"),
    gkg_row("r6", "20150219000000", ""),
    gkg_row("r7", "20150219000000", "Short,1", width=4),
    gkg_row("r8", "notadate", "X,1"),
    gkg_row("r9", "20150219010000", '"Quoted,1;Thing,2'),
]


def write_lines(path, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "20150218230000.gkg.csv"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_gkg_csv_edge_rows(spark, workdir):
    df = read_gkg_csv(spark, write_lines(workdir + "/gkg", EDGE_LINES))
    assert df.schema == GKG_SCHEMA
    got = sorted((r.record_id, r.topic) for r in mentions_from_gkg(df).collect())
    assert got == sorted([
        ("r1", "Islamic State"), ("r1", "New York"), ("r1", "New York"),
        ("r2", "Foo, Bar"), ("r3", "A,12B"), ("r4", "United States"),
        ("r9", '"Quoted'), ("r9", "Thing"),
    ])
    arts = {(r.topic, r.articles) for r in article_counts(mentions_from_gkg(df)).collect()}
    assert ("New York", 1) in arts


def test_gkg_name_rules(spark, workdir):
    df = read_gkg_csv(spark, write_lines(workdir + "/gkg", EDGE_LINES))
    regex = {r.topic for r in mentions_from_gkg(df, "all_offsets").collect()}
    assert "AB" in regex and "Foo, Bar" in regex
    head = {r.topic for r in mentions_from_gkg(df, "head").collect()}
    assert "A" in head and "Foo" in head


def test_gkg_text_path(spark, workdir):
    text = read_gkg_text(spark, write_lines(workdir + "/gkg", EDGE_LINES))
    got = sorted((r.record_id, r.topic) for r in mentions_from_text(text).collect())
    assert got == sorted([
        ("r1", "Islamic State"), ("r1", "New York"), ("r1", "New York"),
        ("r2", "Foo"), ("r3", "A"), ("r4", "United States"),
        ("r9", '"Quoted'), ("r9", "Thing"),
    ])


def test_dataframe_and_text_paths_agree_on_clean_rows(spark, workdir):
    clean = [gkg_row(f"k{i}", f"2015021{8 + i % 2}0{i % 10}0000", f"N{i % 3},1;N{i % 5},2;M,3") for i in range(40)]
    path = write_lines(workdir + "/clean", clean)
    a = daily_topk(mentions_from_gkg(read_gkg_csv(spark, path)))
    b = daily_topk(mentions_from_text(read_gkg_text(spark, path)))
    assert sorted(a.collect()) == sorted(b.collect())


# The sensor rows printed in the manual (ten read rows and the ten rows at 1:01).
SENSOR_LINES = """COHUTTA,3/10/14:1:01,10.27,1.73,881,1.56,85,1.94
COHUTTA,3/10/14:1:02,9.67,1.731,882,0.52,87,1.79
COHUTTA,3/10/14:1:03,10.47,1.732,882,1.7,92,0.66
COHUTTA,3/10/14:1:05,9.56,1.734,883,1.35,99,0.68
COHUTTA,3/10/14:1:06,9.74,1.736,884,1.27,92,0.73
COHUTTA,3/10/14:1:08,10.44,1.737,885,1.34,93,1.54
COHUTTA,3/10/14:1:09,9.83,1.738,885,0.06,76,1.44
COHUTTA,3/10/14:1:11,10.49,1.739,886,1.51,81,1.83
COHUTTA,3/10/14:1:12,9.79,1.739,886,1.74,82,1.91
COHUTTA,3/10/14:1:13,10.02,1.739,886,1.24,86,1.79
LAGNAPPE,3/10/14:1:01,9.59,1.602,777,0.09,88,1.78
NANTAHALLA,3/10/14:1:01,10.47,1.712,778,1.96,76,0.78
CHER,3/10/14:1:01,10.17,1.653,777,1.89,96,1.57
THERMALITO,3/10/14:1:01,10.24,1.75,777,1.25,80,0.89
ANDOUILLE,3/10/14:1:01,10.26,1.048,777,1.88,94,1.66
BUTTE,3/10/14:1:01,10.12,1.379,777,1.58,83,0.67
MOJO,3/10/14:1:01,10.47,1.828,967,0.36,77,1.75
CARGO,3/10/14:1:01,9.93,1.903,778,0.55,76,1.44
BBKING,3/10/14:1:01,10.03,0.839,967,1.17,80,1.28"""


def test_sensor_filter_sql_and_dataframe(spark, workdir):
    os.makedirs(workdir + "/sensor")
    with open(workdir + "/sensor/sensordata.csv", "w") as f:
        f.write(SENSOR_LINES + "\n")
    df = read_sensor_csv(spark, workdir + "/sensor")
    assert df.count() == 19 and df.filter(F.col("timestamp").isNull()).count() == 0
    df.createOrReplaceTempView("sensor")
    by_sql = spark.sql("SELECT * FROM sensor WHERE timestamp = TIMESTAMP '2014-03-10 01:01:00'")
    by_df = df.filter(F.col("timestamp") == F.to_timestamp(F.lit("2014-03-10 01:01:00")))
    expected = {"COHUTTA", "LAGNAPPE", "NANTAHALLA", "CHER", "THERMALITO", "ANDOUILLE", "BUTTE",
                "MOJO", "CARGO", "BBKING"}
    assert {r.sensorname for r in by_sql.collect()} == expected
    assert sorted(by_sql.collect()) == sorted(by_df.collect())
    cohutta = by_df.filter(F.col("sensorname") == "COHUTTA").first()
    assert (cohutta.numA, cohutta.numC, cohutta.numE) == (10.27, 881, 85)


def test_schema_from_headers(spark, workdir):
    path = workdir + "/headers.csv"
    with open(path, "w") as f:
        for c in GKG_COLUMNS:
            t = "TIMESTAMP" if c == "date" else ("INTEGER" if c == "sourceCollectionIdentifier" else "STRING")
            f.write(f"{c}\t{t}\tNULLABLE\t\n")
    assert schema_from_headers(spark, path) == GKG_SCHEMA
    # a file that calls the date column DATE still reads it as TIMESTAMP
    with open(path.replace(".csv", "_date.csv"), "w") as f:
        for c in GKG_COLUMNS:
            t = "DATE" if c == "date" else ("INTEGER" if c == "sourceCollectionIdentifier" else "STRING")
            f.write(f"{c}\t{t}\tNULLABLE\t\n")
    from mentionlab.sources.gkg import record_schema_from_headers
    assert record_schema_from_headers(spark, path.replace(".csv", "_date.csv")) == GKG_SCHEMA


# The column names as the archive's own schema file writes them, in file order.
HEADER_NAMES = """GKGRECORDID DATE SourceCollectionIdentifier SourceCommonName DocumentIdentifier Counts V2Counts
Themes V2Themes Locations V2Locations Persons V2Persons Organizations V2Organizations V2Tone Dates GCAM SharingImage
RelatedImages SocialImageEmbeds SocialVideoEmbeds Quotations AllNames Amounts TranslationInfo Extras""".split()


def test_schema_file_of_the_archive_loads(spark, workdir):
    from mentionlab.sources.gkg import record_schema_from_headers
    path = workdir + "/headers.csv"
    types = {"DATE": "DATE", "SourceCollectionIdentifier": "INTEGER"}
    with open(path, "w") as f:
        f.write("".join(f"{c}\t{types.get(c, 'STRING')}\tNULLABLE\t\n" for c in HEADER_NAMES))
    assert record_schema_from_headers(spark, path) == GKG_SCHEMA
    with open(path, "a") as f:
        f.write("More\tSTRING\tNULLABLE\t\n")
    with pytest.raises(ValueError):
        record_schema_from_headers(spark, path)


def test_text_path_keeps_the_day_of_a_short_date(spark, workdir):
    from mentionlab.operators.mentions import mentions_from_text
    src = write_lines(workdir + "/gkg", [gkg_row("r1", "20150218", "A,1"), gkg_row("r2", "2015021899", "B,1"),
                                         gkg_row("r3", "20150218230000", "C,1"), gkg_row("r4", "2015", "D,1")])
    got = {(r.topic, str(r.date)) for r in mentions_from_text(read_gkg_text(spark, src)).collect()}
    assert got == {("A", "2015-02-18"), ("B", "2015-02-18"), ("C", "2015-02-18")}


def test_manifest_first_n(spark, workdir):
    path = workdir + "/manifest.txt"
    with open(path, "w") as f:
        for i in range(5):
            f.write(f"100 abc http://data.example.org/v2/gkg/2015021823{i:02d}00.gkg.csv\n")
        f.write("not a segment line\n")
    m = read_manifest(spark, path, 3).collect()
    assert [r.segment_path for r in m] == [f"v2/gkg/2015021823{i:02d}00.gkg.csv" for i in range(3)]


def test_daily_documents_round_trip(spark, workdir):
    rows = [("2015-02-18", "A", 5), ("2015-02-18", "B", 7), ("2015-02-19", "A", 1)]
    counts = spark.createDataFrame(rows, "d STRING, topic STRING, count LONG").select(
        F.to_date("d").alias("date"), "topic", "count")
    from mentionlab.operators.topk import rank_topics
    top = rank_topics(counts).select("date", "topic", "count", "rank")
    path = write_daily_documents(top, workdir + "/daily")
    back = read_daily_json(spark, path)
    assert sorted((str(r.date), r.rank, r.topic, r["count"]) for r in back.collect()) == [
        ("2015-02-18", 1, "B", 7), ("2015-02-18", 2, "A", 5), ("2015-02-19", 1, "A", 1)]
    run = write_json_run(top, workdir + "/result", stamp=1)
    assert spark.read.json(run).count() == 3


def test_convert_to_parquet_prunes_days(spark, workdir):
    from mentionlab.sources.gkg import convert_to_parquet, read_gkg_parquet
    df = read_gkg_csv(spark, write_lines(workdir + "/gkg", EDGE_LINES))
    convert_to_parquet(df, workdir + "/pq")
    back = read_gkg_parquet(spark, workdir + "/pq")
    one_day = back.filter(F.col("day") == F.lit("2015-02-19").cast("date")).select("date", "allNames")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan
    assert sorted(r.record_id for r in mentions_from_gkg(back).collect()) == \
        sorted(r.record_id for r in mentions_from_gkg(df).collect())


def test_top_ten_rows_shape(spark):
    from mentionlab.operators.topk import rank_topics, top_ten_rows
    rows = [("2015-02-18", "A", 5), ("2015-02-18", "B", 7)]
    counts = spark.createDataFrame(rows, "d STRING, topic STRING, count LONG").select(
        F.to_date("d").alias("date"), "topic", "count")
    out = top_ten_rows(rank_topics(counts).select("date", "topic", "count", "rank"))
    assert out.schema.simpleString() == "struct<date:timestamp,topTenTopics:array<struct<_1:string,_2:int>>>"
    assert out.toJSON().first() == '{"date":"2015-02-18T00:00:00.000Z","topTenTopics":[{"_1":"B","_2":7},{"_1":"A","_2":5}]}'
