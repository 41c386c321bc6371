"""Properties: name rules against a plain statement of them; counting and ranking invariants."""

import datetime as dt
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mentionlab.operators.mentions import mentions_from_records
from mentionlab.operators.topk import daily_topk, mention_counts

ITEM = st.one_of(
    st.tuples(st.text(alphabet="ABab ,'é-\"", max_size=8), st.integers(0, 999)).map(lambda t: f"{t[0]},{t[1]}"),
    st.text(alphabet="ABab ,;0123456789", max_size=10),
)
FIELD = st.lists(ITEM, max_size=6).map(";".join)
RECORDS = st.lists(st.tuples(FIELD, st.integers(0, 3)), min_size=1, max_size=12)


def rule(item: str, name: str) -> str:
    if name == "last_offset":
        return re.sub(r",[0-9]+$", "", item)
    if name == "all_offsets":
        return re.sub(r",[0-9]+", "", item)
    return item.split(",")[0]


def expected(records, name):
    out = Counter()
    for i, (field, _) in enumerate(records):
        if not field:
            continue
        for item in field.split(";"):
            if item and rule(item, name):
                out[(str(i), rule(item, name))] += 1
    return out


def frame(spark, records):
    rows = [(str(i), dt.datetime(2015, 2, 18 + day, 12), field) for i, (field, day) in enumerate(records)]
    return spark.createDataFrame(rows, "record_id STRING, ts TIMESTAMP, all_names STRING")


@settings(max_examples=15, deadline=None)
@given(RECORDS)
def test_name_rules_match_their_statement(spark, records):
    df = frame(spark, records)
    for name in ("last_offset", "all_offsets", "head"):
        got = Counter((r.record_id, r.topic) for r in mentions_from_records(df, name).collect())
        assert got == expected(records, name), name


@settings(max_examples=10, deadline=None)
@given(RECORDS)
def test_counting_and_ranking_invariants(spark, records):
    m = mentions_from_records(frame(spark, records))
    counts = mention_counts(m)
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    assert total == m.count()
    assert counts.filter(F.col("count") < 1).count() == 0
    a = sorted(map(tuple, daily_topk(m, 3).collect()))
    b = sorted(map(tuple, daily_topk(m.repartition(5), 3).collect()))
    assert a == b
    assert all(r[3] <= 3 for r in a)


EVENTS = st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "x", "y"]),
                            st.integers(-7200, 4 * 3600)), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None)
@given(EVENTS, st.sampled_from([600, 3600, 5400]))
def test_trailing_counts_match_brute_force(spark, events, width_s):
    from mentionlab.operators.histogram import trailing_counts
    df = spark.createDataFrame([(i, k, s) for i, (k, s) in enumerate(events)], "id LONG, k STRING, s LONG") \
        .withColumn("ts", F.col("s").cast("timestamp"))
    got = {r.id: r["count"] for r in trailing_counts(df, "k", "ts", "id", width_s * 1_000_000,
                                                     bucket_us=300_000_000).collect()}
    assert got == {i: sum(k2 == k and s - width_s < s2 <= s for k2, s2 in events) for i, (k, s) in enumerate(events)}


GROUPED = st.lists(st.tuples(st.sampled_from(["g", "g", "h", None]), st.integers(0, 20)), min_size=1, max_size=50)


@settings(max_examples=8, deadline=None)
@given(GROUPED)
def test_numbering_matches_brute_force(spark, rows):
    from mentionlab.plans.ranking import number_rows
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id LONG, g STRING, v INT")
    order = [F.col("v").desc(), F.col("id")]
    numbered = number_rows(df, ["g"], order, size_col="n").collect()
    expected = {}
    for i, (g, v) in sorted(enumerate(rows), key=lambda t: (str(t[1][0]), -t[1][1], t[0])):
        expected[i] = sum(1 for j, (g2, v2) in enumerate(rows) if g2 == g and (-v2, j) < (-v, i))
    assert {r.id: r.pos for r in numbered} == expected
    assert all(r.n == sum(g == r.g for g, _ in rows) for r in numbered)
