"""Plan guards over the whole catalogue: no cross products, no row-at-a-time Python UDFs."""

import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_plan_has_no_cross_product_or_row_udf(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], plan


def test_flagship_plan_prunes_and_limits(spark):
    from mentionlab.operators.mentions import mentions_from_gkg
    from mentionlab.operators.topk import daily_topk
    from mentionlab.plans import derived as D
    path = tempfile.mkdtemp(prefix="mentionlab-plan-") + "/records"
    D.gkg_records(D.articles(D.table(spark, SF, "events"))).withColumn("extra", F.lit("x")).write.parquet(path)
    top = daily_topk(mentions_from_gkg(spark.read.parquet(path)))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert "extra" not in plan.split("ReadSchema")[1].split("\n")[0]  # unused column not read
