"""The v1 match where few lines have many guide rows each: work goes by the
rows that come out."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martcraft.operators import match as MT
from martcraft.operators.hotjoin import HotRules
from martcraft.rules import FIXTURE

MATCHED = ("m_division", "m_internal_code", "m_code65")
LINES = "month date, division string, counterparty string, drawing_no string, assembly_variant string, sales_direction string, sold_qty bigint"
GUIDE = "guide_id bigint, name string, code65 string, factory_model string, manufacturer string, division string"
BY_LINES = HotRules(share=0.01, least=500, block=7)  # no key has 500 lines


@pytest.fixture(scope="module")
def tables(spark):
    day = dt.date(2020, 1, 1)
    lines = [(day, None, "x", "M-1", f"v{i}", "d", i) for i in range(400)]
    lines += [(day, "ASIA", "x", f"other-{i}", "v", "d", i) for i in range(1500)]
    lines += [(day, None, "x", None, "v", "d", i) for i in range(5)] + [(day, None, "x", "A1-00Z", "v", "d", 1)]
    # equal rows, told apart by their ids only; each agrees by the model and by the code, and counts once
    guide = [(i, f"part {i % 3}", "M-1", "M-1", "brand #7", "LCV") for i in range(60)]
    guide += [(100, None, "M-1", "M-1", "Brand#7", "LCV"), (101, "red widget", "M-1", "M-1", "Brand#7", "LCV"), (102, "n", "M-1", "M-1", "Brand#8", "LCV"),
              (103, "n", "А1-Z", "", "Brand#7", None), (104, "n", None, None, "Brand#7", "BUS")]
    return spark.createDataFrame(lines, LINES).repartition(8, "sold_qty").localCheckpoint(), spark.createDataFrame(guide, GUIDE).localCheckpoint()


def expected():
    return Counter({("M-1", "LCV", f"part {k}", "M-1"): 400 * 20 for k in range(3)} | {(f"other-{i}", None, None, None): 1 for i in range(1500)} | {
        (None, None, None, None): 5, ("A1-00Z", None, "n", "А1-Z"): 1})


@pytest.fixture
def shuffled(spark):
    for k, v in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.shuffle.partitions", "16")):
        spark.conf.set(k, v)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_rows_that_come_out_are_dealt_over_tasks(spark, tables, shuffled):
    found = MT.match_v1(*tables, FIXTURE, hot=BY_LINES)
    assert Counter(tuple(r) for r in found.select("drawing_no", *MATCHED).collect()) == expected()
    tasks = [r[1] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) / sum(tasks) < 0.25, tasks


def test_few_matches_reach_the_lines_where_they_are(spark, tables):
    found = MT.match_v1(*tables, FIXTURE)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(drawing_no" not in plan and "SortMergeJoin" not in plan
    assert Counter(tuple(r) for r in found.select("drawing_no", *MATCHED).collect()) == expected()
    assert found.columns == [*tables[0].columns, *MATCHED]


@pytest.mark.parametrize("few", [1561, 1562])
def test_more_matches_are_not_broadcast(spark, tables, few):
    # 60 guide rows of M-1, one of A1-00Z, 1500 other drawings, NULL
    found = MT.match_v1(*tables, FIXTURE, hot=HotRules(share=0.01, least=500, few=few))
    assert ("_salt" in found._jdf.queryExecution().executedPlan().toString()) == (few < 1562)
    assert Counter(tuple(r) for r in found.select("drawing_no", *MATCHED).collect()) == expected()


def test_no_matches_and_no_lines(spark, tables):
    lines, guide = tables
    none = MT.match_v1(lines, guide.where("false"), FIXTURE)
    assert none.count() == lines.count() and none.where("m_internal_code IS NOT NULL").count() == 0
    assert MT.match_v1(lines.where("false"), guide, FIXTURE).count() == 0
