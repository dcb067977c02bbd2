"""Hot keys in the raw match joins, semi-join reduction, data skipping."""

import datetime as dt
import uuid

import pyarrow.dataset as ds
import pytest
from pyspark.sql import functions as F

from martcraft.operators import dedupe as D
from martcraft.operators import match as MT
from martcraft.operators import rollup as RU
from martcraft.operators import sinks as SK
from martcraft.operators.hotjoin import HotRules
from martcraft.rules import FIXTURE
from martcraft.session import shared_dir
from martcraft.sources import fixture_inputs
from tests.conftest import SF_SMALL
from tests.helpers import bag

HOT = HotRules(share=0.01, least=20)


@pytest.fixture(scope="module")
def skewed(spark):
    """The fixture's lines, every second one moved to one key, and as many
    without a drawing."""
    inp = fixture_inputs(spark, SF_SMALL)
    k = inp.kit_sales
    hot = k.where("drawing_no IS NOT NULL").select("counterparty", "drawing_no").orderBy("counterparty", "drawing_no").first()
    h = F.xxhash64("month", "drawing_no", "sold_qty", "sales_direction") % 4
    lines = k.withColumn("counterparty", F.when(h.isin(0, 2, -2), F.lit(hot[0])).otherwise(F.col("counterparty"))).withColumn(
        "drawing_no", F.when(h.isin(0, 2, -2), F.lit(hot[1])).when(h == 1, F.lit(None)).otherwise(F.col("drawing_no")))
    path = shared_dir(spark, "tests", uuid.uuid4().hex)
    lines.write.parquet(path)
    return inp, spark.read.parquet(path)


def matches(inp, lines, hot):
    nom = D.dedupe_guide_by_model(inp.guide, FIXTURE.guide_divisions)
    return {"guide": MT.match_guide(lines, nom, FIXTURE, hot=hot), "primary": MT.match_primary(lines, nom, FIXTURE, hot=hot),
            "v1": MT.match_v1(lines, inp.guide, FIXTURE, hot=hot)}


def test_salted_matches_equal_plain_ones(spark, skewed):
    inp, lines = skewed
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, salted = matches(inp, lines, HotRules()), matches(inp, lines, HOT)
        for name in plain:
            assert plain[name].columns == salted[name].columns
            assert bag([tuple(r) for r in plain[name].collect()], plain[name].columns) == bag(
                [tuple(r) for r in salted[name].collect()], salted[name].columns), name
            plan = salted[name]._jdf.queryExecution().executedPlan().toString()
            assert "_salt" in plan and "_salt" not in plain[name]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_rows_are_dealt_over_tasks(spark, skewed):
    inp, lines = skewed
    for k, v in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.shuffle.partitions", "16")):
        spark.conf.set(k, v)
    try:
        share = {}
        for name, hot in (("plain", HotRules()), ("salted", HOT)):
            tasks = matches(inp, lines, hot)["v1"].groupBy(F.spark_partition_id()).count().collect()
            share[name] = max(r[1] for r in tasks) / sum(r[1] for r in tasks)
        assert share["plain"] > 0.4 and share["salted"] < 0.2, share
    finally:
        for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions"):
            spark.conf.unset(k)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_patch_sums_wanted_lines_only(spark):
    inp = fixture_inputs(spark, SF_SMALL)
    div = {r.id for r in inp.division.collect() if r.name == FIXTURE.patch_division}
    products = {r.id for r in inp.product.collect() if r.division_id in div}
    kept = RU.matching_lines(inp.realization, {"product_id": spark.createDataFrame([(p,) for p in products] + [(None,)], "id long")})
    want = sum(r.product_id in products for r in inp.realization.collect())
    assert kept.count() == want and 0 < want < inp.realization.count() / 2
    plan = RU.realization_patch(inp.realization, inp.product, inp.direction, inp.division, FIXTURE)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "l_shipdate" in x)
    above = [x for x in lines[:scan] if len(x) - len(x.lstrip(" :+-*()0123456789")) < 200]
    semi = max(i for i, x in enumerate(above) if "LeftSemi" in x)
    exchange = max(i for i, x in enumerate(above) if "Exchange hashpartitioning(period" in x)
    assert exchange < semi < scan  # the rows are cut below the aggregate's shuffle
    many = RU.matching_lines(inp.realization, {"product_id": inp.product.select("id")}, most=3)
    assert "LeftSemi" not in many._jdf.queryExecution().executedPlan().toString()


def test_a_year_is_found_by_statistics(spark):
    path, table = shared_dir(spark, "tests", uuid.uuid4().hex), "t_" + uuid.uuid4().hex[:10]
    months = spark.range(200_000).select(F.add_months(F.lit(dt.date(2016, 1, 1)), (F.xxhash64("id") % 60 + 60).cast("int") % 96).alias("month"),
                                         F.xxhash64(F.col("id") + 1).alias("sold_qty"))
    spark.conf.set("parquet.block.size", str(1 << 18))
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(1 << 18))
    try:
        version = SK.replace_table(spark, table, months.repartition(2), path, sort_by=["month"])
    finally:
        spark.conf.unset("parquet.block.size")
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    groups = [g for f in ds.dataset(version.path, exclude_invalid_files=True).get_fragments() for g in f.row_groups]
    year = [g for g in groups if g.statistics["month"]["min"] <= dt.date(2021, 12, 31) and g.statistics["month"]["max"] >= dt.date(2021, 1, 1)]
    assert len(groups) >= 8 and len(year) <= len(groups) / 2
    plan = spark.table(table).where("month >= DATE'2021-01-01' AND month < DATE'2022-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(month,2021-01-01)" in plan
