"""Invariants of the marts on the supplied tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from martcraft.operators import checks as K
from martcraft.operators import rollup as RU
from martcraft.plans import marts as M
from martcraft.rules import FIXTURE as R
from martcraft.sources import fixture_inputs
from tests.conftest import SF_SMALL

UNIT = list(RU.KIT_UNIT)


def _eq_null_safe_join(a, b, cols):
    cond = None
    for c in cols:
        e = a[c].eqNullSafe(b["_b_" + c])
        cond = e if cond is None else cond & e
    return cond


def test_last_running_total_equals_in_calendar_sum(spark):
    inp = fixture_inputs(spark, SF_SMALL)
    mart = M.kit_sales_v2(inp, R)
    w = Window.partitionBy(*UNIT).orderBy(F.col("month").desc())
    last = (mart.withColumn("_r", F.row_number().over(w)).where("_r = 1")
            .select(*UNIT, "cumulative_qty"))
    u = M.kit_union_v2(inp, R)
    in_cal = ((F.col("month") >= F.lit(R.calendar_start)) & (F.col("month") <= F.lit(R.as_of))
              & (F.col("month") == F.trunc("month", "MM")))
    sums = (u.where(in_cal).groupBy(*UNIT).agg(F.sum("sold_qty").alias("total"))
            .where(F.col("total").isNotNull())
            .select(*[F.col(c).alias("_b_" + c) for c in UNIT], "total"))
    j = last.join(sums, _eq_null_safe_join(last, sums, UNIT), "full")
    bad = j.where(~F.col("cumulative_qty").eqNullSafe(F.col("total")))
    assert last.count() == sums.count() > 0
    assert bad.count() == 0


def test_every_unit_series_is_dense_to_the_last_month(spark):
    inp = fixture_inputs(spark, SF_SMALL)
    mart = M.retail_sales_v2(inp, R)
    per_unit = mart.groupBy(*M.RETAIL_UNIT, "product_type").agg(
        F.min("month").alias("lo"), F.max("month").alias("hi"),
        F.countDistinct("month").alias("n"))
    gaps = per_unit.where(
        (F.col("hi") != F.lit("2001-12-01").cast("date"))
        | (F.months_between("hi", "lo") + 1 != F.col("n")))
    assert per_unit.count() > 0 and gaps.count() == 0


def test_marts_reconcile_with_sources(spark):
    inp = fixture_inputs(spark, SF_SMALL)
    for year in (1997, 1999):
        r = K.reconcile(M.balance_v2(inp, R), "closing_stock", "month",
                        inp.retail, "closing_stock", "period", year).collect()[0]
        assert r["equal"] and r["difference"] == 0
        r = K.reconcile(M.retail_sales_v2(inp, R), "retail_qty", "month",
                        inp.retail, "retail_qty", "period", year).collect()[0]
        assert r["equal"] and r["left_total"] > 0
