"""Steps that hold or read more than they need when the input grows: plans and
results on rows built here."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from martcraft.operators import incremental as I
from martcraft.operators import rollup as RU
from martcraft.plans import incremental as PI
from martcraft.plans import marts as M
from martcraft.plans import registry as R
from martcraft.rules import FIXTURE
from martcraft.session import shared_dir
from martcraft.sources import fixture_inputs
from tests.conftest import SF_SMALL
from tests.helpers import spark_bag


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_dealer_marts_sum_once(spark):
    """No sums by dealer, which are as many as the lines where dealers are."""
    inp = fixture_inputs(spark, SF_SMALL)
    for mart in (M.retail_sales_interim, M.balance_interim):
        groups = [line for line in plan_of(mart(inp, FIXTURE)).splitlines() if "Aggregate [" in line]
        assert groups and not any("dealer_id" in line for line in groups)


def test_dealer_division_keeps_lines_and_repeats_for_repeated_dealers(spark):
    lines = spark.createDataFrame([(1, "own", 5), (2, "own", 6), (None, "own", 7), (3, None, 8)], "dealer_id long, division string, qty long")
    dealer = spark.createDataFrame([(1, "N"), (1, "S"), (2, None), (None, "X")], "id long, division string")
    got = RU.dealer_division(lines, dealer).select("dealer_id", "division", "qty")
    assert spark_bag(got) == spark_bag(spark.createDataFrame(
        [(1, "N", 5), (1, "S", 5), (2, None, 6), (None, None, 7), (3, None, 8)], "dealer_id long, division string, qty long"))


def test_kept_base_reads_the_lines_once(spark, monkeypatch):
    inp = fixture_inputs(spark, SF_SMALL)
    path, seen = shared_dir(spark, "tests", uuid.uuid4().hex), spark.sparkContext.accumulator(0)
    touch = F.udf(lambda x: (seen.add(1), x)[1], "long").asNondeterministic()
    lines = inp.retail.limit(500).select("period", "division", "internal_code", "assembly_variant", "sales_direction", "vin", "dealer_id",
                                         touch("retail_qty").alias("retail_qty"), "opening_stock", "closing_stock")
    base, done = PI.retail_base_kept(type(inp)(**{**vars(inp), "retail": lines}), FIXTURE, path)
    assert len(done.changed) == base.select("month").distinct().count() > 1
    assert seen.value == 500


def test_summed_prints_equal_row_prints(spark):
    rows = spark.createDataFrame([(dt.date(2020, 1, 5), "a", 1), (dt.date(2020, 1, 7), None, 1), (None, "a", None), (dt.date(2020, 2, 1), "a", 1)],
                                 "day date, unit string, qty long")
    by_unit = rows.groupBy(F.trunc("day", "MM").alias("month"), "unit").agg(*I.print_sums(rows.columns))
    assert spark_bag(I.summed_prints(by_unit)) == spark_bag(I.row_fingerprints(rows, F.trunc("day", "MM")))


def test_insert_overwrite_builds_the_mart_once(spark, monkeypatch):
    read, insert = [], R.SK.insert_overwrite

    def noted(df, *args, **kw):
        read.extend(df.inputFiles())
        return insert(df, *args, **kw)

    monkeypatch.setattr(R.SK, "insert_overwrite", noted)
    assert R.queries()["sink_insert_overwrite_roundtrip"](spark, SF_SMALL).count() > 0
    assert read and not any("lineitem" in f for f in read)
