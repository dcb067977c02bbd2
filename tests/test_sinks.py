"""Sinks: full refresh, insert-overwrite into a kept table, append, comment."""

import datetime as dt
import os
import uuid

import pytest

from martcraft.operators import checks as K
from martcraft.operators import sinks as SK
from martcraft.plans import marts as M
from martcraft.plans.marts import MARTS
from martcraft.plans.run import COMMENTS, run_marts
from martcraft.rules import FIXTURE, PRODUCTION
from martcraft.session import shared_dir
from martcraft.sources import fixture_inputs
from tests.conftest import SF_SMALL


def test_overwrite_replaces(spark):
    path = shared_dir(spark, "tests", uuid.uuid4().hex)
    SK.write_overwrite(spark.range(5), path)
    SK.write_overwrite(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_insert_overwrite_keeps_table_and_orders_columns(spark):
    path = shared_dir(spark, "tests", uuid.uuid4().hex)
    table = "t_" + uuid.uuid4().hex[:10]
    df = spark.createDataFrame([(1, "a")], "n long, s string")
    SK.create_table(spark, table, df, path)
    # columns arrive in another order: the explicit select restores position
    SK.insert_overwrite(df.select("s", "n"), table, ["n", "s"])
    SK.insert_overwrite(df.select("s", "n"), table, ["n", "s"])
    assert [tuple(r) for r in spark.table(table).collect()] == [(1, "a")]
    SK.comment_on_table(spark, table, "Kit sales — it's a mart")
    desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    assert desc.get("Comment") == "Kit sales — it's a mart"


def test_check_rows_append(spark):
    path = shared_dir(spark, "tests", uuid.uuid4().hex)
    mart = spark.createDataFrame([(dt.date(2021, 5, 1), 5712)], "month date, sold_qty long")
    for _ in range(2):
        SK.append(K.check_target(mart, "kit_sales_v2", 2021, 5712), path, K.CHECK_COLUMNS)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 2 and all(r["check_result"] for r in rows)
    assert rows[0]["check_name"] == "comparison_with_target: 5712=5712"


@pytest.mark.parametrize("version", ["v2", "v1", "interim"])
def test_run_marts_writes_tables_and_check(spark, version):
    inp = fixture_inputs(spark, SF_SMALL)
    database = "db_" + uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE {database}")
    out = shared_dir(spark, "tests", uuid.uuid4().hex)
    before = folders(shared_dir(spark, "stage"))
    for _ in range(2):  # a second run replaces the marts and adds a check row
        run = run_marts(spark, inp, FIXTURE, out, version, database=database)
    assert folders(shared_dir(spark, "stage")) <= before | {x for x in folders(shared_dir(spark, "stage")) if x.startswith("session-")}
    for name, build in MARTS[version].items():
        written, built = spark.table(run.tables[name]), build(inp, FIXTURE)
        assert written.columns == built.columns
        assert written.count() == built.count()
        desc = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {run.tables[name]}").collect()}
        assert desc["Comment"] == COMMENTS[name]
    kit = spark.table(run.tables["kit_sales"])
    total = kit.where("year(month) = 1997").groupBy().sum("sold_qty").collect()[0][0]
    rows = spark.table(run.tables["stage_checks"]).collect()
    assert len(rows) == 2
    assert {r["table_name"] for r in rows} == {f"kit_sales_{version}"}
    assert {r["check_name"] for r in rows} == {f"comparison_with_target: {FIXTURE.check_target}={total}"}
    if version == "v2":
        months = M.kit_union_v2(inp, FIXTURE).select("month").collect()
        first, last = FIXTURE.calendar_start, FIXTURE.as_of
        off = sum(not (r.month.day == 1 and first <= r.month.date() <= last) if hasattr(r.month, "date")
                  else not (r.month.day == 1 and first <= r.month <= last) for r in months)
        assert run.off_calendar_rows["kit_sales"] == off > 0
        assert run.off_calendar_rows["retail_sales"] > 0
        assert {f.dataType.simpleString() for t in run.tables.values() for f in spark.table(t).schema.fields if f.name == "month"} == {"date"}
    spark.sql(f"DROP DATABASE {database} CASCADE")


def folders(path):
    return set(os.listdir(path)) if os.path.isdir(path) else set()


def test_as_of_is_resolved_once(spark, monkeypatch):
    seen = []
    monkeypatch.setitem(MARTS, "v1", {"kit_sales": lambda inp, rules: seen.append(rules.as_of) or spark.createDataFrame(
        [(dt.date(2021, 1, 1), 1)], "month date, sold_qty long")})
    out = shared_dir(spark, "tests", uuid.uuid4().hex)
    database = "db_" + uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE {database}")
    run = run_marts(spark, None, PRODUCTION, out, "v1", database=database)
    assert seen == [run.as_of] and run.as_of is not None
    spark.sql(f"DROP DATABASE {database} CASCADE")
