"""Published versions, the durable check log, runs that are repeated."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from martcraft.operators import checks as K
from martcraft.operators import publish as P
from martcraft.operators import sinks as SK
from martcraft.plans import run as R
from martcraft.plans.marts import MARTS
from martcraft.rules import FIXTURE, PRODUCTION
from martcraft.session import shared_dir

MONTH = "month date, sold_qty long"


@pytest.fixture
def place(spark):
    return shared_dir(spark, "tests", uuid.uuid4().hex), "t_" + uuid.uuid4().hex[:10]


def failing(spark):
    return spark.range(100).repartition(4).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("n"))


def test_failed_write_leaves_the_old_rows(spark, place):
    path, table = place
    SK.replace_table(spark, table, spark.range(5).toDF("n"), path)
    with pytest.raises(Exception, match="lost"):
        SK.replace_table(spark, table, failing(spark), path)
    assert spark.table(table).count() == 5
    with pytest.raises(Exception, match="lost"):
        SK.insert_overwrite(failing(spark), table, ["n"])
    assert spark.table(table).count() == 5 and len(os.listdir(path)) == 1


def test_rejected_rows_are_not_published(spark, place):
    path, table = place
    SK.replace_table(spark, table, spark.range(5).toDF("n"), path)

    def reject(rows):
        assert rows.count() == 3
        raise ValueError("too few")

    with pytest.raises(ValueError, match="too few"):
        SK.replace_table(spark, table, spark.range(3).toDF("n"), path, check=reject)
    assert spark.table(table).count() == 5 and P.published(spark, path).number == 1


def test_versions_kept_rolled_back_and_adopted(spark, place):
    path, table = place
    for n in (1, 2, 3):
        old = spark.table(table) if n > 1 else None
        SK.replace_table(spark, table, spark.range(n).toDF("n"), path, info=lambda n=n: {"rows": n})
        if old is not None:
            assert old.count() == n - 1  # planned on the version before
    assert [(v.number, v.info) for v in P.versions(spark, path)] == [(2, {"rows": 2}), (3, {"rows": 3})]
    spark.sql(f"DROP TABLE {table}")  # a fresh catalog
    assert P.adopt(spark, table, path) and spark.table(table).count() == 3
    assert P.read_published(spark, path).count() == 3
    P.roll_back(spark, table, path)
    assert spark.table(table).count() == 2 and P.published(spark, path).number == 2
    with pytest.raises(ValueError):
        P.roll_back(spark, table, path)
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, path + "-none")


def test_new_columns_and_an_unfinished_folder(spark, place):
    path, table = place
    SK.replace_table(spark, table, spark.range(2).toDF("n"), path)
    spark.range(9).write.parquet(f"{path}/v00000002-lost")  # a driver that died before the mark
    SK.replace_table(spark, table, spark.range(3).select(F.col("id").alias("n"), F.lit("x").alias("s")), path)
    assert spark.table(table).columns == ["n", "s"] and spark.table(table).count() == 3
    assert sorted(x[:9] for x in os.listdir(path)) == ["v00000001", "v00000003"]


def test_insert_overwrite_by_position_and_type(spark, place):
    path, table = place
    SK.create_table(spark, table, spark.createDataFrame([], "a long, b string"), path)
    SK.insert_overwrite(spark.sql("SELECT 'x' AS q, 7 AS p"), table, ["p", "q"])
    assert [tuple(r) for r in spark.table(table).collect()] == [(7, "x")]
    assert dict(spark.table(table).dtypes) == {"a": "bigint", "b": "string"}
    assert P.base_path(spark, table).endswith(path)
    with pytest.raises(ValueError):
        SK.insert_overwrite(spark.range(1), table, ["id"])


def check_row(spark, target=5712):
    mart = spark.createDataFrame([(dt.date(2021, 5, 1), 5712)], MONTH)
    return K.check_target(mart, "kit_sales_v2", 2021, target)


def test_log_survives_new_catalogs_and_repeats(spark, place):
    path, table = place
    added = []
    for day in ("mon", "tue", "tue", "wed"):
        row = check_row(spark)
        SK.create_table(spark, table, row.withColumn("run_id", F.lit("")), path)
        added.append(SK.append_once(row, table, K.CHECK_COLUMNS, day))
        spark.sql(f"DROP TABLE {table}")
    assert added == [True, True, False, True]
    assert sorted(r.run_id for r in spark.read.parquet(path).collect()) == ["mon", "tue", "wed"]


def test_log_written_before_run_ids_is_adopted(spark, place):
    path, table = place
    SK.append(check_row(spark), path, K.CHECK_COLUMNS)
    row = check_row(spark, 1)
    SK.create_table(spark, table, row.withColumn("run_id", F.lit("")), path)
    SK.append_once(row, table, K.CHECK_COLUMNS, "r")
    assert sorted((r.run_id or "", r.check_result) for r in spark.table(table).collect()) == [("", True), ("r", False)]
    known = "k_" + uuid.uuid4().hex[:8]  # a catalog that knows the older table
    spark.catalog.createTable(known, path=path + "-old", source="parquet", schema=row.schema)
    SK.create_table(spark, known, row.withColumn("run_id", F.lit("")), path + "-old")
    assert SK.append_once(row, known, K.CHECK_COLUMNS, "r") and not SK.append_once(row, known, K.CHECK_COLUMNS, "r")
    spark.range(3).write.parquet(path + "-other")
    with pytest.raises(ValueError, match="other columns"):
        SK.create_table(spark, "o_" + uuid.uuid4().hex[:8], row, path + "-other")


@pytest.fixture
def database(spark):
    name = "db_" + uuid.uuid4().hex[:10]
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def marts_of(monkeypatch, spark, built, broken=(), total=5712):
    def build(name):
        def run(inputs, rules, **shared):
            if name in broken:
                raise RuntimeError(f"{name} is down")
            built.append((name, rules.as_of))
            return spark.createDataFrame([(dt.date(2021, 1, 1), total)], MONTH)
        return run
    monkeypatch.setitem(MARTS, "interim", {n: build(n) for n in ("kit_sales", "retail_sales", "balance")})


def test_repeated_run_goes_on_where_it_failed(spark, place, database, monkeypatch):
    path, _ = place
    built, go = [], lambda: R.run_marts(spark, None, PRODUCTION, path, "interim", database=database, run_id="day-1")
    marts_of(monkeypatch, spark, built, broken=("balance",))
    monkeypatch.setattr(R, "_today", lambda spark: dt.date(2024, 2, 29))
    with pytest.raises(RuntimeError, match="balance is down"):
        go()
    spark.sql(f"DROP TABLE {database}.kit_sales_interim")  # the next try has a fresh catalog
    marts_of(monkeypatch, spark, built)
    monkeypatch.setattr(R, "_today", lambda spark: dt.date(2024, 3, 1))
    run = go()
    assert run.resumed == ["kit_sales", "retail_sales"] and run.as_of == dt.date(2024, 2, 29)
    assert [n for n, _ in built] == ["kit_sales", "retail_sales", "balance"] and {d for _, d in built} == {run.as_of}
    assert all(spark.table(t).count() == 1 for t in run.tables.values())
    assert go().resumed == ["kit_sales", "retail_sales", "balance"] and spark.table(run.tables["stage_checks"]).count() == 1


def test_gate_keeps_the_mart_before(spark, place, database, monkeypatch):
    path, _ = place
    rules, built = FIXTURE.with_(check_year=2021, check_target=5712), []
    go = lambda **k: R.run_marts(spark, None, rules, path, "interim", database=database, gate=True, **k)
    marts_of(monkeypatch, spark, built)
    run = go()
    marts_of(monkeypatch, spark, built, total=1)
    for _ in range(2):
        with pytest.raises(R.CheckFailed):
            go(run_id="bad")
    assert spark.table(run.tables["kit_sales"]).first().sold_qty == 5712
    assert sorted(r.check_result for r in spark.table(run.tables["stage_checks"]).collect()) == [False, True]
