"""Every registered query against its DuckDB oracle (bag equality) on the
smallest supplied tables, plus the driver contract."""

import pytest

from tests.conftest import SF_SMALL
from tests.helpers import bag

import __spark_entry__ as E
from martcraft.plans.registry import queries

KEYS = sorted(queries())


def test_every_query_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(df.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert bag(s_rows, df.columns) == bag(d_rows, d_cols)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "division", "internal_code", "code65", "assembly_variant",
                          "sales_direction", "sold_qty", "cumulative_qty", "product_type"]
    assert df.count() > 0
