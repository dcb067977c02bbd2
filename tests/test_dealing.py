"""Large joins of the lines: as many tasks as rows ask for, same rows."""

import re

from martcraft.operators import rollup as RU
from martcraft.rules import FIXTURE
from martcraft.sources import dealing, fixture_inputs
from tests.conftest import SF_SMALL
from tests.helpers import spark_bag


def line_tasks(df):
    return {(k, int(n)) for k, n in re.findall(r"hashpartitioning\((l_\w+)#\d+L?, (\d+)\), REPARTITION_BY_NUM",
                                               df._jdf.queryExecution().executedPlan().toString())}


def test_tasks_grow_with_the_lines(spark, monkeypatch):
    plain = fixture_inputs(spark, SF_SMALL)
    assert not line_tasks(plain.kit_sales) and not line_tasks(plain.retail)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    monkeypatch.setattr(dealing, "ROWS_A_TASK", lines // 20)
    monkeypatch.setattr(dealing, "SMALL", lines // 2)
    monkeypatch.setattr(dealing, "FEW", 10)
    dealt = fixture_inputs(spark, SF_SMALL)
    tasks = -(-lines // (lines // 20))
    for name in ("kit_sales", "retail"):
        assert line_tasks(getattr(dealt, name)) == {("l_orderkey", tasks), ("l_partkey", tasks)}, name
        assert spark_bag(getattr(dealt, name)) == spark_bag(getattr(plain, name)), name
    assert spark_bag(dealt.realization) == spark_bag(plain.realization)
    assert spark_bag(RU.kit_rollup_v1(dealt.kit_sales, dealt.guide, FIXTURE)) == spark_bag(RU.kit_rollup_v1(plain.kit_sales, plain.guide, FIXTURE))


def test_null_and_repeated_keys_join_as_before(spark):
    lines = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (4, "d")], "k long, v string")
    other = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (None, "z"), (5, "w")], "id long, w string")
    want = spark_bag(lines.join(other, lines.k == other.id))
    got = dealing.dealt_join(lines, other, "k", "id", dealing.SMALL + 1)
    assert got.columns == ["k", "v", "id", "w"] and spark_bag(got) == want
    assert spark_bag(dealing.dealt_join(lines, other, "k", "id", dealing.SMALL)) == want
