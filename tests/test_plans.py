"""Physical-plan properties that matter at scale."""

import datetime as dt
import re

from martcraft.operators import calendar as C
from martcraft.operators import dedupe as D
from martcraft.operators import match as MT
from martcraft.operators import rollup as RU
from martcraft.plans import marts as M
from martcraft.plans.registry import queries
from martcraft.rules import FIXTURE
from martcraft.session import materialize
from martcraft.sources.fixtures import fixture_inputs
from tests.conftest import SF_SMALL

NESTED = ("BroadcastNestedLoopJoin", "CartesianProduct")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def joins(p: str) -> int:
    return len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", p.split("Initial Plan")[-1]))


def test_matching_has_no_nested_loop_or_cartesian(spark):
    """On the plans that hold the joins, not on a scan of their stage table."""
    qs = queries()
    inp = fixture_inputs(spark, SF_SMALL)
    plans = {name: plan(qs[name](spark, SF_SMALL)) for name in (
        "match_primary", "match_with_fallback", "match_v1", "kit_rollup", "kit_rollup_v1", "nullsafe_multikey_join")}
    plans["kit_union_v2"] = plan(M.kit_union_v2(inp, FIXTURE))
    plans["retail_rollup"] = plan(M.retail_rollup(inp, FIXTURE))
    for name, p in plans.items():
        assert joins(p), name
        assert not any(n in p for n in NESTED), name
    assert not any(n in plan(qs["month_unit_grid"](spark, SF_SMALL)) for n in NESTED)


def test_match_reads_the_fact_once_and_joins_it_once(spark):
    qs = queries()
    for name in ("match_primary", "match_with_fallback", "match_v1"):
        df = qs[name](spark, SF_SMALL)
        assert plan(df).count("l_quantity") and len(re.findall(r"FileScan parquet \[l_orderkey", plan(df))) == 1, name
    nom = D.dedupe_guide_by_model(fixture_inputs(spark, SF_SMALL).guide, FIXTURE.guide_divisions)
    facts = materialize(fixture_inputs(spark, SF_SMALL).kit_sales)
    optimized = MT.match_guide(facts, nom, FIXTURE, keys_materialized=False)._jdf.queryExecution().optimizedPlan().toString()
    # the scan of the facts is below one join only: its own
    depth = [len(x) - len(x.lstrip(" :+-")) for x in optimized.splitlines()]
    lines = optimized.splitlines()
    at = next(i for i, x in enumerate(lines) if "sold_qty" in x and "Relation" in x)
    above = {min(depth[i:at]) for i in range(at) if "Join" in lines[i] and depth[i] < min(depth[i + 1:at + 1])}
    assert len(above) == 1


def test_union_is_staged_once_for_the_grid(spark):
    p = plan(queries()["nullsafe_multikey_join"](spark, SF_SMALL))
    assert "l_orderkey" not in p


def test_densify_uses_a_single_exchange(spark):
    inp = fixture_inputs(spark, SF_SMALL)
    u = M.kit_union_v2(inp, FIXTURE)
    base = plan(u).count("Exchange hashpartitioning")
    d = C.densify_cumulative(u, RU.KIT_UNIT, RU.KIT_UNIT, "sold_qty", FIXTURE.calendar_start,
                             FIXTURE.as_of)
    p = plan(d)
    assert p.count("Exchange hashpartitioning") == base + 1
    assert "Generate" in p and "Window" in p


def test_month_filters_reach_the_scan(spark):
    """The five months are pushed into the scan of the realization fact."""
    qs = queries()
    for name in ("filter_patch_months", "realization_patch"):
        p = plan(qs[name](spark, SF_SMALL))
        scan = next(x for x in p.splitlines() if "FileScan" in x and "l_shipdate" in x)
        pushed = scan[scan.index("PushedFilters"):]
        assert pushed.count("GreaterThanOrEqual(l_shipdate") >= 1 and "Or(" in pushed, name


def test_check_year_filter_is_a_range(spark):
    from martcraft.operators.checks import check_target
    df = spark.createDataFrame([(dt.date(1997, 3, 1), 5)], "month date, sold_qty long")
    p = plan(check_target(df, "t", 1997, 5))
    assert "year(" not in p
