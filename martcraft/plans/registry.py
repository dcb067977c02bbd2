"""Registered queries: one per operator / mart, each ``(spark, sf_dir) ->
DataFrame`` over the fixture inputs derived from the given tables. Column
names match ``martcraft.plans.oracle``."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.functions.classify import product_type
from martcraft.functions.codes import code_variants, normalize_drawing, normalize_maker
from martcraft.functions.dates import dtype_of, month_in, month_start
from martcraft.operators import calendar as C
from martcraft.operators import checks as K
from martcraft.operators import dedupe as D
from martcraft.operators import match as MT
from martcraft.operators import rollup as RU
from martcraft.operators import sinks as SK
from martcraft.operators.publish import location
from martcraft.plans import incremental as I
from martcraft.plans import marts as M
from martcraft.plans.oracle import CHECK_TARGET_V1
from martcraft.plans.run import COMMENTS, run_marts
from martcraft.rules import FIXTURE, FIXTURE_CHECKED_AT
from martcraft.session import materialize, stage_path
from martcraft.sources import Inputs, fixture_inputs

R = FIXTURE
Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Callable[[SparkSession, Inputs], DataFrame]] = {}


def _q(name: str):
    def deco(fn):
        _REGISTRY[name] = fn
        return fn
    return deco


def _nom(inp: Inputs) -> DataFrame:
    return D.dedupe_guide_by_model(inp.guide, R.guide_divisions)


# --- sources -----------------------------------------------------------------

@_q("scan_retail")
def _(spark, inp):
    return inp.retail


@_q("scan_guide")
def _(spark, inp):
    return inp.guide


@_q("scan_kit")
def _(spark, inp):
    return inp.kit_sales


@_q("scan_realization")
def _(spark, inp):
    return inp.realization


# --- projections, filters, functions -----------------------------------------

@_q("project_rename")
def _(spark, inp):
    return inp.retail.select(
        month_start("period").alias("month"), "division", "internal_code", "assembly_variant",
        "sales_direction", F.col("opening_stock").alias("opening"),
        F.col("closing_stock").alias("closing"))


@_q("filter_guide_divisions")
def _(spark, inp):
    return inp.guide.where(F.col("division").isin(list(R.guide_divisions)))


@_q("filter_patch_months")
def _(spark, inp):
    r = inp.realization
    return r.where(month_in("period", R.patch_months, dtype_of(r, "period")))


@_q("normalize_codes")
def _(spark, inp):
    a, c = code_variants("code65", R.code_homoglyphs)
    return inp.guide.select("guide_id", "code65", a.alias("code65_a"), c.alias("code65_c"))


@_q("normalize_drawings")
def _(spark, inp):
    return inp.kit_sales.select(
        "drawing_no", normalize_drawing("drawing_no", R.drawing_replace).alias("drawing_norm")
    ).distinct()


@_q("normalize_maker")
def _(spark, inp):
    return inp.guide.select("guide_id", "manufacturer",
                            normalize_maker("manufacturer").alias("maker_norm"))


@_q("classify_product")
def _(spark, inp):
    return inp.retail.select("period", "internal_code", "vin", "sales_direction",
                             product_type(R, with_direction_rule=True).alias("product_type"))


@_q("classify_product_basic")
def _(spark, inp):
    return inp.retail.select("period", "internal_code", "vin", "sales_direction",
                             product_type(R, with_direction_rule=False).alias("product_type"))


# --- windows / dedupe --------------------------------------------------------

@_q("group_size_window")
def _(spark, inp):
    g = inp.guide.select("guide_id", "factory_model", "manufacturer")
    return D.group_size(g, ["factory_model", "manufacturer"], "cnt")


@_q("first_value_latest")
def _(spark, inp):
    return D.first_value_latest(inp.guide, ["factory_model", "manufacturer"], "guide_id",
                                ["name", "code65"])


@_q("dedupe_guide_by_model")
def _(spark, inp):
    return _nom(inp)


@_q("dedupe_guide_by_model_division")
def _(spark, inp):
    return D.dedupe_guide_by_model(inp.guide, None, by_division=True)


@_q("dedupe_guide_by_name")
def _(spark, inp):
    return D.dedupe_guide_by_name(inp.guide)


# --- joins -----------------------------------------------------------------------

@_q("lookup_code_by_name")
def _(spark, inp):
    s = inp.retail.select("period", "internal_code", "dealer_id", "retail_qty")
    return RU.lookup_code_by_name(s, D.dedupe_guide_by_name(inp.guide))


@_q("match_primary")
def _(spark, inp):
    f = inp.kit_sales.select("month", "counterparty", "drawing_no", "sold_qty")
    return MT.match_primary(f, _nom(inp), R).select(
        "month", "counterparty", "drawing_no", "sold_qty",
        "n_name", "n_code65", "n_factory_model", "n_division")


@_q("match_with_fallback")
def _(spark, inp):
    m = MT.match_guide(inp.kit_sales, _nom(inp), R)
    return m.select("month", F.col("m_division").alias("division"),
                    F.col("m_internal_code").alias("internal_code"),
                    F.col("m_code65").alias("code65"), "assembly_variant", "sold_qty",
                    "sales_direction")


@_q("match_v1")
def _(spark, inp):
    m = MT.match_v1(inp.kit_sales, inp.guide, R)
    return m.select("month", F.coalesce("division", "m_division").alias("division"),
                    F.col("m_internal_code").alias("internal_code"),
                    F.col("m_code65").alias("code65"), "assembly_variant", "sold_qty",
                    "sales_direction")


# --- aggregations ----------------------------------------------------------------

@_q("kit_rollup")
def _(spark, inp):
    return RU.kit_rollup(inp.kit_sales, _nom(inp), R)


@_q("kit_rollup_v1")
def _(spark, inp):
    return RU.kit_rollup_v1(inp.kit_sales, inp.guide, R)


@_q("realization_patch")
def _(spark, inp):
    return RU.realization_patch(inp.realization, inp.product, inp.direction, inp.division, R)


@_q("union_sources")
def _(spark, inp):
    return M.kit_union_v2(inp, R)


@_q("distinct_units")
def _(spark, inp):
    return M.kit_union_v2(inp, R).select(*RU.KIT_UNIT).distinct()


@_q("month_unit_grid")
def _(spark, inp):
    units = M.kit_union_v2(inp, R).select(*RU.KIT_UNIT).distinct()
    return C.month_unit_grid(units, R.calendar_start, R.as_of)


@_q("nullsafe_multikey_join")
def _(spark, inp):
    u = materialize(M.kit_union_v2(inp, R), "kit_union")  # feeds both sides
    grid = C.month_unit_grid(u.select(*RU.KIT_UNIT).distinct(), R.calendar_start, R.as_of)
    return C.grid_join(grid, u, RU.KIT_UNIT, "sold_qty").select(
        "month", *RU.KIT_UNIT, "sold_qty")


@_q("cumulative_sparse")
def _(spark, inp):
    return C.cumulative_sparse(M.kit_union_v2(inp, R), RU.KIT_UNIT, "sold_qty")


@_q("densify_cumulative")
def _(spark, inp):
    d = C.densify_cumulative(M.kit_union_v2(inp, R), RU.KIT_UNIT, RU.KIT_UNIT, "sold_qty",
                             R.calendar_start, R.as_of)
    return d.select("month", *RU.KIT_UNIT, "sold_qty", "cumulative_qty")


@_q("retail_rollup")
def _(spark, inp):
    return M.retail_rollup(inp, R)


# --- marts ---------------------------------------------------------------------------

for _name, _fn in (("kit_sales_v1", M.kit_sales_v1), ("kit_sales_interim", M.kit_sales_interim),
                   ("kit_sales_v2", M.kit_sales_v2), ("retail_sales_v1", M.retail_sales_v1),
                   ("retail_sales_interim", M.retail_sales_interim),
                   ("retail_sales_v2", M.retail_sales_v2), ("balance_v1", M.balance_v1),
                   ("balance_v2", M.balance_v2), ("balance_interim", M.balance_interim)):
    _REGISTRY[_name] = (lambda fn: (lambda spark, inp: fn(inp, R)))(_fn)


@_q("dealer_division_rollup")
def _(spark, inp):
    return RU.monthly_rollup(RU.dealer_division(inp.retail, inp.dealer), "period", ["division"],
                             {"retail_qty": "retail_qty"})


# --- marts kept between runs: a stale state first, then brought up to date ------------

def _late(df: DataFrame, month: str, measure: str) -> DataFrame:
    """The rows of an earlier day: one month with other values, one without
    part of its rows, the last two not there yet."""
    m = month_start(month)
    day = lambda s: F.lit(s).cast("date")
    old = df.where(~(F.coalesce(m == day("1996-05-01"), F.lit(False)) & (F.col(measure) % 3 == 0)))
    old = old.withColumn(measure, F.when(m == day("1996-03-01"), F.col(measure) + 1).otherwise(F.col(measure)))
    return old.where(m.isNull() | (m < day("1998-08-01")))


def _earlier(inp: Inputs) -> Inputs:
    return replace(inp, retail=_late(inp.retail, "period", "retail_qty"), kit_sales=_late(inp.kit_sales, "month", "sold_qty"))


@_q("kit_sales_v2_carried")
def _(spark, inp):
    path = _run_dir(spark, "kit_sales_kept")
    I.kit_sales_v2_kept(_earlier(inp), R.with_(as_of=dt.date(2001, 10, 31)), path)
    return I.kit_sales_v2_kept(inp, R, path)[0]


@_q("retail_sales_v2_carried")
def _(spark, inp):
    path, base = _run_dir(spark, "retail_sales_kept"), _run_dir(spark, "retail_base_kept")
    for source, rules in ((_earlier(inp), R.with_(as_of=dt.date(2001, 10, 31))), (inp, R)):
        lines, _ = I.retail_base_kept(source, rules, base)
        mart, _ = I.retail_sales_v2_kept(source, rules, path, lines)
    return mart


@_q("retail_rollup_kept")
def _(spark, inp):
    path = _run_dir(spark, "retail_base_kept")
    I.retail_base_kept(_earlier(inp), R, path)
    return M.retail_rollup(inp, R, I.retail_base_kept(inp, R, path)[0])


@_q("balance_v2_kept")
def _(spark, inp):
    path = _run_dir(spark, "retail_base_kept")
    I.retail_base_kept(_earlier(inp), R, path)
    return M.balance_v2(inp, R, I.retail_base_kept(inp, R, path)[0])


# --- checks ----------------------------------------------------------------------------

def _kit_check(mart: DataFrame, target: int) -> DataFrame:
    return K.check_target(mart, "kit_sales_v2", R.check_year, target,
                          prefix=R.check_name_prefix, checked_at=FIXTURE_CHECKED_AT)


@_q("check_target")
def _(spark, inp):
    # as in production, the check reads the written mart: one pruned scan
    return _kit_check(materialize(M.kit_sales_v2(inp, R), "kit_sales_v2"), R.check_target)


@_q("check_target_v1")
def _(spark, inp):
    return K.check_target(M.kit_sales_v1(inp, R), "kit_sales_v1", R.check_year, CHECK_TARGET_V1,
                          prefix=R.check_name_prefix, checked_at=FIXTURE_CHECKED_AT)


@_q("reconcile_totals")
def _(spark, inp):
    return K.reconcile(inp.retail, "closing_stock", "period",
                       M.balance_v2(inp, R), "closing_stock", "month", R.check_year)


@_q("reconcile_retail")
def _(spark, inp):
    return K.reconcile(M.retail_sales_v2(inp, R), "retail_qty", "month",
                       inp.retail_peer, "retail_qty", "month", R.check_year)


@_q("reconcile_decimal")
def _(spark, inp):
    priced = inp.retail.select("period", (F.col("retail_qty").cast("decimal(18,2)") * F.lit(Decimal("0.35"))).alias("amount"))
    monthly = RU.monthly_rollup(priced, "period", [], {"amount": "amount"})
    out = K.reconcile(priced, "amount", "period", monthly, "amount", "month", R.check_year)
    return out.select("year", *[F.col(c).cast("double").alias(c) for c in ("left_total", "right_total", "difference")], "equal")


@_q("distinct_export_codes")
def _(spark, inp):
    return K.distinct_export_codes(M.kit_sales_v2(inp, R), R.export_exclude_pattern)


# --- sinks (write to the shared folder, read back) -------------------------------------

def _run_dir(spark: SparkSession, name: str) -> str:
    """A folder that lasts as long as the session, as the result reads it."""
    return stage_path(spark, name)


def _of_dropped(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table whose catalog entry goes (it is external: its files
    stay)."""
    folder = location(spark, table)
    spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(folder)


@_q("sink_overwrite_roundtrip")
def _(spark, inp):
    path, table = _run_dir(spark, "balance"), "balance_" + uuid.uuid4().hex[:12]
    SK.replace_table(spark, table, M.balance_v1(inp, R), path)   # another mart first: it must be gone
    SK.replace_table(spark, table, M.balance_v2(inp, R), path)
    return _of_dropped(spark, table)


@_q("sink_insert_overwrite_roundtrip")
def _(spark, inp):
    mart = materialize(M.retail_sales_v1(inp, R), "retail_sales_v1")   # two writes, one build
    path = _run_dir(spark, "retail_sales_v1")
    table = "retail_sales_v1_" + uuid.uuid4().hex[:12]
    SK.create_table(spark, table, mart, path)
    SK.insert_overwrite(mart.where("month < '1997-01-01'"), table, M.RETAIL_V1_COLS)
    SK.insert_overwrite(mart, table, M.RETAIL_V1_COLS)   # a re-run replaces, never duplicates
    return _of_dropped(spark, table)


@_q("table_comment")
def _(spark, inp):
    """The description of a written mart, beside its number of rows."""
    path, table = _run_dir(spark, "balance"), "balance_" + uuid.uuid4().hex[:12]
    SK.replace_table(spark, table, M.balance_v2(inp, R), path)
    SK.comment_on_table(spark, table, COMMENTS["balance"])
    said = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return _of_dropped(spark, table).agg(F.lit(said["Comment"]).alias("comment"), F.count("*").alias("n"))


@_q("check_append_roundtrip")
def _(spark, inp):
    path, table = _run_dir(spark, "stage_checks"), "stage_checks_" + uuid.uuid4().hex[:12]
    mart = materialize(M.kit_sales_v2(inp, R), "kit_sales_v2")
    for run_id, target in (("a", R.check_target), ("b", R.check_target + 1), ("b", R.check_target + 2)):
        row = _kit_check(mart, target)
        SK.create_table(spark, table, row.withColumn("run_id", F.lit("")), path)  # each time by a new catalog entry
        SK.append_once(row, table, K.CHECK_COLUMNS, run_id)                       # run b counts once
        spark.sql(f"DROP TABLE {table}")
    return spark.read.parquet(path).select(*K.CHECK_COLUMNS)


@_q("run_marts_check")
def _(spark, inp):
    """The check row that a whole daily run leaves."""
    database = "run_" + uuid.uuid4().hex[:12]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_run_dir(spark, 'database')}'")
    try:
        path = _run_dir(spark, "run")
        run_marts(spark, inp, R, path, "v2", checked_at=FIXTURE_CHECKED_AT, database=database)
        return spark.read.parquet(f"{path}/stage_checks").select(*K.CHECK_COLUMNS)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def queries() -> dict[str, Query]:
    def bind(fn):
        return lambda spark, sf_dir: fn(spark, fixture_inputs(spark, sf_dir))
    return {name: bind(fn) for name, fn in _REGISTRY.items()}
