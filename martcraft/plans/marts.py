"""Mart builders (M12): compositions of the operators. Column order follows
the original marts.

A builder is eager where a reduced intermediate feeds several branches: it
writes that stage table (see ``martcraft.session.materialize``) before it
returns, and the result reads it. Wrap building and writing in ``stage_run``
to have the stage tables removed afterwards.

``month`` is a DATE in every v2 mart. In the v1 and interim kit marts it has
the wider type of the kit fact's ``month`` and the realization's ``period``
(a timestamp if either is one), as the patch keeps its raw period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from martcraft.functions.classify import product_type
from martcraft.operators.calendar import cumulative_sparse, densify_cumulative, in_calendar
from martcraft.operators.dedupe import dedupe_guide_by_model, dedupe_guide_by_name
from martcraft.operators.rollup import (
    KIT_UNIT,
    dealer_division,
    kit_rollup,
    kit_rollup_v1,
    lookup_code_by_name,
    monthly_rollup,
    realization_patch,
    union_sources,
)
from martcraft.rules import Rules
from martcraft.session import materialize
from martcraft.sources.inputs import Inputs

RETAIL_UNIT = ("division", "internal_code", "code65", "assembly_variant", "sales_direction")
RETAIL_UNIT_V1 = ("division", "internal_code", "assembly_variant", "sales_direction")

KIT_V1_COLS = ("month", "division", "internal_code", "code65", "assembly_variant",
               "sold_qty", "sales_direction", "cumulative_qty")
KIT_INTERIM_COLS = KIT_V1_COLS + ("product_type",)
KIT_V2_COLS = ("month", "division", "internal_code", "code65", "assembly_variant",
               "sales_direction", "sold_qty", "cumulative_qty", "product_type")
RETAIL_V1_COLS = ("month", "division", "internal_code", "assembly_variant", "retail_qty",
                  "sales_direction", "cumulative_qty")
RETAIL_ROLLUP_COLS = ("month", "division", "internal_code", "code65", "assembly_variant",
                      "retail_qty", "sales_direction", "product_type")
RETAIL_INTERIM_COLS = RETAIL_ROLLUP_COLS + ("cumulative_qty",)
RETAIL_V2_COLS = ("month", "division", "internal_code", "code65", "assembly_variant",
                  "sales_direction", "product_type", "retail_qty", "cumulative_qty")
BALANCE_V1_COLS = ("month", "division", "internal_code", "assembly_variant", "sales_direction",
                   "opening_stock", "closing_stock")
BALANCE_V2_COLS = ("month", "division", "internal_code", "code65", "assembly_variant",
                   "sales_direction", "opening_stock", "closing_stock", "product_type")


# --- kit sales ---------------------------------------------------------------

def kit_union_v1(inp: Inputs, rules: Rules) -> DataFrame:
    patch = realization_patch(inp.realization, inp.product, inp.direction, inp.division, rules)
    return union_sources(kit_rollup_v1(inp.kit_sales, inp.guide, rules), patch)


def kit_union_v2(inp: Inputs, rules: Rules, by_division: bool = False) -> DataFrame:
    # The de-duplicated guide feeds both match attempts; like the original
    # helper table it is materialized once (a dimension-sized stage table).
    nom = materialize(dedupe_guide_by_model(
        inp.guide, None if by_division else rules.guide_divisions, by_division=by_division))
    patch = realization_patch(inp.realization, inp.product, inp.direction, inp.division, rules)
    return union_sources(kit_rollup(inp.kit_sales, nom, rules), patch)


def kit_sales_v1(inp: Inputs, rules: Rules) -> DataFrame:
    """Kit sales, v1: v1 match, patch, sparse running total."""
    return cumulative_sparse(kit_union_v1(inp, rules), KIT_UNIT, "sold_qty").select(*KIT_V1_COLS)


def kit_sales_interim(inp: Inputs, rules: Rules) -> DataFrame:
    """Kit sales, interim: guide keyed by (model, maker, division), fallback
    match, sparse running total, constant product type."""
    u = kit_union_v2(inp, rules, by_division=True)
    return (cumulative_sparse(u, KIT_UNIT, "sold_qty")
            .withColumn("product_type", F.lit(rules.label_kit)).select(*KIT_INTERIM_COLS))


def kit_sales_v2(inp: Inputs, rules: Rules, dropped: Observation | None = None) -> DataFrame:
    """Kit sales, v2: guide keyed by (model, maker) within the listed
    divisions, fallback match, patch, dense months with a carried running
    total, constant product type."""
    # The union is the last compact point before the dense expansion: a stage
    # table, without the rows that belong to no calendar month (counted in
    # ``dropped``).
    u = kit_union_v2(inp, rules)
    inside = in_calendar("month", rules.calendar_start, rules.as_of)
    if dropped is not None:
        u = u.observe(dropped, F.count(F.when(~inside, 1)).alias("off_calendar_rows"))
    u = materialize(u.where(inside), "kit_union")
    dense = densify_cumulative(u, KIT_UNIT, KIT_UNIT, "sold_qty",
                               rules.calendar_start, rules.as_of)
    return dense.withColumn("product_type", F.lit(rules.label_kit)).select(*KIT_V2_COLS)


# --- retail sales --------------------------------------------------------------

def retail_sales_v1(inp: Inputs, rules: Rules) -> DataFrame:
    agg = monthly_rollup(inp.retail, "period", ["division", "internal_code", "assembly_variant",
                                                "sales_direction"], {"retail_qty": "retail_qty"})
    return cumulative_sparse(agg, RETAIL_UNIT_V1, "retail_qty", unit_rows=None).select(*RETAIL_V1_COLS)


def _typed_retail(inp: Inputs, rules: Rules, with_direction_rule: bool) -> DataFrame:
    return inp.retail.withColumn(
        "product_type", product_type(rules, with_direction_rule=with_direction_rule))


STOCK = {"opening_stock": "opening_stock", "closing_stock": "closing_stock"}
LINE_DIMS = ("division", "internal_code", "assembly_variant", "sales_direction")


def monthly_lines(lines: DataFrame, rules: Rules, extra: Sequence[Column] = ()) -> DataFrame:
    """Monthly sums of all three measures of the retail lines by unit and by
    both product types (with and without the direction rule), and ``extra``
    aggregates."""
    typed = (lines.withColumn("product_type", product_type(rules, with_direction_rule=True))
             .withColumn("basic_type", product_type(rules, with_direction_rule=False)))
    return monthly_rollup(typed, "period", [*LINE_DIMS, "product_type", "basic_type"],
                          {"retail_qty": "retail_qty", **STOCK}, extra=extra)


def retail_base(inp: Inputs, rules: Rules) -> DataFrame:
    """One pass over the retail lines for both v2 marts of a run: a stage table
    of ``monthly_lines``."""
    return materialize(monthly_lines(inp.retail, rules), "retail_base")


def retail_codes(inp: Inputs) -> DataFrame:
    """The de-duplicated guide by name, staged: both v2 marts look codes up."""
    return materialize(dedupe_guide_by_name(inp.guide), "guide_by_name")


def _summed(base: DataFrame, codes: DataFrame, type_col: str, measures) -> DataFrame:
    agg = base.groupBy("month", *LINE_DIMS, F.col(type_col).alias("product_type")).agg(
        *[F.sum(m).alias(m) for m in measures])
    return lookup_code_by_name(agg, codes)


def _rolled(inp: Inputs, rules: Rules, with_direction_rule: bool, measures: dict[str, str],
            base: DataFrame | None, codes: DataFrame | None) -> DataFrame:
    """Monthly sums by unit and one product type, with the code looked up by
    name: from a run's shared ``base``, or, for a mart alone, straight from the
    lines with that type and those measures only."""
    codes = dedupe_guide_by_name(inp.guide) if codes is None else codes
    if base is not None:
        return _summed(base, codes, "product_type" if with_direction_rule else "basic_type", list(measures))
    agg = monthly_rollup(_typed_retail(inp, rules, with_direction_rule), "period", [*LINE_DIMS, "product_type"], measures)
    return lookup_code_by_name(agg, codes)


def retail_rollup(inp: Inputs, rules: Rules, base: DataFrame | None = None,
                  codes: DataFrame | None = None) -> DataFrame:
    """v2 retail roll-up: SUM by month and unit of the classified lines, then
    look the code up by name. The lookup is unique per name, so it is done
    after the aggregation (on monthly rows, not lines) without changing the
    result."""
    return _rolled(inp, rules, True, {"retail_qty": "retail_qty"}, base, codes).select(*RETAIL_ROLLUP_COLS)


def _with_dealer_division(inp: Inputs, rules: Rules, with_direction_rule: bool,
                          measures: dict[str, str]) -> DataFrame:
    """Roll-up whose division comes from the dealer dimension (interim marts).
    The lines get the dealer's division, then they are summed once."""
    lines = dealer_division(_typed_retail(inp, rules, with_direction_rule), inp.dealer)
    agg = monthly_rollup(lines, "period", ["division", "internal_code", "assembly_variant", "sales_direction",
                                           "product_type"], measures)
    return lookup_code_by_name(agg, dedupe_guide_by_name(inp.guide))


def retail_sales_interim(inp: Inputs, rules: Rules) -> DataFrame:
    agg = _with_dealer_division(inp, rules, True, {"retail_qty": "retail_qty"})
    return cumulative_sparse(agg, RETAIL_UNIT, "retail_qty", unit_rows=None).select(*RETAIL_INTERIM_COLS)


def retail_sales_v2(inp: Inputs, rules: Rules, base: DataFrame | None = None,
                    codes: DataFrame | None = None, dropped: Observation | None = None) -> DataFrame:
    """Retail sales, v2: units include the product type but the running total
    does not, so a unit's kit and vehicle rows share one total."""
    rollup = materialize(retail_rollup(inp, rules, base, codes), "retail_rollup")
    dense = densify_cumulative(rollup, RETAIL_UNIT + ("product_type",), RETAIL_UNIT, "retail_qty",
                               rules.calendar_start, rules.as_of, dropped=dropped)
    return dense.select(*RETAIL_V2_COLS)


# --- stock balance -------------------------------------------------------------

def balance_v1(inp: Inputs, rules: Rules) -> DataFrame:
    return monthly_rollup(inp.retail, "period", ["division", "internal_code", "assembly_variant",
                                                 "sales_direction"], STOCK).select(*BALANCE_V1_COLS)


def balance_v2(inp: Inputs, rules: Rules, base: DataFrame | None = None,
               codes: DataFrame | None = None) -> DataFrame:
    return _rolled(inp, rules, False, STOCK, base, codes).select(*BALANCE_V2_COLS)


def balance_interim(inp: Inputs, rules: Rules) -> DataFrame:
    return _with_dealer_division(inp, rules, False, STOCK).select(*BALANCE_V2_COLS)


MARTS = {
    "v1": {"kit_sales": kit_sales_v1, "retail_sales": retail_sales_v1, "balance": balance_v1},
    "interim": {"kit_sales": kit_sales_interim, "retail_sales": retail_sales_interim,
                "balance": balance_interim},
    "v2": {"kit_sales": kit_sales_v2, "retail_sales": retail_sales_v2, "balance": balance_v2},
}
