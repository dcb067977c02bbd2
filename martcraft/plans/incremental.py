"""The v2 marts kept between runs: a daily run rebuilds only what changed.

The monthly base of the retail lines is replaced by month
(``operators.incremental.refresh_rollup``), the two dense series from their
carried totals (``refresh_dense``). Results equal the full builders' bag for
bag; each function's path holds one mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martcraft.functions.dates import dtype_of, month_in
from martcraft.operators.incremental import PRINT_SUMS, Refresh, print_sums, refresh_dense, refresh_rollup, summed_prints
from martcraft.operators.rollup import KIT_UNIT
from martcraft.plans import marts as M
from martcraft.rules import Rules
from martcraft.session import materialize
from martcraft.sources.inputs import Inputs


def retail_base_kept(inp: Inputs, rules: Rules, path: str, prints: DataFrame | None = None) -> tuple[DataFrame, Refresh]:
    """``marts.retail_base`` below ``path``. ``prints``: the lines' fingerprints
    by month; by default one pass over the lines finds them and sums the lines.
    Where the lines are partitioned by month, ``listing_fingerprints`` reads
    none, and only the changed months are scanned at all."""
    lines = inp.retail
    if prints is None:
        sums = materialize(M.monthly_lines(lines, rules, print_sums(lines.columns)), "retail_lines")

        def summed(months: list[dt.date | None]) -> DataFrame:
            known = [m for m in months if m is not None]
            wanted = F.col("month").isin(known) if known else F.lit(False)
            if None in months:
                wanted = wanted | F.col("month").isNull()
            return sums.where(wanted).drop(*PRINT_SUMS)

        return refresh_rollup(path, summed_prints(sums), summed)
    kind = dtype_of(lines, "period")

    def build(months: list[dt.date | None]) -> DataFrame:
        wanted = month_in("period", [m for m in months if m is not None], kind)
        if None in months:
            wanted = wanted | F.col("period").isNull()
        return M.monthly_lines(lines.where(wanted), rules)

    return refresh_rollup(path, prints, build)


def kit_sales_v2_kept(inp: Inputs, rules: Rules, path: str) -> tuple[DataFrame, Refresh]:
    dense, done = refresh_dense(M.kit_union_v2(inp, rules), path, KIT_UNIT, KIT_UNIT, "sold_qty", rules.calendar_start, _as_of(rules))
    return dense.withColumn("product_type", F.lit(rules.label_kit)).select(*M.KIT_V2_COLS), done


def retail_sales_v2_kept(inp: Inputs, rules: Rules, path: str, base: DataFrame | None = None) -> tuple[DataFrame, Refresh]:
    rollup = M.retail_rollup(inp, rules, base)
    dense, done = refresh_dense(rollup, path, M.RETAIL_UNIT + ("product_type",), M.RETAIL_UNIT, "retail_qty",
                                rules.calendar_start, _as_of(rules))
    return dense.select(*M.RETAIL_V2_COLS), done


def _as_of(rules: Rules) -> dt.date:
    return rules.as_of or dt.date.today()
