"""Monthly roll-ups, the realization patch and the union of sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.functions.dates import dtype_of, month_in, month_start
from martcraft.operators.match import match_guide, match_v1
from martcraft.rules import Rules
from martcraft.session import materialize

KIT_UNIT = ("division", "internal_code", "code65", "assembly_variant", "sales_direction")
KIT_ROLLUP_COLS = ("month", "division", "internal_code", "code65", "assembly_variant",
                   "sold_qty", "sales_direction")


def monthly_rollup(df: DataFrame, period: str, dims: Sequence[str],
                   measures: Mapping[str, str], month_col: str = "month", extra: Sequence[Column] = ()) -> DataFrame:
    """``SELECT trunc(period,'MM') AS month, dims..., SUM(m)... GROUP BY ...``
    (M3). Partial aggregation runs before the shuffle, so a hot group costs
    one row per map task, not its raw rows. ``extra``: further aggregates."""
    return df.groupBy(month_start(period).alias(month_col), *dims).agg(
        *[F.sum(src).alias(out) for out, src in measures.items()], *extra)


def kit_rollup(kit_sales: DataFrame, nom: DataFrame, rules: Rules) -> DataFrame:
    """v2 kit roll-up: match every line to the guide (M2), then SUM by month
    and the matched unit (AG1).

    The fact is first reduced to one row per (month, counterparty, drawing,
    variant, direction): the match depends only on (counterparty, drawing)
    and SUM distributes over the join's fan-out, so the result is the same
    while the join sees monthly aggregates instead of lines. The reduced fact
    feeds both the distinct match keys and the join, so it is materialized:
    the lines are read once."""
    pre = materialize(kit_sales.groupBy(
        "month", "counterparty", "drawing_no", "assembly_variant",
        "sales_direction").agg(F.sum("sold_qty").alias("sold_qty")))
    m = match_guide(pre, nom, rules, keys_materialized=True)
    return (m.groupBy("month", F.col("m_division").alias("division"),
                      F.col("m_internal_code").alias("internal_code"),
                      F.col("m_code65").alias("code65"), "assembly_variant", "sales_direction")
            .agg(F.sum("sold_qty").alias("sold_qty"))
            .select(*KIT_ROLLUP_COLS))


def kit_rollup_v1(kit_sales: DataFrame, guide: DataFrame, rules: Rules) -> DataFrame:
    """v1 kit roll-up: v1 match (no dedupe, no fallback); the fact's own
    division wins over the guide's (``COALESCE(s.division, n.division)``)."""
    pre = materialize(kit_sales.groupBy(
        "month", "division", "drawing_no", "assembly_variant",
        "sales_direction").agg(F.sum("sold_qty").alias("sold_qty")))
    m = match_v1(pre, guide, rules, keys_materialized=True)
    return (m.groupBy("month", F.coalesce("division", "m_division").alias("division"),
                      F.col("m_internal_code").alias("internal_code"),
                      F.col("m_code65").alias("code65"), "assembly_variant", "sales_direction")
            .agg(F.sum("sold_qty").alias("sold_qty"))
            .select(*KIT_ROLLUP_COLS))


def matching_lines(lines: DataFrame, wanted: Mapping[str, DataFrame], most: int = 1_000_000) -> DataFrame:
    """The rows of ``lines`` whose ids are wanted: column -> frame with one
    column of ids. An id list is counted; up to ``most`` ids (8 MB) it is
    broadcast into a semi-join right above the scan, so unwanted rows never
    reach a shuffle. A longer list rejects little and is left to the joins that
    follow."""
    for column, ids in wanted.items():
        few = ids.toDF("_wanted").where(F.col("_wanted").isNotNull()).distinct()
        if few.limit(most + 1).count() <= most:
            lines = lines.join(F.broadcast(few), lines[column] == few["_wanted"], "left_semi")
    return lines


def realization_patch(realization: DataFrame, product: DataFrame, direction: DataFrame,
                      division: DataFrame, rules: Rules) -> DataFrame:
    """Supplement from the realization system for the listed months (M8).

    The period filter is a set of half-open ranges on the raw column (pushed
    into the scan). The division and direction filters reject NULLs, so the
    original left joins are inner joins; only lines of a wanted product and
    direction are summed (``matching_lines``), per (period, product,
    direction), before they meet the dimensions. ``period`` is kept
    untruncated, as in the original (a mid-month period stays a separate
    row)."""
    r = realization.where(month_in("period", rules.patch_months, dtype_of(realization, "period")))
    d = direction.where(F.col("sales_direction") == F.lit(rules.patch_direction)).select(
        F.col("id").alias("_d_id"), "sales_direction")
    div = division.where(F.col("name") == F.lit(rules.patch_division)).select(
        F.col("id").alias("_div_id"), F.col("name").alias("division"))
    p = materialize(product.join(div, product["division_id"] == div["_div_id"]).select(
        F.col("id").alias("_p_id"), F.col("product_name").alias("internal_code"),
        "code65", "assembly_variant", "division"), "patch-products")
    r = matching_lines(r, {"product_id": p.select("_p_id"), "direction_id": d.select("_d_id")})
    pre = r.groupBy("period", "product_id", "direction_id").agg(F.sum("qty").alias("qty"))
    j = pre.join(d, pre["direction_id"] == d["_d_id"]).join(p, F.col("product_id") == F.col("_p_id"))
    return (j.groupBy(F.col("period").alias("month"), "division", "internal_code", "code65",
                      "assembly_variant", "sales_direction")
            .agg(F.sum("qty").alias("sold_qty"))
            .select(*KIT_ROLLUP_COLS))


def union_sources(*parts: DataFrame) -> DataFrame:
    """``UNION ALL`` by column name; duplicates (month, unit) are kept, never
    re-aggregated."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dealer_division(lines: DataFrame, dealer: DataFrame) -> DataFrame:
    """``LEFT JOIN dealer ON dealer_id = id``: the lines with the dealer's
    division instead of their own. Joined to the lines, not to sums by dealer:
    those are nearly as many as the lines where dealers are, and a task would
    hold a sum for each. A dealer dimension that is small is broadcast; else
    AQE's skew join splits a hot dealer on the side of the lines."""
    d = dealer.select(F.col("id").alias("_dl_id"), F.col("division").alias("_dl_division"))
    own = [c for c in lines.columns if c != "division"]
    return lines.join(d, lines["dealer_id"] == d["_dl_id"], "left").select(*own, F.col("_dl_division").alias("division"))


def lookup_code_by_name(df: DataFrame, nom_by_name: DataFrame, name_col: str = "internal_code") -> DataFrame:
    """``LEFT JOIN nom n ON s.name_col = n.name``: adds ``code65``.

    ``nom_by_name`` is unique per name, so the join never multiplies rows."""
    n = nom_by_name.select(F.col("name").alias("_lk_name"), "code65")
    return df.join(n, df[name_col] == n["_lk_name"], "left").drop("_lk_name")
