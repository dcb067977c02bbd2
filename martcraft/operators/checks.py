"""Data-quality checks and reconciliations (M9, M10, M11).

All are global aggregates: each task sums its share and a single final row
is formed from one partial row per task, whatever the table size.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.functions.dates import dtype_of, year_is

CHECK_COLUMNS = ("table_name", "check_name", "ts", "check_result")


def _ts(checked_at) -> Column:
    if checked_at is None:
        return F.localtimestamp()
    if isinstance(checked_at, dt.datetime):
        checked_at = checked_at.isoformat(sep=" ")
    return F.lit(str(checked_at)).cast("timestamp_ntz")


def check_target(mart: DataFrame, table_name: str, year: int, target: int,
                 measure: str = "sold_qty", month_col: str = "month",
                 prefix: str = "comparison_with_target:", checked_at=None) -> DataFrame:
    """One check row: ``table_name``, ``'<prefix> <target>=<sum>'``, time,
    ``target = sum``. The sum covers ``year`` only. An empty year gives a NULL
    message and a NULL result; nothing raises — the row records the outcome."""
    total = mart.where(year_is(month_col, year, dtype_of(mart, month_col))).agg(
        F.sum(measure).alias("_total"))
    return total.select(
        F.lit(table_name).alias("table_name"),
        F.concat(F.lit(f"{prefix} {target}="), F.col("_total").cast("string")).alias("check_name"),
        _ts(checked_at).alias("ts"),
        (F.lit(target).cast("bigint") == F.col("_total")).alias("check_result"),
    )


def reconcile(left: DataFrame, left_measure: str, left_date: str,
              right: DataFrame, right_measure: str, right_date: str, year: int) -> DataFrame:
    """Totals of two tables for one year, side by side (M10): columns year,
    left_total, right_total, difference, equal. One pass: both inputs are
    tagged into a single union and summed in one global aggregate. Measures are
    summed in their own type (a decimal is never cut before the sum)."""
    l_type, r_type = dtype_of(left, left_measure), dtype_of(right, right_measure)
    lt = left.where(year_is(left_date, year, dtype_of(left, left_date))).select(
        F.col(left_measure).alias("_l"), F.lit(None).cast(r_type).alias("_r"))
    rt = right.where(year_is(right_date, year, dtype_of(right, right_date))).select(
        F.lit(None).cast(l_type).alias("_l"), F.col(right_measure).alias("_r"))
    tot = lt.unionByName(rt).agg(F.sum("_l").alias("left_total"), F.sum("_r").alias("right_total"))
    return tot.select(
        F.lit(year).alias("year"), "left_total", "right_total",
        (F.col("left_total") - F.col("right_total")).alias("difference"),
        F.col("left_total").eqNullSafe(F.col("right_total")).alias("equal"),
    )


def distinct_export_codes(mart: DataFrame, exclude_pattern: str,
                          name_col: str = "internal_code",
                          direction_col: str = "sales_direction") -> DataFrame:
    """``SELECT DISTINCT name FROM mart WHERE direction NOT LIKE pattern``
    (rows with a NULL direction are not kept, as in SQL)."""
    return (mart.where(~F.col(direction_col).like(exclude_pattern))
            .select(name_col).distinct())
