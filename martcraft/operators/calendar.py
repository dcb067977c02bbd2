"""Month calendar, dense month grids and running totals (M4, M5, M6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from martcraft.functions.dates import month_start, months_between_inclusive
from martcraft.functions.nullsafe import nullsafe_on
from martcraft.session import materialize


def _date_col(d) -> Column:
    if d is None:
        return F.current_date()
    if isinstance(d, Column):
        return d
    return F.lit(d.isoformat() if isinstance(d, dt.date) else str(d)).cast("date")


def calendar_bounds(start, as_of) -> tuple[Column, Column]:
    """First and last month of the calendar: ``trunc(start)`` to
    ``trunc(as_of)``; ``as_of=None`` is today (the current, partial month is
    included, as the original daily series up to NOW() includes it)."""
    return month_start(_date_col(start)), month_start(_date_col(as_of))


def calendar_months(spark: SparkSession, start, as_of, month_col: str = "month") -> DataFrame:
    """The month calendar as rows (M4): a month-step sequence, already
    distinct, instead of a daily series truncated and de-duplicated."""
    lo, hi = calendar_bounds(start, as_of)
    return spark.range(1).select(F.explode(months_between_inclusive(lo, hi)).alias(month_col))


def month_unit_grid(units: DataFrame, start, as_of, month_col: str = "month") -> DataFrame:
    """Every unit x every calendar month (the original CROSS JOIN of calendar
    and units), generated per unit row with ``explode(sequence)``: no join,
    no shuffle, and the work stays partitioned like ``units``."""
    lo, hi = calendar_bounds(start, as_of)
    return units.select(F.explode(months_between_inclusive(lo, hi)).alias(month_col), *units.columns)


def grid_join(grid: DataFrame, facts: DataFrame, unit_cols: Sequence[str], measure: str,
              month_col: str = "month") -> DataFrame:
    """``grid LEFT JOIN facts ON month = month AND unit <=> unit`` with
    NULL key parts matching NULL ones."""
    f = facts.select(*[F.col(c).alias("_f_" + c) for c in [month_col, *unit_cols]], measure)
    cond = (grid[month_col] == f["_f_" + month_col]) & nullsafe_on(
        grid, f, unit_cols, ["_f_" + c for c in unit_cols])
    return grid.join(f, cond, "left").drop(*["_f_" + c for c in [month_col, *unit_cols]])


def running_total(measure: str, partition_cols: Sequence[str], month_col: str = "month") -> Column:
    """``SUM(measure) OVER (PARTITION BY p ORDER BY month)`` with the SQL
    default frame spelled out: RANGE, so rows of the same month are peers
    and all carry the month-end total."""
    w = (Window.partitionBy(*partition_cols).orderBy(F.col(month_col).asc_nulls_first())
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return F.sum(measure).over(w)


def prefix_totals(rows: DataFrame, partition_cols: Sequence[str], measure: str, blocks: int,
                  out: str = "cumulative_qty", month_col: str = "month") -> DataFrame:
    """The same running total in two levels, for partitions too large for one
    task: rows are range-partitioned by (partition, month) into ``blocks``
    (rows of one month stay together, so peers keep equal totals), each block
    sums for itself, the blocks' sums are summed up exclusively (one row a
    block and partition), and a row's total is its block's running total plus
    the blocks before. The blocks are a stage table: their bounds come from a
    sample, so they must not be drawn twice."""
    keys = list(partition_cols)
    order = [F.col(c).asc_nulls_first() for c in [*keys, month_col]]
    placed = materialize(rows.repartitionByRange(max(1, blocks), *order).withColumn("_block", F.spark_partition_id()), "range_blocks")
    sums = placed.groupBy("_block", *keys).agg(F.sum(measure).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(F.col("_block").alias("_b"), *[F.col(c).alias(f"_p{i}") for i, c in enumerate(keys)],
                          F.sum("_sum").over(before).alias("_before")).where(F.col("_before").isNotNull())
    on = (F.col("_block") == F.col("_b")) & nullsafe_on(placed, carried, keys, [f"_p{i}" for i in range(len(keys))])
    own = running_total(measure, ["_block", *keys], month_col)
    both = placed.withColumn(out, own).join(carried, on, "left")
    total = F.coalesce(F.col("_before") + F.col(out), F.col("_before"), F.col(out))
    return both.withColumn(out, total.cast(sums.schema["_sum"].dataType)).select(*rows.columns, out)


def cumulative_sparse(df: DataFrame, partition_cols: Sequence[str], measure: str,
                      out: str = "cumulative_qty", month_col: str = "month",
                      unit_rows: int | None = 100_000) -> DataFrame:
    """``SELECT *, running total`` over the rows as they are (M6).

    A partition of the window is one task, and where periods are not cut to
    months its rows are bounded by nothing. So partitions of more than
    ``unit_rows`` rows (counted in one aggregate over the staged rows) get
    their totals from ``prefix_totals`` in blocks of about that size; all
    others from one window. ``unit_rows=None`` is for input that is bounded
    already, like one row a unit and month: a window alone, nothing staged."""
    if unit_rows is None:
        return df.withColumn(out, running_total(measure, partition_cols, month_col))
    rows = materialize(df, "running_total_rows")
    sizes = rows.groupBy(*partition_cols).agg(F.count("*").alias("_n")).where(F.col("_n") > unit_rows)
    total = sizes.agg(F.sum("_n")).first()[0]
    if total is None:
        return rows.withColumn(out, running_total(measure, partition_cols, month_col))
    names = [f"_h{i}" for i in range(len(partition_cols))]
    hot = materialize(sizes.select(*[F.col(c).alias(n) for c, n in zip(partition_cols, names)]), "hot_partitions")
    on = nullsafe_on(rows, hot, list(partition_cols), names)
    light = rows.join(hot, on, "left_anti").withColumn(out, running_total(measure, partition_cols, month_col))
    heavy = rows.join(hot, on, "left_semi")
    return light.unionByName(prefix_totals(heavy, partition_cols, measure, -(-total // unit_rows), out, month_col))


def in_calendar(month_col: str, start, as_of) -> Column:
    """Whether the month is a month start inside the calendar (never NULL)."""
    lo, hi = calendar_bounds(start, as_of)
    m = F.col(month_col)
    return F.coalesce((m >= lo) & (m <= hi) & (m == month_start(m)), F.lit(False))


def densify_cumulative(df: DataFrame, unit_cols: Sequence[str], partition_cols: Sequence[str],
                       measure: str, start, as_of, out: str = "cumulative_qty",
                       month_col: str = "month", dropped: Observation | None = None) -> DataFrame:
    """Dense monthly series with a carried-forward running total (M5).

    For each unit, every calendar month from the first month in which
    its partition has a non-NULL measure up to the last calendar month; the
    unit's own rows where they exist (duplicates kept), otherwise one row
    with a NULL measure. ``partition_cols`` may be a subset of ``unit_cols``
    (units of one partition share one running total). Rows whose month is
    not a month start inside the calendar belong to no month of the series:
    they are dropped before the shuffle (``dropped`` counts them) and count
    towards no total; only where units share a partition does each such unit
    keep one row, as it still gets its partition's series. The month of the
    result is the calendar's DATE, whatever the input's type.

    Plan: one shuffle. Rows are hash-partitioned by ``partition_cols``; every
    later window partitions by a superset of those columns, so none adds an
    exchange. The missing months are generated next to each unit's existing
    rows from ``lag``/``lead`` of its in-calendar months — leading empty
    months are never created and nothing is joined. Each window partition
    holds one unit's monthly rows (bounded by the calendar length x the
    number of unioned sources), never raw facts.
    """
    unit_cols, partition_cols = list(unit_cols), list(partition_cols)
    lo, hi = calendar_bounds(start, as_of)
    inside = in_calendar(month_col, start, as_of)
    if dropped is not None:
        df = df.observe(dropped, F.count(F.when(~inside, 1)).alias("off_calendar_rows"))
    rows = df.where(inside).select(*unit_cols, F.col(month_col).cast("date").alias("_mc"), measure)
    if set(partition_cols) != set(unit_cols):
        lone = df.where(~inside).select(*unit_cols).distinct()
        rows = rows.unionByName(lone.select(
            "*", F.lit(None).cast("date").alias("_mc"), F.lit(None).cast(df.schema[measure].dataType).alias(measure)))
    rows = rows.repartition(*partition_cols)
    # In-calendar months first, ascending; off-calendar rows (NULL) last.
    wu_ord = Window.partitionBy(*unit_cols).orderBy(F.col("_mc").asc_nulls_last())
    first_measure = F.min(F.when(F.col(measure).isNotNull(), F.col("_mc")))
    if set(partition_cols) == set(unit_cols):
        # Same partitioning as the ordered unit window: one sort serves both.
        wp = wu_ord.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    else:
        wp = Window.partitionBy(*partition_cols)
    rows = rows.select(
        "*",
        first_measure.over(wp).alias("_first"),
        F.lag("_mc").over(wu_ord).alias("_prev"),
        F.lead("_mc").over(wu_ord).alias("_next"),
        F.row_number().over(wu_ord).alias("_rn"),
    )
    first, mc = F.col("_first"), F.col("_mc")
    # No fill at all until the partition has a non-NULL measure (``greatest``
    # skips NULLs, so the guard must be explicit).
    in_row = mc.isNotNull() & first.isNotNull()
    # Months missing before this row (after the previous calendar month of
    # the unit, and not before the partition's first month).
    gap_lo = F.when(F.col("_prev").isNull(), first).otherwise(
        F.greatest(F.add_months("_prev", 1), first))
    gap = F.when(in_row, months_between_inclusive(gap_lo, F.add_months(mc, -1)))
    # Months missing after the unit's last calendar month.
    tail = F.when(in_row & F.col("_next").isNull(),
                  months_between_inclusive(F.greatest(F.add_months(mc, 1), first), hi))
    # A unit without any calendar month (its first row, in NULLS LAST order,
    # is off-calendar) still gets the whole series once its partition starts.
    whole = F.when(mc.isNull() & (F.col("_rn") == 1), months_between_inclusive(first, hi))
    own = in_row & (mc >= first)
    empty = F.array().cast("array<date>")
    months = F.concat(F.when(own, F.array(mc)).otherwise(empty), F.coalesce(gap, empty),
                      F.coalesce(tail, empty), F.coalesce(whole, empty))
    # Element 0 is the row's own month when it is kept; every other element
    # is a filled month with a NULL measure.
    dense = rows.select(*unit_cols, F.col(measure).alias("_v"), own.alias("_own"),
                        F.posexplode(months).alias("_pos", month_col)).select(
        *unit_cols, month_col,
        F.when(F.col("_own") & (F.col("_pos") == 0), F.col("_v")).alias(measure))
    return dense.withColumn(out, running_total(measure, partition_cols, month_col))
