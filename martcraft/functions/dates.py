"""Month arithmetic and pushdown-friendly date predicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """First day of the month as DATE (``DATE_TRUNC('MONTH', x)::date``).

    ``trunc`` goes through DATE, so TIMESTAMP_NTZ input never takes a
    session-time-zone hop."""
    return F.trunc(_col(c), "MM")


def _add_month(d: dt.date) -> dt.date:
    return dt.date(d.year + d.month // 12, d.month % 12 + 1, 1)


def _bound(d: dt.date, dtype: str) -> Column:
    # A typed literal of the column's own type (constant-folded), so the
    # comparison needs no cast on the column side and stays pushable.
    return F.lit(d.isoformat()).cast(dtype)


def dtype_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def month_in(c, months: Iterable[dt.date], dtype: str = "date") -> Column:
    """``month_start(c) IN (months)`` written as an OR of half-open ranges on
    the raw column, so that Parquet row-group statistics can prune it
    (a predicate on ``trunc(c)`` is not pushed down). ``dtype`` is the
    column's type (``date``, ``timestamp_ntz`` or ``timestamp``)."""
    col = _col(c)
    cond = None
    for m in sorted(set(months)):
        m0 = dt.date(m.year, m.month, 1)
        lo, hi = _bound(m0, dtype), _bound(_add_month(m0), dtype)
        r = (col >= F.lit(lo)) & (col < F.lit(hi))
        cond = r if cond is None else (cond | r)
    return cond if cond is not None else F.lit(False)


def year_is(c, year: int, dtype: str = "date") -> Column:
    """``EXTRACT(YEAR FROM c) = year`` as a half-open range (pushdown-friendly)."""
    col = _col(c)
    lo = _bound(dt.date(year, 1, 1), dtype)
    hi = _bound(dt.date(year + 1, 1, 1), dtype)
    return (col >= F.lit(lo)) & (col < F.lit(hi))


def months_between_inclusive(lo, hi) -> Column:
    """Array of month starts lo..hi (DATEs); empty when lo > hi or either is
    NULL. ``sequence`` itself rejects a reversed range, hence the guard."""
    lo, hi = _col(lo), _col(hi)
    return F.when(
        lo.isNotNull() & hi.isNotNull() & (lo <= hi),
        F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH")),
    ).otherwise(F.array().cast("array<date>"))
