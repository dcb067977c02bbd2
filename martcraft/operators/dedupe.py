"""Guide de-duplication: "latest usable record per key" (M1) and the two
window building blocks it replaces (group size, latest value).

The original form is two windows and a DISTINCT::

    cnt   = COUNT(*) OVER (PARTITION BY keys)
    keep  = code IS NOT NULL OR cnt = 1
    value = FIRST_VALUE(v) OVER (PARTITION BY keys ORDER BY id DESC)  -- kept rows only
    SELECT DISTINCT value..., keys..., passthrough...

A window over ``keys`` sends every row of a key to one task; with a NULL or
popular key holding a large share of the guide that task holds the share.
Here the same result comes from aggregates with map-side combine: each key
(plus pass-through value) is reduced to one small row before any shuffle,
so no task ever buffers a raw group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def group_size(df: DataFrame, keys: Sequence[str], out: str = "cnt") -> DataFrame:
    """``df`` plus ``COUNT(*) OVER (PARTITION BY keys)``.

    Counted with a combining aggregate, then attached with a null-safe join
    (NULL keys form one group, as in the window). The count side has one row
    per key: AQE broadcasts it when small, and otherwise its skew-join
    handling splits a hot key on the row side."""
    tmp = [f"_gk{i}" for i in range(len(keys))]
    counts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
              .select(*[F.col(k).alias(t) for k, t in zip(keys, tmp)], out))
    cond = reduce(lambda a, b: a & b,
                  [df[k].eqNullSafe(counts[t]) for k, t in zip(keys, tmp)])
    return df.join(counts, cond, "inner").drop(*tmp)


def first_value_latest(df: DataFrame, keys: Sequence[str], order_col: str,
                       values: Sequence[str]) -> DataFrame:
    """One row per key with ``values`` taken from the row with the greatest
    ``order_col`` (``FIRST_VALUE(v) OVER (PARTITION BY keys ORDER BY o DESC)``
    collapsed by DISTINCT). Ties on ``order_col`` are broken by the values
    themselves, so the result is deterministic."""
    rec = F.struct(F.col(order_col).alias("_o"), *[F.col(v) for v in values])
    best = df.groupBy(*keys).agg(F.max(rec).alias("_best"))
    return best.select(*keys, *[F.col("_best").getField(v).alias(v) for v in values])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str,
                   values: Sequence[str], require_col: str,
                   passthrough: Sequence[str] = ()) -> DataFrame:
    """Latest usable record per key (M1).

    Output columns: ``values..., keys..., passthrough...``; one row per
    (key, distinct pass-through value among the kept rows). Groups of more
    than one row without any non-null ``require_col`` vanish; single-row
    groups stay even when ``require_col`` is NULL.
    """
    keys, values, passthrough = list(keys), list(values), list(passthrough)
    rec = F.struct(F.col(order_col).alias("_o"), *[F.col(v) for v in values])
    usable = F.col(require_col).isNotNull()
    level = keys + passthrough
    # Stage 1: one row per (key, pass-through): row count, latest usable
    # record, latest record. Partial aggregation runs before the shuffle.
    g = df.groupBy(*level).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(usable, rec)).alias("_best_nn"),
        F.max(rec).alias("_best_any"),
    )
    if passthrough:
        # Stage 2: combine the (few) pass-through rows of each key. The
        # window input is already reduced to one row per (key, value).
        w = Window.partitionBy(*keys)
        g = g.select(
            *level, "_best_nn",
            F.sum("_n").over(w).alias("_cnt"),
            F.max("_best_nn").over(w).alias("_grp_nn"),
            F.max("_best_any").over(w).alias("_grp_any"),
        )
        single = F.col("_cnt") == 1
        winner = F.when(single, F.col("_grp_any")).otherwise(F.col("_grp_nn"))
    else:
        single = F.col("_n") == 1
        winner = F.when(single, F.col("_best_any")).otherwise(F.col("_best_nn"))
    kept = g.where(single | F.col("_best_nn").isNotNull())
    return kept.select(*[winner.getField(v).alias(v) for v in values],
                       *keys, *passthrough)


GUIDE_VALUES = ("name", "code65")


def dedupe_guide_by_model(guide: DataFrame, divisions: Sequence[str] | None,
                          by_division: bool = False) -> DataFrame:
    """Guide keyed by (factory_model, manufacturer) — v2 — with division passed
    through (one row per division among kept rows), or keyed by
    (factory_model, manufacturer, division) — interim. ``divisions`` limits
    the guide before counting (v2); ``None`` keeps all rows (interim)."""
    src = guide if divisions is None else guide.where(F.col("division").isin(list(divisions)))
    if by_division:
        return latest_per_key(src, ["factory_model", "manufacturer", "division"],
                              "guide_id", GUIDE_VALUES, "code65")
    return latest_per_key(src, ["factory_model", "manufacturer"], "guide_id",
                          GUIDE_VALUES, "code65", passthrough=["division"])


def dedupe_guide_by_name(guide: DataFrame) -> DataFrame:
    """Latest code per guide name: columns (code65, name), unique per name."""
    return latest_per_key(guide, ["name"], "guide_id", ["code65"], "code65")
