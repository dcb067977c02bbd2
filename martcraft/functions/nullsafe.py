"""Null-matching multi-column join conditions.

The original marts join a dense grid back to facts with ``HASH(a, b, ...) =
HASH(a, b, ...)`` so that NULL key parts match each other. Spark's ``hash`` /
``xxhash64`` skip NULL inputs, which makes ``(NULL, 'x')`` and ``('x', NULL)``
collide; the exact equivalent is a conjunction of ``<=>``, which Catalyst
plans as an ordinary equi-join (hash or sort-merge), not a nested loop.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def nullsafe_on(left: DataFrame, right: DataFrame, cols: Sequence[str],
                right_cols: Sequence[str] | None = None) -> Column:
    right_cols = list(right_cols or cols)
    conds = [left[a].eqNullSafe(right[b]) for a, b in zip(cols, right_cols)]
    return reduce(lambda x, y: x & y, conds)
