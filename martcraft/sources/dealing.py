"""Joins of the lines, in as many tasks as their rows ask for.

Where the session's shuffle partitions are few, a sort-merge join of the lines
gives each task a share that grows with the table. So the two sides of a large
join are dealt by their key over a number of partitions that grows instead: a
task holds about ``ROWS_A_TASK`` lines whatever the table. Smaller joins, and
those with a side that Spark may broadcast, are left to the session's settings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS_A_TASK = 1_000_000
SMALL = 8 * ROWS_A_TASK   # lines up to which the join is left as it is
FEW = 2_000_000           # rows of the other side that may be broadcast


def dealt_join(lines: DataFrame, other: DataFrame, key: str, other_key: str, n_lines: int, n_other: int | None = None) -> DataFrame:
    """Inner join of ``lines`` (at most ``n_lines`` rows) and ``other`` (known
    to have ``n_other`` rows, or not known to be small)."""
    on = lines[key] == other[other_key]
    if n_lines <= SMALL or (n_other is not None and n_other <= FEW):
        return lines.join(other, on)
    tasks = max(-(-n_lines // ROWS_A_TASK), lines.sparkSession.sparkContext.defaultParallelism)
    left, right = lines.repartition(tasks, key), other.repartition(tasks, other_key)
    return left.join(right, left[key] == right[other_key])
