"""Rule-driven product classification (kit vs assembled vehicle)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from martcraft.rules import Rules


def product_type(rules: Rules, name: str = "internal_code", vin: str = "vin",
                 direction: str = "sales_direction",
                 with_direction_rule: bool = True) -> Column:
    """``CASE WHEN name ILIKE p1 OR ... OR vin ILIKE v [OR (name ILIKE q AND
    direction = d)] THEN kit ELSE vehicle END``.

    A NULL name or VIN makes its test NULL, which falls through to the ELSE
    branch exactly as in SQL."""
    tests = [F.col(name).ilike(p) for p in rules.kit_name_patterns]
    tests.append(F.col(vin).ilike(rules.kit_vin_pattern))
    if with_direction_rule and rules.kit_name_direction_rule is not None:
        pat, d = rules.kit_name_direction_rule
        tests.append(F.col(name).ilike(pat) & (F.col(direction) == F.lit(d)))
    is_kit = reduce(lambda a, b: a | b, tests)
    return F.when(is_kit, F.lit(rules.label_kit)).otherwise(F.lit(rules.label_vehicle))
