"""Column expressions (pure ``pyspark.sql.functions`` compositions, JVM-side)."""

from martcraft.functions.classify import product_type
from martcraft.functions.codes import (
    code_variants,
    normalize_drawing,
    normalize_maker,
)
from martcraft.functions.dates import (
    dtype_of,
    month_in,
    month_start,
    months_between_inclusive,
    year_is,
)
from martcraft.functions.nullsafe import nullsafe_on

__all__ = [
    "code_variants",
    "dtype_of",
    "month_in",
    "month_start",
    "months_between_inclusive",
    "normalize_drawing",
    "normalize_maker",
    "nullsafe_on",
    "product_type",
    "year_is",
]
