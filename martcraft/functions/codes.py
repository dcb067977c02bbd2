"""Normalisation of product codes used by the guide match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martcraft.rules import CODE_HOMOGLYPHS, DRAWING_REPLACE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_drawing(c, replace: tuple[str, str] = DRAWING_REPLACE) -> Column:
    """Drawing number with every ``-00`` written as ``-`` (all occurrences)."""
    return F.replace(_col(c), F.lit(replace[0]), F.lit(replace[1]))


def code_variants(c, homoglyphs=CODE_HOMOGLYPHS) -> list[Column]:
    """One alternative per homoglyph rule: the code with its leading look-alike
    letter latinised. A code that starts with neither letter yields itself in
    every alternative (callers de-duplicate)."""
    return [F.regexp_replace(_col(c), pat, rep) for pat, rep in homoglyphs]


def normalize_maker(c) -> Column:
    """Maker name without spaces, upper-cased (v1 maker test)."""
    return F.upper(F.replace(_col(c), F.lit(" "), F.lit("")))
