"""Business literals as data.

Every literal the marts depend on lives here, so that a mart builder never
hard-codes a constant. ``PRODUCTION`` carries the values the original marts
use; ``FIXTURE`` swaps them for values that exist in the synthetic test tables
(see FIXTURES.md, "Literal substitutions").
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# These must equal the original marts' literals, unchanged,
# for the results to be the same.
# ---------------------------------------------------------------------------
KIT_NAME_PATTERNS = ("%СемАЗ%", "%Hazar%", "%Daewoo%", "%HDC%", "%GAZ Cuba%")
KIT_VIN_PATTERN = "NVB%"
KIT_NAME_DIRECTION_RULE = ("%С42А43%", "СНГ-Азербайджан")
LABEL_KIT = "Автокомплекты"
LABEL_VEHICLE = "Собранные ТС"
GUIDE_DIVISIONS = ("LCV", "MCV", "BUS")
FALLBACK_MAKER_PATTERN = "%ГАЗ ПАО%"
V1_MAKER = "ГАЗПАО"
V1_EXCLUDED_NAME = "Комплект автомобил"
PATCH_MONTHS = ("2022-07-01", "2022-10-01", "2022-12-01", "2023-02-01", "2023-03-01")
PATCH_DIVISION = "LCV"
PATCH_DIRECTION = "СНГ-Казахстан"
CALENDAR_START = "2016-01-01"
CHECK_YEAR = 2021
CHECK_TARGET = 5712
CHECK_NAME_PREFIX = "comparison_with_target:"
EXPORT_EXCLUDE_PATTERN = "РФ-%"
# Drawing numbers lose every "-00" (replaced by "-"); guide codes get one
# leading Cyrillic letter swapped for its Latin look-alike, one letter per
# alternative: Cyrillic А (U+0410) -> Latin A, Cyrillic С (U+0421) -> Latin C.
DRAWING_REPLACE = ("-00", "-")
CODE_HOMOGLYPHS = (("^А", "A"), ("^С", "C"))
# ---------------------------------------------------------------------------


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


@dataclass(frozen=True)
class Rules:
    """Parameters of the marts. Defaults are the production values."""

    kit_name_patterns: tuple[str, ...] = KIT_NAME_PATTERNS
    kit_vin_pattern: str = KIT_VIN_PATTERN
    kit_name_direction_rule: tuple[str, str] | None = KIT_NAME_DIRECTION_RULE
    label_kit: str = LABEL_KIT
    label_vehicle: str = LABEL_VEHICLE
    guide_divisions: tuple[str, ...] = GUIDE_DIVISIONS
    fallback_maker_pattern: str = FALLBACK_MAKER_PATTERN
    v1_maker: str = V1_MAKER
    v1_excluded_name: str = V1_EXCLUDED_NAME
    patch_months: tuple[dt.date, ...] = field(
        default_factory=lambda: tuple(_date(m) for m in PATCH_MONTHS))
    patch_division: str = PATCH_DIVISION
    patch_direction: str = PATCH_DIRECTION
    calendar_start: dt.date = field(default_factory=lambda: _date(CALENDAR_START))
    # None means "today" (the reference evaluates NOW() at run time).
    as_of: dt.date | None = None
    check_year: int = CHECK_YEAR
    check_target: int = CHECK_TARGET
    check_name_prefix: str = CHECK_NAME_PREFIX
    export_exclude_pattern: str = EXPORT_EXCLUDE_PATTERN
    drawing_replace: tuple[str, str] = DRAWING_REPLACE
    code_homoglyphs: tuple[tuple[str, str], ...] = CODE_HOMOGLYPHS

    def with_(self, **kw) -> "Rules":
        return replace(self, **kw)


PRODUCTION = Rules()

# Values that exist in the synthetic tables (FIXTURES.md); structure and
# semantics are unchanged, only the literals differ.
FIXTURE = Rules(
    kit_name_patterns=("%WIDGET%",),
    kit_vin_pattern="1-%",
    kit_name_direction_rule=("%bolt%", "F"),
    fallback_maker_pattern="%brand#7%",
    v1_maker="BRAND#7",
    v1_excluded_name="red widget",
    patch_months=tuple(_date(m) for m in (
        "1996-07-01", "1996-10-01", "1996-12-01", "1997-02-01", "1997-03-01")),
    patch_division="ASIA",
    patch_direction="1-URGENT",
    calendar_start=_date("1996-01-01"),
    as_of=_date("2001-12-31"),
    check_year=1997,
    check_target=262309,
    export_exclude_pattern="F%",
)

# Timestamp written into check rows by the registered fixture queries, so that
# the check row is reproducible (production uses the wall clock).
FIXTURE_CHECKED_AT = dt.datetime(2001, 12, 31, 6, 0, 0)
