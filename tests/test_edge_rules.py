"""Edge rows for the semantic traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martcraft.functions.classify import product_type
from martcraft.operators import calendar as C
from martcraft.operators import checks as K
from martcraft.operators import dedupe as D
from martcraft.operators import match as MT
from martcraft.operators import rollup as RU
from martcraft.rules import FIXTURE, PRODUCTION

GUIDE = "guide_id long, name string, code65 string, factory_model string, manufacturer string, division string"
KIT = ("month date, division string, counterparty string, drawing_no string, "
       "assembly_variant string, sales_direction string, sold_qty long")
UNION = ("month date, division string, internal_code string, code65 string, "
         "assembly_variant string, sales_direction string, sold_qty long")
UNIT = list(RU.KIT_UNIT)
D1, D2, D3 = dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 3, 1)


def _nat(t):
    return tuple((v is None, v if v is not None else "") for v in t)


def srt(expected):
    return sorted(expected, key=_nat)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_nat)


def test_t1_groups_without_code_vanish_singletons_stay(spark):
    g = spark.createDataFrame([
        (1, "z", None, "m", "b", "LCV"), (2, "z", None, "m", "b", "LCV"),
        (3, "y", None, "m", "b", "LCV")], GUIDE)
    out = D.dedupe_guide_by_name(g)
    assert rows(out, "name", "code65") == srt([("y", None)])


def test_latest_usable_record_wins(spark):
    g = spark.createDataFrame([
        (1, "n1", "C1", "M", "B", "LCV"), (5, "n5", None, "M", "B", "LCV"),
        (3, "n3", "C3", "M", "B", "LCV")], GUIDE)
    out = D.dedupe_guide_by_model(g, ["LCV"])
    # row 5 has no code -> filtered before FIRST_VALUE; latest usable is 3
    assert rows(out, "name", "code65", "division") == srt([("n3", "C3", "LCV")])


def test_t3_division_fan_out(spark):
    g = spark.createDataFrame([
        (1, "a", "C1", "M", "B", "LCV"), (2, "b", "C2", "M", "B", "BUS"),
        (3, "c", "C3", "M", "B", "OTHER")], GUIDE)
    out = D.dedupe_guide_by_model(g, ["LCV", "MCV", "BUS"])
    assert rows(out, "name", "code65", "division") == srt([("b", "C2", "BUS"), ("b", "C2", "LCV")])


def test_null_keys_form_one_group(spark):
    g = spark.createDataFrame([
        (1, "a", "C1", None, "B", "LCV"), (2, "b", "C2", None, "B", "LCV")], GUIDE)
    out = D.dedupe_guide_by_model(g, ["LCV"])
    assert rows(out, "name", "factory_model") == srt([("b", None)])
    sizes = D.group_size(g, ["factory_model", "manufacturer"])
    assert sorted(r["cnt"] for r in sizes.collect()) == [2, 2]


def _kit(spark, data):
    return spark.createDataFrame([(D1, None, cp, dr, "F", "O", q) for cp, dr, q in data], KIT)


def test_t18_homoglyph_variants_match_once_each(spark):
    nom = spark.createDataFrame([(1, "x", "А21-1", "MOD", "Brand#1", "LCV")], GUIDE).drop("guide_id")
    facts = _kit(spark, [("Brand#1", "A21-001", 1), ("Brand#1", "А21-001", 2),
                         ("Brand#1", "MOD", 4), ("Brand#2", "MOD", 8)])
    out = MT.match_guide(facts, nom, FIXTURE)
    got = rows(out, "drawing_no", "sold_qty", "m_internal_code")
    assert got == srt([("A21-001", 1, "x"), ("MOD", 4, "x"), ("MOD", 8, None), ("А21-001", 2, "x")])


def test_or_semantics_one_row_per_guide_row(spark):
    # model and code both match the same guide row: still one output row
    nom = spark.createDataFrame([(1, "x", "A1-1", "A1-1", "B", "LCV")], GUIDE).drop("guide_id")
    facts = _kit(spark, [("B", "A1-1", 3)])
    assert MT.match_guide(facts, nom, FIXTURE).count() == 1


def test_t4_fallback_fires_on_null_model_match(spark):
    nom = spark.createDataFrame([
        (1, None, "C9-1", None, "Brand#3", "LCV"),      # code-only match, NULL model, NULL name
        (2, "f1", "C9-1", "x1", "Brand#7", "MCV"),       # fallback maker hits
        (3, "f2", "Q", "C9-001", "Brand#77", "BUS"),
    ], GUIDE).drop("guide_id")
    facts = _kit(spark, [("Brand#3", "C9-001", 10)])
    out = MT.match_guide(facts, nom, FIXTURE)
    got = rows(out, "sold_qty", "m_division", "m_internal_code", "m_code65")
    # two fallback hits -> row doubled; division/code from the first match,
    # name (NULL in the first match) from the fallback
    assert got == srt([(10, "LCV", "f1", "C9-1"), (10, "LCV", "f2", "C9-1")])


def test_unmatched_uses_fallback_even_with_null_counterparty(spark):
    nom = spark.createDataFrame([(2, "f1", None, "D1", "Brand#7", "MCV")], GUIDE).drop("guide_id")
    facts = _kit(spark, [(None, "D1", 5), (None, None, 6)])
    got = rows(MT.match_guide(facts, nom, FIXTURE), "sold_qty", "m_internal_code")
    assert got == srt([(5, "f1"), (6, None)])


def test_t2_v1_blank_drawing_matches_blank_model(spark):
    g = spark.createDataFrame([
        (1, "k", "С5-1", "", "Brand #7", "LCV"),
        (2, "k2", "С5-1", "", "Brand#7", "LCV")], GUIDE)
    facts = _kit(spark, [("x", "", 1), ("x", "C5-001", 2)])
    got = rows(MT.match_v1(facts, g, FIXTURE), "drawing_no", "m_internal_code")
    # '' = '' matches both rows (guard covers only the last alternative);
    # 'C5-1' is the Cyrillic-С variant, which the blank-model guard disables
    assert got == srt([("", "k"), ("", "k2"), ("C5-001", None)])


def test_t17_v1_guide_duplicates_multiply(spark):
    g = spark.createDataFrame([(1, "k", None, "M", "BRAND#7", "LCV"),
                               (2, "k", None, "M", "BRAND#7", "LCV")], GUIDE)
    facts = _kit(spark, [("x", "M", 4)])
    assert rows(MT.match_v1(facts, g, FIXTURE), "sold_qty") == srt([(4,), (4,)])


def _union(spark, data):
    return spark.createDataFrame(data, UNION)


def test_t6_t8_duplicates_share_month_total(spark):
    u = _union(spark, [(D1, "d", "i", "c", "v", "s", 10), (D1, "d", "i", "c", "v", "s", 5)])
    out = C.densify_cumulative(u, UNIT, UNIT, "sold_qty", D1, D1)
    assert rows(out, "sold_qty", "cumulative_qty") == srt([(5, 15), (10, 15)])
    sparse = C.cumulative_sparse(u, UNIT, "sold_qty")
    assert rows(sparse, "cumulative_qty") == srt([(15,), (15,)])


def test_t12_carry_forward_with_null_measure(spark):
    u = _union(spark, [(D1, "d", "i", "c", "v", "s", 7)])
    out = C.densify_cumulative(u, UNIT, UNIT, "sold_qty", D1, dt.date(2020, 3, 15))
    assert rows(out, "month", "sold_qty", "cumulative_qty") == srt([
        (D1, 7, 7), (D2, None, 7), (D3, None, 7)])


def test_t5_null_key_parts_do_not_collide(spark):
    u = _union(spark, [(D1, None, "a", "c", "v", "s", 1), (D2, "a", None, "c", "v", "s", 2)])
    out = C.densify_cumulative(u, UNIT, UNIT, "sold_qty", D1, D2)
    assert rows(out, "division", "internal_code", "month", "sold_qty", "cumulative_qty") == srt([
        (None, "a", D1, 1, 1), (None, "a", D2, None, 1), ("a", None, D2, 2, 2)])
    grid = C.month_unit_grid(u.select(*UNIT).distinct(), D1, D2)
    joined = C.grid_join(grid, u, UNIT, "sold_qty")
    assert joined.where(F.col("sold_qty").isNotNull()).count() == 2


def test_t7_partition_wider_than_unit(spark):
    schema = UNION + ", product_type string"
    u = spark.createDataFrame([(D1, "d", "i", "c", "v", "s", 5, "kit"),
                               (D3, "d", "i", "c", "v", "s", 7, "veh")], schema)
    out = C.densify_cumulative(u, UNIT + ["product_type"], UNIT, "sold_qty", D1, D3)
    got = rows(out, "product_type", "month", "sold_qty", "cumulative_qty")
    assert got == srt([("kit", D1, 5, 5), ("kit", D2, None, 5), ("kit", D3, None, 12),
                   ("veh", D1, None, 5), ("veh", D2, None, 5), ("veh", D3, 7, 12)])


def test_t7_unit_with_only_out_of_calendar_rows(spark):
    schema = UNION + ", product_type string"
    u = spark.createDataFrame([(dt.date(2019, 5, 1), "d", "i", "c", "v", "s", 5, "kit"),
                               (D2, "d", "i", "c", "v", "s", 7, "veh")], schema)
    out = C.densify_cumulative(u, UNIT + ["product_type"], UNIT, "sold_qty", D1, D3)
    got = rows(out, "product_type", "month", "sold_qty", "cumulative_qty")
    assert got == srt([("kit", D2, None, 7), ("kit", D3, None, 7),
                   ("veh", D2, 7, 7), ("veh", D3, None, 7)])


def test_t10_t11_off_calendar_rows_dropped_and_not_counted(spark):
    u = _union(spark, [(dt.date(2019, 12, 1), "d", "i", "c", "v", "s", 100),   # before start
                       (dt.date(2020, 2, 15), "d", "i", "c", "v", "s", 50),    # not a month start
                       (D3, "d", "i", "c", "v", "s", 1)])
    out = C.densify_cumulative(u, UNIT, UNIT, "sold_qty", D1, D3)
    assert rows(out, "month", "sold_qty", "cumulative_qty") == srt([(D3, 1, 1)])


def test_leading_null_measure_rows_dropped(spark):
    u = _union(spark, [(D1, "d", "i", "c", "v", "s", None), (D3, "d", "i", "c", "v", "s", 4)])
    out = C.densify_cumulative(u, UNIT, UNIT, "sold_qty", D1, D3)
    assert rows(out, "month", "sold_qty", "cumulative_qty") == srt([(D3, 4, 4)])


def test_t14_empty_year_records_null(spark):
    u = _union(spark, [(D1, "d", "i", "c", "v", "s", 3)])
    row = K.check_target(u, "m", 1990, 5712).collect()[0]
    assert row["check_name"] is None and row["check_result"] is None
    row = K.check_target(u, "m", 2020, 3).collect()[0]
    assert row["check_name"] == "comparison_with_target: 3=3" and row["check_result"] is True
    row = K.check_target(u, "m", 2020, 5712).collect()[0]
    assert row["check_name"] == "comparison_with_target: 5712=3" and row["check_result"] is False


def test_classification_production_rules(spark):
    df = spark.createDataFrame([
        ("ГАЗель СемАЗ", "X1", "РФ"), ("Some HDC van", "X2", "РФ"), ("plain", "nvb123", "РФ"),
        ("Авто С42А43", "X3", "СНГ-Азербайджан"), ("Авто С42А43", "X4", "РФ"),
        ("HYUNDAI", "X5", "РФ"), (None, None, None)],
        "internal_code string, vin string, sales_direction string")
    out = df.select(product_type(PRODUCTION).alias("t")).collect()
    kit, veh = PRODUCTION.label_kit, PRODUCTION.label_vehicle
    assert [r["t"] for r in out] == [kit, kit, kit, kit, veh, veh, veh]
    basic = df.select(product_type(PRODUCTION, with_direction_rule=False).alias("t")).collect()
    assert [r["t"] for r in basic][3] == veh


@pytest.mark.parametrize("code,drawing,expect", [
    ("А21-1", "A21-001", True), ("С7-X", "C7-00X", True), ("A1-1", "A1-001", True),
    ("А21-1", "A21-0001", False)])
def test_normalisation_pairs(spark, code, drawing, expect):
    nom = spark.createDataFrame([(1, "x", code, "zz", "B", "LCV")], GUIDE).drop("guide_id")
    facts = _kit(spark, [("B", drawing, 1)])
    got = MT.match_guide(facts, nom, FIXTURE).collect()[0]["m_internal_code"]
    assert (got == "x") is expect


def test_calendar_months_equals_daily_series_truncated(spark):
    start, as_of = dt.date(1996, 1, 1), dt.date(2001, 12, 31)
    got = [r["month"] for r in C.calendar_months(spark, start, as_of).collect()]
    days = (as_of - start).days
    daily = sorted({(start + dt.timedelta(d)).replace(day=1) for d in range(days + 1)})
    assert got == daily and len(got) == 72
    # the current, partial month is part of the calendar
    part = [r["month"] for r in C.calendar_months(spark, "2020-01-15", dt.date(2020, 3, 2)).collect()]
    assert part == [D1, D2, D3]


def test_month_and_year_predicates_on_timestamps(spark):
    from martcraft.functions.dates import month_in, year_is
    df = spark.createDataFrame(
        [(dt.datetime(1996, 7, 31, 23, 59),), (dt.datetime(1996, 8, 1, 0, 0),),
         (dt.datetime(1997, 1, 1, 0, 0),)], "ts timestamp_ntz")
    got = df.where(month_in("ts", [dt.date(1996, 7, 15)], "timestamp_ntz")).count()
    assert got == 1
    assert df.where(year_is("ts", 1996, "timestamp_ntz")).count() == 2


def test_reconcile_keeps_decimals(spark):
    left = spark.createDataFrame([(D1, "1.60"), (D2, "1.60")], "month date, q string").selectExpr("month", "cast(q as decimal(18,2)) q")
    right = spark.createDataFrame([(D3, "3.20")], "month date, q string").selectExpr("month", "cast(q as decimal(18,2)) q")
    row = K.reconcile(left, "q", "month", right, "q", "month", 2020).collect()[0]
    assert row["equal"] and str(row["left_total"]) == "3.20" and row["difference"] == 0
    whole = K.reconcile(left, "q", "month", right.selectExpr("month", "cast(4 as bigint) q"), "q", "month", 2020).collect()[0]
    assert not whole["equal"] and float(whole["difference"]) == -0.8


def test_many_off_calendar_rows_of_one_unit(spark):
    """They are dropped before the shuffle and counted; a unit with nothing
    else keeps its partition's series."""
    from pyspark.sql import Observation
    unit = ("d", "i", "c", "v", "s")
    data = [(D1, *unit, 5)] + [(dt.date(2020, 1, 2 + i % 27), *unit, 1) for i in range(500)] + [(dt.date(2019, 5, 1), "x", "i", "c", "v", "s", 3)]
    u = spark.createDataFrame(data, UNION)
    seen = Observation()
    out = C.densify_cumulative(u, UNIT, UNIT, "sold_qty", D1, D3, dropped=seen)
    assert rows(out, "month", "sold_qty", "cumulative_qty") == srt([(D1, 5, 5), (D2, None, 5), (D3, None, 5)])
    assert seen.get["off_calendar_rows"] == 501
    before_shuffle = out._jdf.queryExecution().optimizedPlan().toString()
    assert before_shuffle.index("RepartitionByExpression") < before_shuffle.index("Filter")
