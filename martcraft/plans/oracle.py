"""Independent SQL oracle (DuckDB dialect).

The expected result of every registered query, stated from the rules and in
another form than the Spark plans: the guide's newest usable record is ranked
with ROW_NUMBER and joined back, a match is one UNION of three equality
matches, months come from a month series, and running totals are sums over a
range join of monthly sums (no window). Agreement therefore tests the rules,
not a shared formulation.

``kit_sales v1``'s total for the check year is ``CHECK_TARGET_V1``.
"""

from __future__ import annotations

from collections.abc import Iterable

from martcraft.rules import FIXTURE, FIXTURE_CHECKED_AT, Rules

R = FIXTURE
Steps = list[tuple[str, str]]

#: kit_sales v1 total of the fixture check year at sf0.01.
CHECK_TARGET_V1 = 395907


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_MODEL = ("CASE WHEN p_partkey % 97 = 0 THEN NULL WHEN p_partkey % 89 = 0 THEN '' "
          "ELSE p_type || '-' || CAST(p_size % 5 AS VARCHAR) END")

# The fixture inputs of FIXTURES.md, part B.
FIXTURE_STEPS: Steps = [
    ("guide", f"""
    SELECT p_partkey AS guide_id, p_name AS name,
           CASE WHEN p_partkey % 3 = 0 OR p_name LIKE 'hot%' THEN NULL
                ELSE (CASE WHEN p_partkey % 2 = 0 THEN 'А' ELSE 'С' END)
                     || CAST(p_size AS VARCHAR) || '-' || p_type END AS code65,
           {_MODEL} AS factory_model,
           p_brand AS manufacturer,
           CASE p_size % 4 WHEN 0 THEN 'LCV' WHEN 1 THEN 'MCV' WHEN 2 THEN 'BUS'
                ELSE 'OTHER' END AS division
    FROM part"""),
    ("kit_sales", f"""
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
           CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE 'ASIA' END AS division,
           CASE WHEN l_suppkey % 2 = 0 THEN p_brand ELSE 'Brand#99' END AS counterparty,
           CASE WHEN l_linenumber % 2 = 0 THEN {_MODEL}
                ELSE (CASE WHEN p_partkey % 2 = 0 THEN 'A' ELSE 'C' END)
                     || CAST(p_size AS VARCHAR) || '-00' || p_type END AS drawing_no,
           l_linestatus AS assembly_variant,
           o_orderstatus AS sales_direction,
           CAST(l_quantity AS BIGINT) AS sold_qty
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""),
    ("retail", """
    SELECT l_shipdate AS period, r_name AS division, p_name AS internal_code,
           l_linestatus AS assembly_variant, o_orderstatus AS sales_direction,
           o_orderpriority AS vin, o_custkey AS dealer_id,
           CAST(l_quantity AS BIGINT) AS retail_qty,
           CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_linenumber AS BIGINT) END AS opening_stock,
           CAST(l_linenumber AS BIGINT) AS closing_stock
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey"""),
    ("realization", """
    SELECT l_shipdate AS period, l_partkey AS product_id,
           CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS direction_id,
           CAST(l_quantity AS BIGINT) AS qty
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    ("product", """
    SELECT p_partkey AS id, p_name AS product_name, p_brand AS code65,
           p_type AS assembly_variant, CAST(p_size % 5 AS BIGINT) AS division_id
    FROM part"""),
    ("direction", """
    SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id,
           o_orderpriority AS sales_direction
    FROM orders"""),
    ("division", "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name FROM region"),
    ("dealer", "SELECT c_custkey AS id, c_mktsegment AS division FROM customer"),
]


def statement(steps: Steps, final: str, base: Steps | None = None) -> str:
    every = (FIXTURE_STEPS if base is None else base) + steps
    return "WITH " + ",\n".join(f"{name} AS ({body}\n)" for name, body in every) + f"\n{final}"


def same(a: str, b: str, cols: Iterable[str]) -> str:
    return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)


def listed(cols: Iterable[str], of: str = "") -> str:
    return ", ".join(f"{of}.{c}" if of else c for c in cols)


def first_day(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


# --- guide -----------------------------------------------------------------------

def newest_usable(out: str, key: list[str], also: list[str], taken: list[str], where: str = "TRUE") -> Steps:
    """A record is usable with a code, or if its key has no other record. Per
    key (and per value of ``also`` among its usable records) one row, with
    ``taken`` from the newest usable record of the key."""
    return [
        (f"{out}_records", f"SELECT * FROM guide WHERE {where}"),
        (f"{out}_alone", f"SELECT {listed(key)} FROM {out}_records GROUP BY {listed(key)} HAVING COUNT(*) = 1"),
        (f"{out}_usable", f"""
    SELECT g.* FROM {out}_records g
    WHERE g.code65 IS NOT NULL OR EXISTS (SELECT 1 FROM {out}_alone a WHERE {same('a', 'g', key)})"""),
        (f"{out}_ranked", f"""
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {listed(key)} ORDER BY guide_id DESC) AS age FROM {out}_usable"""),
        (f"{out}_kinds", f"SELECT {listed(key + also)} FROM {out}_usable GROUP BY {listed(key + also)}"),
        (out, f"""
    SELECT {listed(taken, 'r')}, {listed(key + also, 'k')}
    FROM {out}_kinds k JOIN {out}_ranked r ON r.age = 1 AND {same('k', 'r', key)}"""),
    ]


def guide_by_model(r: Rules = R) -> Steps:
    wanted = ", ".join(lit(d) for d in r.guide_divisions)
    return newest_usable("models", ["factory_model", "manufacturer"], ["division"], ["name", "code65"], f"division IN ({wanted})")


def guide_by_model_division() -> Steps:
    return newest_usable("models", ["factory_model", "manufacturer", "division"], [], ["name", "code65"])


def guide_by_name() -> Steps:
    return newest_usable("codes", ["name"], [], ["code65"])


# --- matching ----------------------------------------------------------------------

def short_drawing(c: str, r: Rules) -> str:
    return f"replace({c}, {lit(r.drawing_replace[0])}, {lit(r.drawing_replace[1])})"


def swapped_code(c: str, k: int, r: Rules) -> str:
    pattern, letter = r.code_homoglyphs[k]
    return f"regexp_replace({c}, {lit(pattern)}, {lit(letter)})"


def three_ways(cols: str, keys: str, guide: str, extra: str, r: Rules, last: str = "TRUE") -> str:
    """Guide rows that agree with a drawing in any of three ways; UNION keeps
    each once."""
    ways = [("k.drawing_no = g.factory_model", "TRUE")] + [
        (f"{short_drawing('k.drawing_no', r)} = {swapped_code('g.code65', k, r)}", "TRUE" if k == 0 else last) for k in (0, 1)]
    return "\n    UNION\n    ".join(
        f"SELECT {cols} FROM {keys} k JOIN {guide} g ON {on} WHERE {extra} AND {guard}" for on, guard in ways)


def two_attempts(r: Rules = R) -> Steps:
    """matched: every kit line with its first match, else (no match, or one
    without a model) with those of the fallback makers."""
    cols = "k.counterparty, k.drawing_no, g.name, g.code65, g.factory_model, g.manufacturer, g.division"
    return [
        ("drawn", "SELECT DISTINCT counterparty, drawing_no FROM kit_sales"),
        ("own_maker", three_ways(cols, "drawn", "models", "g.manufacturer = k.counterparty", r)),
        ("stand_in", three_ways("k.drawing_no, g.name, g.code65, g.factory_model, g.manufacturer, g.division", "drawn", "models",
                                f"g.manufacturer ILIKE {lit(r.fallback_maker_pattern)}", r)),
        ("attempted", """
    SELECT s.*, o.name AS o_name, o.code65 AS o_code, o.factory_model AS o_model, o.division AS o_division
    FROM kit_sales s LEFT JOIN own_maker o ON o.counterparty = s.counterparty AND o.drawing_no = s.drawing_no"""),
        ("matched", """
    SELECT a.month, o_division AS division, o_name AS internal_code, o_code AS code65,
           a.assembly_variant, a.sold_qty, a.sales_direction
    FROM attempted a WHERE o_model IS NOT NULL
    UNION ALL
    SELECT a.month, COALESCE(o_division, f.division), COALESCE(o_name, f.name), COALESCE(o_code, f.code65),
           a.assembly_variant, a.sold_qty, a.sales_direction
    FROM attempted a LEFT JOIN stand_in f ON f.drawing_no = a.drawing_no WHERE o_model IS NULL"""),
    ]


def one_maker(r: Rules = R) -> Steps:
    """matched_v1: kit lines with the raw guide rows of the one maker."""
    return [
        ("drawn", "SELECT DISTINCT drawing_no FROM kit_sales"),
        ("maker_rows", f"""
    SELECT * FROM guide
    WHERE upper(replace(manufacturer, ' ', '')) = {lit(r.v1_maker)} AND name <> {lit(r.v1_excluded_name)}"""),
        ("agreeing", three_ways("k.drawing_no, g.guide_id, g.name, g.code65, g.division", "drawn", "maker_rows", "TRUE", r,
                                last="g.factory_model <> ''")),
        ("matched_v1", """
    SELECT s.month, COALESCE(s.division, a.division) AS division, a.name AS internal_code, a.code65,
           s.assembly_variant, s.sold_qty, s.sales_direction
    FROM kit_sales s LEFT JOIN agreeing a ON a.drawing_no = s.drawing_no"""),
    ]


# --- sums ----------------------------------------------------------------------------

KIT_UNIT = ["division", "internal_code", "code65", "assembly_variant", "sales_direction"]
RETAIL_UNIT = ["division", "internal_code", "code65", "assembly_variant", "sales_direction"]


def summed(out: str, src: str, by: list[str], measures: list[str]) -> Steps:
    sums = ", ".join(f"CAST(SUM({m}) AS BIGINT) AS {m}" for m in measures)
    return [(out, f"SELECT {listed(by)}, {sums} FROM {src} GROUP BY {listed(by)}")]


def kit_monthly(src: str, out: str) -> Steps:
    return summed(out, src, ["month", *KIT_UNIT], ["sold_qty"])


def supplement(r: Rules = R) -> Steps:
    """Realization of the listed months, one division, one direction."""
    months = ", ".join(f"(DATE '{d.isoformat()}')" for d in r.patch_months)
    return [
        ("listed_months", f"SELECT * FROM (VALUES {months}) v(start)"),
        ("supplement_lines", f"""
    SELECT z.period AS month, v.name AS division, p.product_name AS internal_code, p.code65,
           p.assembly_variant, d.sales_direction, z.qty AS sold_qty
    FROM realization z
    JOIN listed_months m ON z.period >= m.start AND z.period < m.start + INTERVAL 1 MONTH
    JOIN product p ON p.id = z.product_id
    JOIN division v ON v.id = p.division_id AND v.name = {lit(r.patch_division)}
    JOIN direction d ON d.id = z.direction_id AND d.sales_direction = {lit(r.patch_direction)}"""),
    ] + summed("supplement", "supplement_lines", ["month", *KIT_UNIT], ["sold_qty"])


def both(out: str, monthly: str) -> Steps:
    cols = listed(["month", *KIT_UNIT, "sold_qty"])
    return [(out, f"SELECT {cols} FROM {monthly} UNION ALL SELECT {cols} FROM supplement")]


def so_far(out: str, src: str, share: list[str], measure: str) -> Steps:
    """src with the total of its ``share`` group up to and including the
    row's month: a range join over monthly sums."""
    return [
        (f"{out}_sums", f"SELECT {listed(share)}, month, SUM({measure}) AS amount FROM {src} GROUP BY {listed(share)}, month"),
        (f"{out}_totals", f"""
    SELECT {listed(share, 'a')}, a.month, CAST(SUM(b.amount) AS BIGINT) AS total
    FROM {out}_sums a JOIN {out}_sums b ON {same('a', 'b', share)} AND b.month <= a.month
    GROUP BY {listed(share, 'a')}, a.month"""),
        (out, f"""
    SELECT s.*, t.total AS cumulative_qty
    FROM {src} s JOIN {out}_totals t ON t.month = s.month AND {same('s', 't', share)}"""),
    ]


def month_series(start, last) -> Steps:
    return [("months", f"""
    SELECT CAST(unnest(generate_series(date_trunc('month', DATE '{start}'), date_trunc('month', DATE '{last}'),
                                       INTERVAL 1 MONTH)) AS DATE) AS month""")]


def every_month(out: str, src: str, unit: list[str], share: list[str], measure: str, start, last) -> Steps:
    """Each unit of src in each month from the first month with a measure in
    its ``share`` group to the last; own rows where there are any, and the
    group's total so far. Rows of other times count for nothing."""
    return month_series(start, last) + [
        (f"{out}_timely", f"SELECT s.* FROM {src} s WHERE EXISTS (SELECT 1 FROM months m WHERE m.month = s.month)"),
        (f"{out}_begun", f"""
    SELECT {listed(share)}, MIN(month) AS since FROM {out}_timely WHERE {measure} IS NOT NULL GROUP BY {listed(share)}"""),
        (f"{out}_sums", f"SELECT {listed(share)}, month, SUM({measure}) AS amount FROM {out}_timely GROUP BY {listed(share)}, month"),
        (f"{out}_totals", f"""
    SELECT {listed(share, 'b')}, m.month, CAST(SUM(x.amount) AS BIGINT) AS cumulative_qty
    FROM {out}_begun b JOIN months m ON m.month >= b.since
         JOIN {out}_sums x ON {same('b', 'x', share)} AND x.month <= m.month
    GROUP BY {listed(share, 'b')}, m.month"""),
        (f"{out}_owners", f"SELECT {listed(unit)} FROM {src} GROUP BY {listed(unit)}"),
        (out, f"""
    SELECT t.month, {listed(unit, 'o')}, s.{measure}, t.cumulative_qty
    FROM {out}_owners o JOIN {out}_totals t ON {same('o', 't', share)}
         LEFT JOIN {out}_timely s ON s.month = t.month AND {same('s', 'o', unit)}"""),
    ]


# --- product type --------------------------------------------------------------------

def product_type(r: Rules, with_direction_rule: bool) -> str:
    signs = [f"lower(internal_code) LIKE lower({lit(p)})" for p in r.kit_name_patterns]
    signs.append(f"lower(vin) LIKE lower({lit(r.kit_vin_pattern)})")
    if with_direction_rule and r.kit_name_direction_rule is not None:
        name, way = r.kit_name_direction_rule
        signs.append(f"(lower(internal_code) LIKE lower({lit(name)}) AND sales_direction = {lit(way)})")
    return f"if(list_contains([{', '.join(signs)}], TRUE), {lit(r.label_kit)}, {lit(r.label_vehicle)})"


def typed_retail(r: Rules, with_direction_rule: bool, division: str = "s.division") -> Steps:
    """Retail lines by month with product type and the code of their name."""
    return guide_by_name() + [("lines", f"""
    SELECT {first_day('s.period')} AS month, {division} AS division, s.internal_code, c.code65,
           s.assembly_variant, s.sales_direction, {product_type(r, with_direction_rule).replace('internal_code', 's.internal_code')} AS product_type,
           s.retail_qty, s.opening_stock, s.closing_stock
    FROM retail s LEFT JOIN codes c ON c.name = s.internal_code
         LEFT JOIN dealer d ON d.id = s.dealer_id""")]


# --- marts -----------------------------------------------------------------------------

def kit_v2_sources(r: Rules = R) -> Steps:
    return guide_by_model(r) + two_attempts(r) + kit_monthly("matched", "kit_months") + supplement(r) + both("kit_all", "kit_months")


def kit_v2(r: Rules = R) -> Steps:
    return kit_v2_sources(r) + every_month("kit_series", "kit_all", KIT_UNIT, KIT_UNIT, "sold_qty", r.calendar_start, r.as_of)


def kit_v1(r: Rules = R) -> Steps:
    return (one_maker(r) + kit_monthly("matched_v1", "kit_months") + supplement(r) + both("kit_all", "kit_months")
            + so_far("kit_totals", "kit_all", KIT_UNIT, "sold_qty"))


def retail_v2(r: Rules = R) -> Steps:
    unit = [*RETAIL_UNIT, "product_type"]
    return (typed_retail(r, True) + summed("retail_months", "lines", ["month", *unit], ["retail_qty"])
            + every_month("retail_series", "retail_months", unit, RETAIL_UNIT, "retail_qty", r.calendar_start, r.as_of))


def balance_v2(r: Rules = R) -> Steps:
    return typed_retail(r, False) + summed("stock", "lines", ["month", *RETAIL_UNIT, "product_type"], ["opening_stock", "closing_stock"])


def check_row(steps: Steps, mart: str, table: str, target: int, r: Rules) -> str:
    in_year = f"month >= DATE '{r.check_year}-01-01' AND month < DATE '{r.check_year + 1}-01-01'"
    return statement(steps, f"""
SELECT {lit(table)} AS table_name, concat({lit(f'{r.check_name_prefix} {target}=')}, total) AS check_name,
       TIMESTAMP '{FIXTURE_CHECKED_AT.isoformat(sep=" ")}' AS ts, total = {target} AS check_result
FROM (SELECT CAST(SUM(sold_qty) AS BIGINT) AS total FROM {mart} WHERE {in_year})""")


def side_by_side(steps: Steps, left: tuple[str, str, str], right: tuple[str, str, str], year: int, kind: str = "BIGINT") -> str:
    total = lambda t, m, d: f"(SELECT CAST(SUM({m}) AS {kind}) FROM {t} WHERE date_part('year', {d}) = {year})"
    return statement(steps + [("totals", f"SELECT {total(*left)} AS l, {total(*right)} AS r")], f"""
SELECT {year} AS year, l AS left_total, r AS right_total, l - r AS difference, l IS NOT DISTINCT FROM r AS equal
FROM totals""")


def oracle_queries(r: Rules = R) -> dict[str, str]:
    q: dict[str, str] = {}
    wanted = ", ".join(lit(d) for d in r.guide_divisions)

    for name, table in (("scan_retail", "retail"), ("scan_guide", "guide"), ("scan_kit", "kit_sales"), ("scan_realization", "realization")):
        q[name] = statement([], f"FROM {table}")
    q["project_rename"] = statement([], f"""
SELECT {first_day('period')} AS month, division, internal_code, assembly_variant, sales_direction,
       opening_stock AS opening, closing_stock AS closing
FROM retail""")
    q["filter_guide_divisions"] = statement([], f"FROM guide WHERE division IN ({wanted})")
    q["filter_patch_months"] = statement(supplement(r)[:1], """
SELECT z.* FROM realization z JOIN listed_months m ON date_trunc('month', z.period) = m.start""")
    q["normalize_codes"] = statement([], f"""
SELECT guide_id, code65, {swapped_code('code65', 0, r)} AS code65_a, {swapped_code('code65', 1, r)} AS code65_c FROM guide""")
    q["normalize_drawings"] = statement([], f"""
SELECT drawing_no, {short_drawing('drawing_no', r)} AS drawing_norm FROM kit_sales GROUP BY drawing_no""")
    q["normalize_maker"] = statement([], """
SELECT guide_id, manufacturer, upper(replace(manufacturer, ' ', '')) AS maker_norm FROM guide""")
    for name, rule in (("classify_product", True), ("classify_product_basic", False)):
        q[name] = statement([], f"SELECT period, internal_code, vin, sales_direction, {product_type(r, rule)} AS product_type FROM retail")
    q["group_size_window"] = statement([("sizes", """
    SELECT factory_model, manufacturer, COUNT(*) AS cnt FROM guide GROUP BY ALL""")], f"""
SELECT g.guide_id, g.factory_model, g.manufacturer, s.cnt
FROM guide g JOIN sizes s ON {same('g', 's', ['factory_model', 'manufacturer'])}""")
    q["first_value_latest"] = statement([("ranked", """
    SELECT *, ROW_NUMBER() OVER (PARTITION BY factory_model, manufacturer ORDER BY guide_id DESC) AS age FROM guide""")], """
SELECT factory_model, manufacturer, name, code65 FROM ranked WHERE age = 1""")
    q["dedupe_guide_by_model"] = statement(guide_by_model(r), "FROM models")
    q["dedupe_guide_by_model_division"] = statement(guide_by_model_division(), "FROM models")
    q["dedupe_guide_by_name"] = statement(guide_by_name(), "FROM codes")

    q["lookup_code_by_name"] = statement(guide_by_name(), """
SELECT s.period, s.internal_code, s.dealer_id, s.retail_qty, c.code65
FROM retail s LEFT JOIN codes c ON c.name = s.internal_code""")
    q["match_primary"] = statement(guide_by_model(r) + two_attempts(r), """
SELECT month, counterparty, drawing_no, sold_qty, o_name AS n_name, o_code AS n_code65,
       o_model AS n_factory_model, o_division AS n_division
FROM attempted""")
    q["match_with_fallback"] = statement(guide_by_model(r) + two_attempts(r), "FROM matched")
    q["match_v1"] = statement(one_maker(r), "FROM matched_v1")

    q["kit_rollup"] = statement(guide_by_model(r) + two_attempts(r) + kit_monthly("matched", "kit_months"), "FROM kit_months")
    q["kit_rollup_v1"] = statement(one_maker(r) + kit_monthly("matched_v1", "kit_months"), "FROM kit_months")
    q["realization_patch"] = statement(supplement(r), "FROM supplement")
    q["union_sources"] = statement(kit_v2_sources(r), "FROM kit_all")
    q["distinct_units"] = statement(kit_v2_sources(r), f"SELECT {listed(KIT_UNIT)} FROM kit_all GROUP BY {listed(KIT_UNIT)}")
    grid = kit_v2_sources(r) + month_series(r.calendar_start, r.as_of) + [
        ("owners", f"SELECT {listed(KIT_UNIT)} FROM kit_all GROUP BY {listed(KIT_UNIT)}"),
        ("slots", f"SELECT m.month, {listed(KIT_UNIT, 'o')} FROM owners o, months m")]
    q["month_unit_grid"] = statement(grid, "FROM slots")
    q["nullsafe_multikey_join"] = statement(grid, f"""
SELECT t.*, s.sold_qty FROM slots t LEFT JOIN kit_all s ON s.month = t.month AND {same('s', 't', KIT_UNIT)}""")
    q["cumulative_sparse"] = statement(kit_v2_sources(r) + so_far("kit_totals", "kit_all", KIT_UNIT, "sold_qty"), "FROM kit_totals")
    q["densify_cumulative"] = statement(kit_v2(r), "FROM kit_series")
    q["retail_rollup"] = statement(retail_v2(r)[:len(guide_by_name()) + 2], "FROM retail_months")

    kit_label = f"{lit(r.label_kit)} AS product_type"
    q["kit_sales_v1"] = statement(kit_v1(r), "FROM kit_totals")
    q["kit_sales_interim"] = statement(
        guide_by_model_division() + two_attempts(r) + kit_monthly("matched", "kit_months") + supplement(r) + both("kit_all", "kit_months")
        + so_far("kit_totals", "kit_all", KIT_UNIT, "sold_qty"), f"SELECT *, {kit_label} FROM kit_totals")
    q["kit_sales_v2"] = statement(kit_v2(r), f"SELECT *, {kit_label} FROM kit_series")
    plain = ["division", "internal_code", "assembly_variant", "sales_direction"]
    q["retail_sales_v1"] = statement(
        [("lines", f"SELECT *, {first_day('period')} AS month FROM retail")] + summed("retail_months", "lines", ["month", *plain], ["retail_qty"])
        + so_far("retail_totals", "retail_months", plain, "retail_qty"), "FROM retail_totals")
    by_type = ["month", *RETAIL_UNIT, "product_type"]
    q["retail_sales_interim"] = statement(
        typed_retail(r, True, "d.division") + summed("retail_months", "lines", by_type, ["retail_qty"])
        + so_far("retail_totals", "retail_months", RETAIL_UNIT, "retail_qty"), "FROM retail_totals")
    q["retail_sales_v2"] = statement(retail_v2(r), "FROM retail_series")
    stock = ["opening_stock", "closing_stock"]
    q["balance_v1"] = statement([("lines", f"SELECT *, {first_day('period')} AS month FROM retail")]
                                + summed("stock", "lines", ["month", *plain], stock), "FROM stock")
    q["balance_v2"] = statement(balance_v2(r), "FROM stock")
    q["balance_interim"] = statement(typed_retail(r, False, "d.division") + summed("stock", "lines", by_type, stock), "FROM stock")
    q["dealer_division_rollup"] = statement([("lines", f"""
    SELECT {first_day('s.period')} AS month, d.division, s.retail_qty FROM retail s LEFT JOIN dealer d ON d.id = s.dealer_id""")]
                                            + summed("out_rows", "lines", ["month", "division"], ["retail_qty"]), "FROM out_rows")

    q["check_target"] = check_row(kit_v2(r), "kit_series", "kit_sales_v2", r.check_target, r)
    q["check_target_v1"] = check_row(kit_v1(r), "kit_totals", "kit_sales_v1", CHECK_TARGET_V1, r)
    q["reconcile_totals"] = side_by_side(balance_v2(r), ("retail", "closing_stock", "period"), ("stock", "closing_stock", "month"), r.check_year)
    q["reconcile_retail"] = side_by_side(retail_v2(r), ("retail_series", "retail_qty", "month"), ("retail", "retail_qty", "period"), r.check_year)
    amount = "SELECT period, CAST(retail_qty AS DECIMAL(18,2)) * 0.35 AS amount FROM retail"
    q["reconcile_decimal"] = side_by_side([("priced", amount), ("priced_months", f"""
    SELECT {first_day('period')} AS month, SUM(amount) AS amount FROM priced GROUP BY 1""")],
                                          ("priced", "amount", "period"), ("priced_months", "amount", "month"), r.check_year, "DOUBLE")
    q["distinct_export_codes"] = statement(kit_v2(r), f"""
SELECT internal_code FROM kit_series WHERE NOT (sales_direction LIKE {lit(r.export_exclude_pattern)}) GROUP BY internal_code""")

    # what was written last is what is read back; appended rows add up
    q["sink_overwrite_roundtrip"] = q["balance_v2"]
    q["sink_insert_overwrite_roundtrip"] = q["retail_sales_v1"]
    other = r.with_(check_target=r.check_target + 1)
    q["check_append_roundtrip"] = f"({q['check_target']})\nUNION ALL\n({check_row(kit_v2(r), 'kit_series', 'kit_sales_v2', other.check_target, other)})"
    q["run_marts_check"] = q["check_target"]
    q["table_comment"] = f"SELECT 'Finished vehicle stock' AS comment, COUNT(*) AS n FROM ({q['balance_v2']})"
    # kept marts equal those built anew
    q["kit_sales_v2_carried"] = q["kit_sales_v2"]
    q["retail_sales_v2_carried"] = q["retail_sales_v2"]
    q["retail_rollup_kept"] = q["retail_rollup"]
    q["balance_v2_kept"] = q["balance_v2"]
    return q
