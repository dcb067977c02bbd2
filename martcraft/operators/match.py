"""Matching sales lines to the product guide (M2).

A line matches a guide row of its own maker by the model, or by the code with
one of its look-alike letters swapped. Lines whose first match gives no model
try the fallback makers by the same three comparisons. Joined on that
disjunction directly, the plan would be a nested loop (facts x guide).

Here every alternative becomes a row ``(kind, key)`` on both sides, so the
disjunction is a plain equi-join on (maker, kind, key) followed by a DISTINCT
per (fact key, guide row): a guide row matches at most once however many
alternatives agree. The match depends only on (counterparty, drawing_no), so
both attempts and their COALESCE are computed per *distinct* fact key, and the
facts meet the finished match set in one join; fact volume never reaches the
matching joins, and no join in the plan lacks an equi key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.functions.codes import code_variants, normalize_drawing, normalize_maker
from martcraft.operators.hotjoin import HotRules, fan_join, hot_join, key_counts
from martcraft.rules import Rules

CP, DR = "counterparty", "drawing_no"
GUIDE_COLS = ("name", "code65", "factory_model", "manufacturer", "division")


def _alternatives(df: DataFrame, keep: Sequence[str],
                  alts: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row per non-NULL, distinct (kind, key) alternative of each row."""
    arr = F.array_distinct(F.array(*[
        F.struct(F.lit(kind).alias("kind"), key.alias("key")) for kind, key in alts]))
    return (df.select(*keep, F.explode(arr).alias("_alt"))
            .select(*keep, F.col("_alt.kind").alias("kind"), F.col("_alt.key").alias("key"))
            .where(F.col("key").isNotNull()))


def _fact_alternatives(keys: DataFrame, rules: Rules, keep: Sequence[str]) -> DataFrame:
    dr = F.col(DR)
    return _alternatives(keys, keep, [("m", dr), ("c", normalize_drawing(dr, rules.drawing_replace))])


def _guide_alternatives(guide: DataFrame, rules: Rules, keep: Sequence[str],
                        last_variant_guard: Column | None = None) -> DataFrame:
    variants = code_variants(F.col("code65"), rules.code_homoglyphs)
    if last_variant_guard is not None:
        variants[-1] = F.when(last_variant_guard, variants[-1])
    alts = [("m", F.col("factory_model"))] + [("c", v) for v in variants]
    return _alternatives(guide, keep, alts)


def _prefixed(df: DataFrame, prefix: str, cols: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])


def _primary_set(fact_keys: DataFrame, nom: DataFrame, rules: Rules) -> DataFrame:
    """First attempt per distinct (counterparty, drawing_no): same maker, any
    alternative; DISTINCT per guide row gives the OR's "at most once"."""
    gcols = list(GUIDE_COLS)
    fk_alt = _fact_alternatives(fact_keys, rules, [CP, DR])
    g_alt = _prefixed(_guide_alternatives(nom, rules, gcols), "g_", gcols + ["kind", "key"])
    return (fk_alt.join(g_alt, (F.col(CP) == F.col("g_manufacturer"))
                        & (F.col("kind") == F.col("g_kind"))
                        & (F.col("key") == F.col("g_key")))
            .select(F.col(CP).alias("_p_cp"), F.col(DR).alias("_p_dr"),
                    *[F.col("g_" + c).alias("n_" + c) for c in gcols])
            .distinct())


def _fallback_set(drawings: DataFrame, nom: DataFrame, rules: Rules) -> DataFrame:
    """Fallback candidates per distinct drawing: guide rows of the fallback
    makers (pattern match on the maker), any alternative, once per row."""
    gcols = list(GUIDE_COLS)
    fb = nom.where(F.col("manufacturer").ilike(rules.fallback_maker_pattern))
    g_alt = _prefixed(_guide_alternatives(fb, rules, gcols), "g_", gcols + ["kind", "key"])
    dr_alt = _fact_alternatives(drawings, rules, [DR])
    return (dr_alt.join(g_alt, (F.col("kind") == F.col("g_kind")) & (F.col("key") == F.col("g_key")))
            .select(F.col(DR).alias("_f_dr"), *[F.col("g_" + c).alias("f_" + c) for c in gcols])
            .distinct())


def _keys(facts: DataFrame, cols: Sequence[str], staged: bool) -> tuple[DataFrame, DataFrame | None]:
    """The distinct match keys. Raw ``facts`` are counted by key on the way, as
    a stage table, so that the plan of the result reads the fact chain once and
    hot keys are known; ``staged`` facts are a reduction without hot keys."""
    if staged:
        return facts.select(*cols).distinct(), None
    counts = key_counts(facts, cols)
    return counts.select(*cols), counts


def _join_facts(facts: DataFrame, matches: DataFrame, counts: DataFrame | None, hot: HotRules) -> DataFrame:
    """Facts with the match set of their (counterparty, drawing_no); every
    key is in the set, NULL ones too."""
    m = matches.withColumnRenamed(CP, "_k_cp").withColumnRenamed(DR, "_k_dr")
    if counts is not None:
        return hot_join(facts, m, [CP, DR], ["_k_cp", "_k_dr"], counts, rules=hot)
    return facts.join(m, facts[CP].eqNullSafe(m["_k_cp"]) & facts[DR].eqNullSafe(m["_k_dr"])).drop("_k_cp", "_k_dr")


def match_set(keys: DataFrame, nom: DataFrame, rules: Rules) -> DataFrame:
    """Per distinct (counterparty, drawing_no): its matches after both
    attempts. A key repeats once per match (the fallback also fires on a first
    match whose model is NULL); a key without any has NULLs."""
    primary = _primary_set(keys, nom, rules).drop("n_manufacturer")
    fallback = _fallback_set(keys.select(DR).distinct(), nom, rules)
    j = keys.join(primary, (keys[CP] == primary["_p_cp"]) & (keys[DR] == primary["_p_dr"]), "left")
    j = j.join(fallback, (j[DR] == fallback["_f_dr"]) & j["n_factory_model"].isNull(), "left")
    return j.select(
        CP, DR,
        F.coalesce("n_division", "f_division").alias("m_division"),
        F.coalesce("n_name", "f_name").alias("m_internal_code"),
        F.coalesce("n_code65", "f_code65").alias("m_code65"))


def match_guide(facts: DataFrame, nom: DataFrame, rules: Rules,
                keys_materialized: bool = False, hot: HotRules = HotRules()) -> DataFrame:
    """Facts with columns m_division, m_internal_code, m_code65 from the v2
    match, in one join with the match set of their keys.

    The distinct keys are counted and staged unless ``facts`` is itself a
    materialized reduction (``keys_materialized``)."""
    keys, counts = _keys(facts, [CP, DR], keys_materialized)
    return _join_facts(facts, match_set(keys, nom, rules), counts, hot)


def match_primary(facts: DataFrame, nom: DataFrame, rules: Rules, hot: HotRules = HotRules()) -> DataFrame:
    """First attempt only, as a left join: facts plus n_name, n_code65,
    n_factory_model, n_division (NULL when unmatched)."""
    keys, counts = _keys(facts, [CP, DR], False)
    primary = _primary_set(keys, nom, rules).drop("n_manufacturer")
    j = keys.join(primary, (keys[CP] == primary["_p_cp"]) & (keys[DR] == primary["_p_dr"]), "left")
    return _join_facts(facts, j.drop("_p_cp", "_p_dr"), counts, hot)


def match_v1(facts: DataFrame, guide: DataFrame, rules: Rules,
             keys_materialized: bool = False, hot: HotRules = HotRules()) -> DataFrame:
    """v1 match against the raw guide (no de-duplication, no maker key).

    One maker, compared after stripping blanks and upper-casing, without the
    placeholder name; the same three comparisons, of which only the last one
    also asks for a model that is not blank. Each guide row matches a drawing
    at most once, and duplicate guide rows each match (DISTINCT is per
    ``guide_id``). Adds columns m_division, m_internal_code, m_code65.
    """
    g = guide.where((normalize_maker("manufacturer") == F.lit(rules.v1_maker))
                    & (F.col("name") != F.lit(rules.v1_excluded_name)))
    keep = ["guide_id", "name", "code65", "division"]
    g_alt = _prefixed(
        _guide_alternatives(g, rules, keep, last_variant_guard=F.col("factory_model") != F.lit("")),
        "g_", keep + ["kind", "key"])
    fact_keys, counts = _keys(facts, [DR], keys_materialized)
    fk_alt = _fact_alternatives(fact_keys, rules, [DR])
    md = (fk_alt.join(g_alt, (F.col("kind") == F.col("g_kind")) & (F.col("key") == F.col("g_key")))
          .select(DR, "g_guide_id", F.col("g_division").alias("m_division"),
                  F.col("g_name").alias("m_internal_code"), F.col("g_code65").alias("m_code65"))
          .distinct().withColumnRenamed(DR, "_mk_dr"))
    # A NULL drawing matches nothing, so plain equality is exact here.
    if counts is not None:
        return fan_join(facts, md, DR, "_mk_dr", "g_guide_id", counts, hot)
    return facts.join(md.drop("g_guide_id"), facts[DR] == md["_mk_dr"], "left").drop("_mk_dr")
