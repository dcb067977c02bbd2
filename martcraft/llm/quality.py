"""Quality rules with adaptive thresholds (built-in functions only).

Per document a few counts are taken; per (lang, source) a mergeable quantile
sketch of four ratios is built from the documents that pass the base rules, and
a document is rejected where a ratio lies far above what is usual for its own
group. The sketch is a histogram over fixed integer bins that keep ``SKETCH_BITS`` significant bits of a value
(relative error under 1/32), so merging is adding counts: it is combined on
the map side, its size has a bound, and its result does not depend on the
order of merging. Sketches are merged up to languages and to everything; a
group's limit is averaged with that of the level above, which weighs as much as
``prior`` rows, so small groups lean on larger ones without a switch.

Defined cases: null text counts as no text (all counts zero, base_failed);
null ``lang`` or ``source`` is a group of its own; repeated rows are scored
each; an empty table gives an empty result; other columns are carried
untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martcraft.llm.common import ROW, SPACE, SPACE_RUN, carry, leading_bits, stage

SKETCH_BITS = 6
#: ratio -> (numerator, denominator, scale); integer division.
RATIOS = {
    "symbols": ("n_symbols", "word_chars", 1000),
    "dup_lines": ("n_dup_lines", "n_lines", 1000),
    "repeats": ("n_repeat_words", "n_words", 1000),
    "word_length": ("word_chars", "n_words", 10),
}


@dataclass(frozen=True)
class QualityRules:
    """A ratio above ``high + spread * (high - mid) + slack`` rejects, where
    mid and high are the group's own quantiles ``q_mid`` and ``q_high``. The
    slack is the least distance that counts as unusual in a group without any
    spread. Symbols and word lengths lie close together in ordinary text, and a
    group may be spoilt to a quarter: their fence stands on the middle of the
    group. Duplicated lines and repeats are absent from most texts and frequent
    in some good ones: their fence stands on the group's upper end."""

    #: ratio, q_mid, q_high, spread, slack
    fences: tuple[tuple[str, float, float, float, int], ...] = (
        ("symbols", 0.5, 0.75, 4.0, 40), ("dup_lines", 0.95, 0.99, 1.0, 100),
        ("repeats", 0.95, 0.99, 2.0, 100), ("word_length", 0.5, 0.75, 4.0, 20))
    prior: float = 200.0   # rows that the limit of the level above counts for


def features(docs: DataFrame, keep_row: bool = False) -> DataFrame:
    """doc_id, lang, source and the counts of every document, whole texts."""
    blank = "".join({" ": " ", "\t": "\\t", "\n": "\\n", "\r": "\\r"}.get(c, f"\\u{ord(c):04x}") for c in SPACE)
    first = [carry(docs)] if keep_row else []
    more = [ROW] if keep_row else []
    ids = ["doc_id", "lang", "source"]
    d = docs.select(*first, *ids, F.coalesce("text", F.lit("")).alias("_t"))
    d = d.select(*more, *ids, "_t", F.expr(f"btrim(_t, '{blank}')").alias("_trim"))
    d = d.select(
        *more, *ids,
        F.when(F.col("_trim") == "", F.array().cast("array<string>")).otherwise(F.split("_trim", SPACE_RUN)).alias("_w"),
        F.regexp_count("_t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    d = d.select(
        *more, *ids, "n_symbols",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        # one 64-bit hash for each window of three words
        F.expr("if(size(_w) < 3, cast(array() as array<bigint>), transform(slice(_w, 1, size(_w) - 2), "
               "(x, i) -> xxhash64(x, get(_w, i + 1), get(_w, i + 2))))").alias("_h"))
    counts = ["n_words", "word_chars", "n_lines", "n_symbols", "n_dup_lines"]
    d = d.select(*more, *ids, *counts, "_h", F.sort_array("_h").alias("_s"))
    d = d.select(*more, *ids, *counts, "_h",
                 F.expr("array_distinct(filter(_s, (x, i) -> i > 0 and x = get(_s, i - 1)))").alias("_again"))
    # first positions of repeated windows, in order; a long list of repeated
    # windows is matched by sorting instead of one search a window
    d = d.select(
        *more, *ids, *counts, "_h", "_again",
        F.expr("if(size(_again) > 32, array_sort(transform(_h, (x, i) -> struct(x as x, i as i))), "
               "cast(array() as array<struct<x:bigint,i:int>>))").alias("_o"))
    d = d.select(
        *more, *ids, *counts,
        F.expr("case when size(_again) = 0 then cast(array() as array<int>) "
               "when size(_again) <= 32 then filter(sequence(0, size(_h) - 1), i -> array_contains(_again, get(_h, i))) "
               "else sort_array(transform(filter(_o, (e, k) -> coalesce(e.x = get(_o, k - 1).x, false) "
               "or coalesce(e.x = get(_o, k + 1).x, false)), e -> e.i)) end").alias("_p"))
    return d.select(
        *more, *ids, *counts,
        F.expr("aggregate(transform(_p, (p, k) -> if(k = 0, 3, least(3, p - get(_p, k - 1)))), 0L, "
               "(a, v) -> a + v)").alias("n_repeat_words"))


#: The fixed rules; what fails them is no measure of what is usual.
BASE_FAILED = "(n_words < 50 or 100 * n_repeat_words > 50 * n_words)"


def _ratio(name: str) -> str:
    over, under, scale = RATIOS[name]
    return f"if({under} = 0, 0L, {scale} * {over} div {under})"


def sketches(feats: DataFrame) -> DataFrame:
    """level 0: (lang, source); 1: lang; 2: all. One row per level, group,
    ratio and bin with its count; the upper levels merge the lower ones."""
    entries = F.array(*[F.struct(F.lit(n).alias("ratio"), F.expr(_ratio(n)).alias("v")) for n in RATIOS])
    by = (feats.where(f"not {BASE_FAILED}").select("lang", "source", F.explode(entries).alias("e"))
          .groupBy("lang", "source", F.col("e.ratio").alias("ratio"), F.expr(leading_bits("e.v", SKETCH_BITS)).alias("bin"))
          .agg(F.count("*").alias("n")))
    levels = F.array(
        F.struct(F.lit(0).alias("level"), "lang", "source"),
        F.struct(F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source")),
        F.struct(F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"),
                 F.lit(None).cast("string").alias("source")))
    return (by.select(F.explode(levels).alias("g"), "ratio", "bin", "n")
            .groupBy("g.level", "g.lang", "g.source", "ratio", "bin").agg(F.sum("n").alias("n")))


def thresholds(sketch: DataFrame, rules: QualityRules) -> DataFrame:
    """One row per (lang, source): the upper limit of each ratio."""
    sketch = stage(sketch, "quality-sketches")
    key = ["level", "lang", "source", "ratio"]
    cum = sketch.withColumn("c", F.sum("n").over(Window.partitionBy(*key).orderBy("bin"))).withColumn(
        "total", F.sum("n").over(Window.partitionBy(*key)))
    of = lambda k: F.coalesce(*[F.when(F.col("ratio") == f[0], F.lit(f[k])) for f in rules.fences])
    at = lambda k: F.min(F.when(F.col("c") >= F.ceil(F.col("total") * of(k)), F.col("bin")))
    cut = cum.groupBy(*key).agg(at(1).alias("mid"), at(2).alias("high"), F.max("total").alias("total"))
    limit = F.col("high") + of(3) * (F.col("high") - F.col("mid")) + of(4)
    wide = cut.groupBy("level", "lang", "source").agg(
        F.max("total").alias("total"), *[F.max(F.when(F.col("ratio") == n, limit)).alias(f"max_{n}") for n in RATIOS])
    names = [f"max_{n}" for n in RATIOS]

    def level(i: int) -> DataFrame:
        return wide.where(F.col("level") == i).select(
            F.col("lang").alias(f"lang{i}"), F.col("source").alias(f"source{i}"), F.col("total").alias(f"total{i}"),
            *[F.col(n).alias(f"{n}{i}") for n in names])

    whole = level(2).first()  # one row at most
    j = level(0).join(level(1), F.expr("lang0 <=> lang1"), "left")

    def blend(i: int, limit: Column, above: Column) -> Column:
        """Smooth in the group's size: its own limit for large groups."""
        n = F.col(f"total{i}").cast("double")
        return (n * limit + rules.prior * above) / (n + rules.prior)

    return j.select(
        F.col("lang0").alias("lang"), F.col("source0").alias("source"),
        *[blend(0, F.col(f"{n}0"), blend(1, F.col(f"{n}1"), F.lit(whole[f"{n}2"] if whole else None).cast("double"))).alias(n)
          for n in names])


def judge(docs: DataFrame, rules: QualityRules = QualityRules(), keep_row: bool = False) -> DataFrame:
    """The counts, base_failed and kept of every row. The counts are written
    once as a stage table; the thresholds, a small table of known size, are
    joined to it (Spark broadcasts them only under its own threshold)."""
    feats = stage(features(docs, keep_row), "quality-features")
    cuts = stage(thresholds(sketches(feats), rules), "quality-thresholds")
    cuts = cuts.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[f"max_{n}" for n in RATIOS])
    j = feats.join(cuts, F.expr("lang <=> _lang and source <=> _source"), "left")
    over = F.lit(False)
    for n in RATIOS:
        over = over | F.coalesce(F.expr(_ratio(n)) > F.col(f"max_{n}"), F.lit(False))
    base = F.expr(BASE_FAILED)
    return j.select(*([ROW] if keep_row else ["doc_id"]), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), (~base & ~over).alias("kept"),
                    *[F.expr(_ratio(n)).alias(f"ratio_{n}") for n in RATIOS], *[f"max_{n}" for n in RATIOS])


def filter_quality(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    return judge(docs, rules, keep_row=True).where("kept").select(f"{ROW}.*")
