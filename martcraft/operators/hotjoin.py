"""Equi-join of raw facts on a key of which a few values hold much of the rows.

One counting pass over the facts gives the rows of every key. A key with more
than ``share`` of all rows (and ``least`` rows) is hot; there are fewer than
1 / share of them, so their list is small whatever the table, and it alone is
broadcast. Rows of a hot key are dealt over salts, as many as it holds that
share, and the other side's rows of the key are repeated for each salt; all
other keys have one salt. So the facts pass one join, no task gets more than
about that share of them, and nothing depends on runtime skew handling.

Where the other side has many rows of a key too (``fan_join``), the rows that
come out are the work: a key is hot by these, and the other side is packed into
blocks, lists of up to ``block`` rows of a key, which are unpacked above the
join. Where the other side has ``few`` rows at most, it is broadcast, the facts
are not shuffled or sorted by key, and each task returns what its own facts ask
for, whatever their keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.functions.nullsafe import nullsafe_on
from martcraft.session import materialize


@dataclass(frozen=True)
class HotRules:
    share: float = 0.001
    least: int = 1_000_000
    block: int = 1_000      # rows of the other side that are joined at once
    few: int = 500_000      # rows of the other side, unmatched keys included, that may be broadcast


def key_counts(facts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The distinct keys and their rows ``_n``, staged."""
    return materialize(facts.groupBy(*cols).agg(F.count("*").alias("_n")), "key-counts")


def hot_join(facts: DataFrame, other: DataFrame, cols: Sequence[str], other_cols: Sequence[str], counts: DataFrame,
             how: str = "inner", null_safe: bool = True, rules: HotRules = HotRules()) -> DataFrame:
    """``facts`` joined to ``other`` on the key; the columns of ``other_cols``
    are dropped. ``counts``: the facts' ``key_counts`` on the same columns;
    with a column ``_out``, keys are hot by that instead."""
    cols, other_cols = list(cols), list(other_cols)
    out = F.col("_out" if "_out" in counts.columns else "_n")
    on = [(facts[a].eqNullSafe(other[b]) if null_safe else facts[a] == other[b]) for a, b in zip(cols, other_cols)]
    total, most = counts.agg(F.sum(out), F.max(out)).first()  # two numbers
    limit = max(rules.least, int((total or 0) * rules.share))
    if (most or 0) <= limit:
        return facts.join(other, on, how).drop(*other_cols)
    names = [f"_hk{i}" for i in range(len(cols))]
    hot = counts.where(out > limit).select(
        *[F.col(c).alias(n) for c, n in zip(cols, names)], F.least(F.ceil(out / limit), "_n").cast("int").alias("_salts"))
    hot = materialize(hot, "hot-keys")
    few = F.broadcast(hot)  # under total / limit rows
    # the partition tells equal rows apart; scans and exchanges repeat it on a retry
    spot = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns], F.spark_partition_id())
    dealt = facts.join(few, nullsafe_on(facts, few, cols, names), "left").withColumn(
        "_salt", F.when(F.col("_salts").isNotNull(), F.pmod(spot, F.col("_salts"))).otherwise(F.lit(0)).cast("int")).drop(*names, "_salts")
    spread = other.join(few, nullsafe_on(other, few, other_cols, names), "left").withColumn(
        "_osalt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop(*names, "_salts")
    on = [(dealt[a].eqNullSafe(spread[b]) if null_safe else dealt[a] == spread[b]) for a, b in zip(cols, other_cols)]
    return dealt.join(spread, [*on, dealt["_salt"] == spread["_osalt"]], how).drop("_salt", "_osalt", *other_cols)


def _broadcasts(spark: SparkSession) -> bool:
    return not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")


def fan_join(facts: DataFrame, other: DataFrame, key: str, other_key: str, row_id: str, counts: DataFrame,
             rules: HotRules = HotRules()) -> DataFrame:
    """``facts`` left joined to ``other``, of which a key may have many rows:
    every line comes out with every row of its key. ``other_key`` and
    ``row_id`` (which tells the rows of a key apart) are dropped. ``counts``:
    the facts' ``key_counts`` on ``key``."""
    other = materialize(other, "fan-rows")
    fan = other.groupBy(other_key).agg(F.count("*").alias("_m"))
    sizes = materialize(
        counts.join(fan, counts[key] == fan[other_key], "left").select(
            key, "_n", F.coalesce("_m", F.lit(1)).alias("_m")).withColumn("_out", F.col("_n") * F.col("_m")), "fan-sizes")
    # every key of the facts is in the blocks, NULL and unmatched ones with a row of NULLs: an inner join is cheaper a row
    values = F.struct(*[c for c in other.columns if c not in (other_key, row_id)])
    blocks = materialize(
        sizes.join(other, sizes[key] == other[other_key], "left")
        .groupBy(F.col(key).alias("_fan_key"), F.pmod(F.xxhash64(row_id), F.ceil(F.col("_m") / rules.block)).alias("_b"))
        .agg(F.collect_list(values).alias("_rows")).drop("_b"), "fan-blocks")
    rows = sizes.agg(F.sum("_m")).first()[0] or 0
    if rows <= rules.few and _broadcasts(facts.sparkSession):
        joined = facts.join(F.broadcast(blocks), facts[key].eqNullSafe(blocks["_fan_key"]))
    else:
        joined = hot_join(facts, blocks, [key], ["_fan_key"], sizes, rules=rules)
    return joined.select(*facts.columns, F.inline("_rows"))
