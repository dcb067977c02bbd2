"""Hard negatives for (anchor, positive) pairs, by slot-decomposed selection.

An anchor's positives are its best rows of the same label; a positive with
score p admits the rows of other labels whose score lies in the window from
``low`` to ``high`` percent of p, and its first ``negatives`` rows are asked.
The windows of one anchor overlap, so rows are not gathered a window: the
distinct upper limits of the positives, descending, cut the scores into
disjoint slots, and every candidate lies in one. Each data block keeps only the
first rows of a slot (a combiner: at most ``positives`` x ``negatives`` rows an
anchor and block are shuffled), the blocks' rows are cut again by slot, and a
window's answer is the merge of its own slot with all lower ones, descending,
cut at ``negatives``: the first rows under its upper limit, of which those
under the lower limit fall out.

Scores are integer inner products of the quantized vectors. Two passes, one for
the positives and one for the negatives, work alike: rows are dealt to data
blocks by hash, whatever their label; the anchors (the query set) go to every
block, sorted behind its rows, and stream past them, so a task holds one block
and a few anchors. Rows move once a pass, anchors once a block.

Defined cases: rows whose id or label is null, or whose vector is null or holds
a null or non-finite component, take no part; vectors of different lengths are
never compared; fully equal rows count once, and no row with the anchor's id is
its positive or negative; ties go to the smaller id; a positive without a row
in its window (a negative score has none) gives no row; scores beyond 64 bits
are cut to them; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martcraft.llm.common import ship, stage


@dataclass(frozen=True)
class MiningRules:
    positives: int = 5
    negatives: int = 3
    low: int = 50           # percent of the positive's score
    high: int = 95
    block: int = 65536      # most rows of a data block, about
    tasks: int = 32         # blocks of a small table, as long as they keep
    least_block: int = 1024  # this many rows
    scores: int = 1 << 21   # scores held at once


def labelled(table: DataFrame, label: str | Column = "label", vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, label, v (floor(256 * x) of the components): the rows that take
    part."""
    label = F.col(label) if isinstance(label, str) else label
    x = F.col(embedding)
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    return table.where(F.col(vec_id).isNotNull() & label.isNotNull() & x.isNotNull() & whole).select(
        F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.transform(x, lambda e: F.floor(e.cast("double") * 256).cast("long")).alias("v"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two int64 matrices."""
    top = lambda x: max((abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))))
    bound = top(a) * top(b) * max(1, a.shape[1])
    if bound < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 2 ** 63:
        return a @ b.T
    wide = a.astype(object) @ b.astype(object).T
    return np.clip(wide, 1 - 2 ** 63, 2 ** 63 - 1).astype(np.int64)


def first_rows(group: np.ndarray, score: np.ndarray, who: np.ndarray, most: int) -> np.ndarray:
    """Positions of the ``most`` best scores of each group, ties to the smaller
    ``who``."""
    order = np.lexsort((who, -score, group))
    g = group[order]
    place = np.arange(len(g)) - np.searchsorted(g, g)
    return order[place < most]


def slot_of(score: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Number of the slot of each score among descending upper limits: the last
    limit that is not under it; -1 above all."""
    return (limits >= score[:, None]).sum(axis=1) - 1


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


FOUND = pa.schema([("anchor_id", pa.int64()), ("anchor", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("found", pa.int64())])


def _meet(rules: MiningRules, same_label: bool):
    """Rows come by (dim, block), data before anchors. ``limits``: an anchor's
    descending upper limits; ``least``: its lowest limit."""
    most = rules.positives if same_label else rules.negatives

    def found(anchors: pa.RecordBatch, dim: int, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Iterator[pa.RecordBatch]:
        step = max(1, rules.scores // max(1, len(x)))
        for at in range(0, len(anchors), step):
            part = anchors.slice(at, step)
            own, label = part["vid"].to_numpy(), part["label"].to_numpy()
            s = products(_matrix(part["v"], dim), x)
            wanted = (labels == label[:, None]) == same_label
            wanted &= ids != own[:, None]
            if not same_label:
                limits = part["limits"].to_pylist()
                u = np.full((len(part), max(map(len, limits))), np.iinfo(np.int64).min)
                for i, row in enumerate(limits):
                    u[i, :len(row)] = row
                wanted &= (s <= u[:, :1]) & (s >= part["least"].to_numpy()[:, None])
            elif len(x) > 4 * most:  # no row under the block's kth same-label score can stay
                masked = np.where(wanted, s, np.iinfo(np.int64).min)
                wanted &= masked >= np.partition(masked, len(x) - most, axis=1)[:, len(x) - most][:, None]
            row, col = np.nonzero(wanted)
            score = s[row, col]
            slot = np.zeros(len(row), np.int64) if same_label else slot_of(score, u[row])
            keep = first_rows(row * (rules.positives + 1) + slot, score, ids[col], most)
            row, col = row[keep], col[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[row]), pa.array(part["anchor"].to_numpy()[row]), pa.array(slot[keep].astype(np.int32)),
                 pa.array(score[keep]), pa.array(ids[col])], schema=FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, data = None, [], None
        for batch in batches:
            names = [batch[c].to_numpy(zero_copy_only=False) for c in ("dim", "block", "asks")]
            edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in names], axis=0)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(batch)]):
                part = batch.slice(int(lo), int(hi - lo))
                dim, block, asks = (c[lo].item() for c in names) if hi > lo else (None, None, False)
                if hi > lo and not asks:
                    if key != (dim, block):
                        key, held, data = (dim, block), [], None
                    held.append(part)
                elif hi > lo and key == (dim, block):
                    if data is None:
                        data = [np.concatenate(c) for c in zip(*[
                            (_matrix(p["v"], dim), p["vid"].to_numpy(), p["label"].to_numpy()) for p in held])]
                    yield from found(part, dim, *data)

    return run


def _pass(data: DataFrame, anchors: DataFrame, blocks: int, rules: MiningRules, same_label: bool) -> DataFrame:
    cols = ["dim", "block", "asks", "vid", "anchor", "label", "v", "limits", "least"]
    rows = data.select("dim", "block", F.lit(False).alias("asks"), "vid", F.lit(0).cast("long").alias("anchor"), "label", "v",
                       F.lit(None).cast("array<bigint>").alias("limits"), F.lit(None).cast("long").alias("least"))
    every = anchors.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asks"))
    met = rows.unionByName(every.select(*cols)).repartition(blocks, "dim", "block").sortWithinPartitions("dim", "block", "asks")
    return met.mapInArrow(_meet(rules, same_label), "anchor_id long, anchor long, slot int, score long, found long")


def _first(found: DataFrame, most: int, *by: str) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.desc("score"), "found")
    return found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= most)


def _percent(score: str, percent: int, up: bool) -> Column:
    """floor (or, ``up``, ceil) of percent * score / 100, without overflow."""
    rest = f"pmod({score}, 100L)"
    return F.expr(f"{percent}L * (({score} - {rest}) div 100L) + ({percent}L * {rest} + {99 if up else 0}L) div 100L")


def mine(rows: DataFrame, is_anchor: Column, rules: MiningRules = MiningRules()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score for every anchor, a row of ``rows`` (see ``labelled``) that
    meets ``is_anchor``, and each of its positives."""
    if not 0 <= rules.low <= rules.high <= 100:
        raise ValueError("0 <= low <= high <= 100")
    ship(rows.sparkSession)
    rows = stage(rows.distinct().select("vec_id", "label", "v", F.size("v").alias("dim")), "negatives-rows")
    n = F.count("*")
    sizes = rows.groupBy("dim").agg(F.greatest(  # one row a vector length
        F.ceil(n / rules.block), F.least(F.lit(rules.tasks), F.ceil(n / rules.least_block))).cast("int").alias("blocks"))
    rows = rows.join(stage(sizes, "negatives-sizes"), "dim")
    data = rows.select("dim", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int").alias("block"),
                       F.col("vec_id").alias("vid"), "label", "v")
    data = stage(data, "negatives-data")
    # rows that share an id but differ are anchors of their own
    anchors = rows.where(is_anchor).select("dim", "blocks", F.col("vec_id").alias("vid"), F.xxhash64("label", "v").alias("anchor"), "label", "v")
    total = max(1, sizes.agg(F.sum("blocks")).first()[0] or 1)

    blank = anchors.withColumn("limits", F.lit(None).cast("array<bigint>")).withColumn("least", F.lit(None).cast("long"))
    key = ["anchor_id", "anchor"]
    positives = _first(_pass(data, blank, total, rules, True), rules.positives, *key)
    positives = stage(positives.select(*key, F.col("found").alias("positive_id"), F.col("score").alias("positive_score"),
                                       _percent("score", rules.high, False).alias("upper"),
                                       _percent("score", rules.low, True).alias("lower")).where("lower <= upper"), "negatives-positives")
    windows = positives.groupBy(*key).agg(  # at most ``positives`` limits an anchor
        F.sort_array(F.collect_set("upper"), asc=False).alias("limits"), F.min("lower").alias("least"))
    asking = stage(anchors.withColumnRenamed("vid", "anchor_id").join(windows, key).withColumnRenamed("anchor_id", "vid"), "negatives-anchors")
    slots = _first(_pass(data, asking, total, rules, False), rules.negatives, *key, "slot")
    merged = slots.groupBy(*key).agg(F.sort_array(F.collect_list(  # at most positives x negatives rows
        F.struct((-F.col("score")).alias("s"), F.col("found").alias("id"), "slot"))).alias("rows"))
    out = positives.join(windows.select(*key, "limits"), key).join(merged, key)
    slot = F.array_position("limits", F.col("upper")) - 1
    below = F.slice(F.filter("rows", lambda e: e["slot"] >= slot), 1, rules.negatives)
    out = out.select("*", F.posexplode(F.filter(below, lambda e: -e["s"] >= F.col("lower"))).alias("p", "e"))
    return out.select("anchor_id", "positive_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.id").alias("negative_id"),
                      "positive_score", (-F.col("e.s")).alias("negative_score"))
