"""Exact top-k search by inner product with dual cover trees.

Components become integers, floor(256 * x), so scores are exact. Rows with
equal vectors are searched as one (their k + 1 smallest ids are kept, which is
all that ties to the smaller id can need). The upper level of the index is a
greedy cover of a bounded sample: every vector goes to its nearest centre's
cell, whose covering radius is measured over all its vectors. Cells are cut
into blocks of bounded size; queries are blocked too, those of neighbouring cells
together.

A block of queries and a block of data meet in one task, which builds a cover
tree over each and descends both together: a pair of nodes with centres a, b
and covering radii p, q has no score above <a,b> + p|b| + q|a| + pq, and is
pruned where that lies under the worst kth score of the query node's group.
The first pass searches a query block's own cells; its kth scores prune whole
cells by the same bound before the second pass sends anything to them.

Defined cases: rows whose id is null, or whose vector is null or holds a null
or non-finite component, take no part; vectors of different lengths are never
compared; repeated rows with one id and vector count once, and no row with the
query's own id is its candidate; an empty table gives an empty result; columns
beside the id and the vector are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martcraft.llm.common import bounded_sample, ship, stage
from martcraft.llm.negatives import products


@dataclass(frozen=True)
class SearchRules:
    k: int = 5
    block: int = 8192         # vectors of a data block
    query_block: int = 2048   # queries of a query block
    cells: int = 64           # most centres of the upper level
    sample: int = 4096        # rows that the centres are chosen from
    leaf: int = 256
    branch: int = 16          # most children of a node


NONE = np.int64(1 - 2 ** 63)  # no score


class CoverTree:
    """Nodes as (centre, covering radius, children, rows). A node's children
    are centred by a greedy cover of its rows at ``1 / BASE`` of its radius
    (at most ``branch`` centres; radii are measured, so they hold anyway)."""

    BASE = 1.5

    def __init__(self, x: np.ndarray, leaf: int, branch: int) -> None:
        self.x, self.leaf, self.branch = x, leaf, branch
        self.square = np.einsum("ij,ij->i", x, x)
        middle = x.mean(axis=0)
        first = int((self.square - 2 * (x @ middle)).argmin())
        self.root = self._node(np.arange(len(x)), x, first)

    def _distance(self, rows: np.ndarray, x: np.ndarray, centre: int) -> np.ndarray:
        d = self.square[rows] + self.square[centre] - 2 * (x @ self.x[centre])
        return np.sqrt(np.maximum(d, 0))

    def _node(self, rows: np.ndarray, x: np.ndarray, centre: int) -> tuple:
        d = self._distance(rows, x, centre)
        radius = float(d.max()) * (1 + 1e-9)
        if len(rows) <= self.leaf or radius == 0:
            return centre, radius, (), rows
        near, best, picked = d.copy(), np.zeros(len(rows), np.int64), [centre]
        while len(picked) < self.branch and near.max() > radius / self.BASE:
            new = int(rows[near.argmax()])
            d = self._distance(rows, x, new)
            closer = d < near
            near[closer], best[closer] = d[closer], len(picked)
            picked.append(new)
        groups = [np.flatnonzero(best == i) for i in range(len(picked))]
        if max(map(len, groups)) == len(rows):
            return centre, radius, (), rows
        return centre, radius, tuple(self._node(rows[g], x[g], c) for g, c in zip(groups, picked) if len(g)), rows


def dual_search(queries: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray,
                leaf: int = 64, branch: int = 32) -> tuple[np.ndarray, np.ndarray, int]:
    """For each query its k best (score, id), ties to the smaller id, of the
    scores at or above ``floor``; ``NONE`` where there are fewer. Also the
    number of products computed. Scores stay integers; only pruning bounds,
    which leave room for it, are rounded."""
    q, r = queries.astype(np.float64), data.astype(np.float64)
    big = max(np.abs(q).max(initial=0), 1) * max(np.abs(r).max(initial=0), 1) * max(q.shape[1], 1)
    exact = big < 2 ** 53
    best = np.full((len(q), k), NONE)
    who = np.full((len(q), k), np.iinfo(np.int64).max)
    worst = floor.astype(np.float64).copy()
    tq, tr = CoverTree(q, leaf, branch), CoverTree(r, leaf, branch)
    nq, nr = np.sqrt((q * q).sum(axis=1)), np.sqrt((r * r).sum(axis=1))
    done = 0

    def bound(a: tuple, b: tuple) -> float:
        top = float(q[a[0]] @ r[b[0]]) + a[1] * nr[b[0]] + b[1] * nq[a[0]] + a[1] * b[1]
        return top + 1e-9 * abs(top) + 1e-6

    def meet(a: tuple, b: tuple) -> None:
        nonlocal done
        rows, cols = a[3], b[3]
        s = (q[rows] @ r[cols].T) if exact else products(queries[rows], data[cols])
        done += s.size
        least = worst[rows]
        if s.shape[1] > k:  # no score under the kth of these alone can stay
            least = np.maximum(least, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k])
        row, col = np.nonzero(s >= least[:, None])
        if not len(row):
            return
        hit = np.unique(row)
        old = np.repeat(hit, k)
        of = np.concatenate([old, row])
        score = np.concatenate([best[rows[hit]].ravel(), s[row, col].astype(np.int64)])
        name = np.concatenate([who[rows[hit]].ravel(), ids[cols[col]]])
        order = np.lexsort((name, -score, of))
        of, score, name = of[order], score[order], name[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        keep = place < k
        best[rows[of[keep]], place[keep]], who[rows[of[keep]], place[keep]] = score[keep], name[keep]
        worst[rows[hit]] = np.maximum(worst[rows[hit]], best[rows[hit], k - 1])

    def descend(a: tuple, b: tuple) -> None:
        if bound(a, b) < worst[a[3]].min():
            return
        if not a[2] and not b[2]:
            meet(a, b)
        elif not b[2] or (a[2] and a[1] > b[1]):
            for child in sorted(a[2], key=lambda c: -bound(c, b)):
                descend(child, b)
        else:
            for child in sorted(b[2], key=lambda c: -bound(a, c)):
                descend(a, child)

    descend(tq.root, tr.root)
    return best, who, done


def quantize(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v: the rows that take part."""
    x = F.col(embedding)
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    return table.where(F.col(vec_id).isNotNull() & x.isNotNull() & whole).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(e.cast("double") * 256).cast("long")).alias("v"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64) if len(column) else np.empty((0, 0), np.int64)


def _centres(sample: np.ndarray, most: int) -> np.ndarray:
    """Greedy cover: the row nearest the middle, then always the farthest."""
    d = np.full(len(sample), np.inf)
    picked = [int(((sample - sample.mean(axis=0)) ** 2).sum(axis=1).argmin())]
    while len(picked) < min(most, len(sample)):
        d = np.minimum(d, ((sample - sample[picked[-1]]) ** 2).sum(axis=1))
        if d.max() == 0:
            break
        picked.append(int(d.argmax()))
    return sample[picked].astype(np.float64)


def _search(rules: SearchRules):
    k = rules.k + 1

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows["asked"].to_numpy(bool)
        q, d = rows[asked], rows[~asked]
        if not len(q) or not len(d):
            return pd.DataFrame({"query": np.empty(0, np.int64), "score": np.empty(0, np.int64), "found": np.empty(0, np.int64)})
        floor = q["floor"].to_numpy(np.float64)
        best, who, _ = dual_search(_matrix(q["v"]), _matrix(d["v"]), d["vid"].to_numpy(np.int64), k, floor, rules.leaf, rules.branch)
        real = best > NONE
        name = np.broadcast_to(q["vid"].to_numpy(np.int64)[:, None], best.shape)
        return pd.DataFrame({"query": name[real], "score": best[real], "found": who[real]})

    return run


def _meet(asked: DataFrame, data: DataFrame, pairs: DataFrame, rules: SearchRules) -> DataFrame:
    """Search the pairs (dim, qgroup, qblock, cell, block) of blocks."""
    cols = ["dim", "qgroup", "qblock", "cell", "block"]
    left = asked.join(pairs, ["dim", "qgroup", "qblock"]).select(
        *cols, "vid", "v", "floor", F.lit(True).alias("asked"))
    right = data.select("dim", "cell", "block", "vid", "v").join(pairs, ["dim", "cell", "block"]).select(
        *cols, "vid", "v", F.lit(0.0).alias("floor"), F.lit(False).alias("asked"))
    return left.union(right).groupBy(*cols).applyInPandas(_search(rules), "query long, score long, found long")


def _query_groups(stats: list, rules: SearchRules) -> list[tuple[int, int, int, int, int]]:
    """(dim, cell, data blocks, query group, its query blocks): neighbouring
    cells share a query group while their queries fit one block."""
    out, per_group = [], {}
    group, dim, held = -1, None, 0
    for r in sorted(stats, key=lambda r: (r.dim, r.cell)):
        if r.dim != dim or (held and held + r.nq > rules.query_block):
            group, dim, held = group + 1, r.dim, 0
        held += r.nq
        per_group[group] = held
        out.append((r.dim, r.cell, -(-r.n // rules.block), group))
    return [(*x, -(-per_group[x[3]] // rules.query_block)) for x in out]


def top_k(vectors: DataFrame, is_query, rules: SearchRules = SearchRules()) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows for each row of
    ``vectors`` (vec_id, v) that meets the condition ``is_query``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = stage(vectors.distinct(), "topk-rows")
    k = rules.k + 1
    # the smallest ids of each vector; Spark limits each group before the shuffle
    first = Window.partitionBy("v").orderBy("vec_id")
    kept = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k)
    asked_v = rows.where(is_query).select("v", F.lit(True).alias("_asked")).distinct()
    distinct = kept.groupBy("v").agg(F.min("vec_id").alias("vid"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    distinct = stage(distinct.join(asked_v, "v", "left").select(
        "vid", "v", F.size("v").alias("dim"), "ids", F.coalesce("_asked", F.lit(False)).alias("asks")), "topk-distinct")

    sample = bounded_sample(distinct.select("vid", "v"), "vid", rules.sample).select("v").collect()
    total = distinct.count()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r.v), []).append(r.v)
    cells = max(1, min(rules.cells, total // rules.block))
    centres = {n: _centres(np.array(v, np.float64).reshape(len(v), n), cells) for n, v in by_dim.items()}

    def nearest(batches):
        for b in batches:
            cell, far = np.zeros(len(b), np.int32), np.zeros(len(b))
            for n in set(b["dim"]):
                at = np.flatnonzero(b["dim"] == n)
                x = np.stack(b["v"].to_numpy()[at]).astype(np.float64).reshape(len(at), n)
                c = centres.get(n)
                if c is None:  # a length that the sample missed: one cell around zero
                    c = np.zeros((1, n))
                d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2) if len(c) * len(x) * n < 2e7 else np.stack([((x - y) ** 2).sum(axis=1) for y in c], axis=1)
                cell[at] = d.argmin(axis=1)
                far[at] = np.sqrt(d.min(axis=1))
            yield b.assign(cell=cell, far=far)

    placed = stage(distinct.mapInPandas(nearest, "vid long, v array<bigint>, dim int, ids array<bigint>, asks boolean, cell int, far double"), "topk-cells")
    stats = placed.groupBy("dim", "cell").agg(
        F.count("*").alias("n"), F.sum(F.col("asks").cast("int")).alias("nq"), F.max("far").alias("radius")).collect()  # one row a cell
    plan = spark.createDataFrame(_query_groups(stats, rules), "dim int, cell int, blocks int, qgroup int, qblocks int")
    split = lambda n: F.pmod(F.xxhash64("vid"), F.col(n)).cast("int")
    placed = placed.join(F.broadcast(plan), ["dim", "cell"])
    data = placed.select("dim", "cell", split("blocks").alias("block"), "vid", "v")
    asked = placed.where("asks").select("dim", "qgroup", split("qblocks").alias("qblock"), "vid", "v", F.lit(float("-inf")).alias("floor"))
    blocks = plan.select("dim", "cell", "qgroup", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    qblocks = plan.where("qblocks > 0").select("dim", "qgroup", "qblocks").distinct().select(
        "dim", "qgroup", F.explode(F.expr("sequence(0, qblocks - 1)")).alias("qblock"))

    own = stage(qblocks.join(blocks, ["dim", "qgroup"]).select("dim", "qgroup", "qblock", "cell", "block"), "topk-own")
    one = stage(_meet(asked, data, own, rules), "topk-first")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "found")
    kth = one.withColumn("r", F.row_number().over(best)).where(F.col("r") == k).select(F.col("query").alias("vid"), F.col("score").alias("kth"))
    asked = stage(asked.drop("floor").join(kth, "vid", "left").withColumn(
        "floor", F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf")))).drop("kth"), "topk-asked")

    # whole cells against query blocks: at most ``cells`` centres a length
    groups = {(r.dim, r.cell): r.qgroup for r in plan.collect()}
    known = [(r.dim, r.cell, groups[r.dim, r.cell], float(r.radius)) for r in stats]

    def surviving(rows: pd.DataFrame) -> pd.DataFrame:
        x, n, mine = _matrix(rows["v"]).astype(np.float64), int(rows["dim"].iloc[0]), int(rows["qgroup"].iloc[0])
        middle = x.mean(axis=0)
        spread, low = np.sqrt(((x - middle) ** 2).sum(axis=1).max(initial=0)), rows["floor"].min()
        c = centres.get(n, np.zeros((1, n)))
        out = []
        for dim, cell, group, radius in known:
            if dim == n and group != mine:
                top = c[cell] @ middle + spread * np.linalg.norm(c[cell]) + radius * np.linalg.norm(middle) + spread * radius
                if top + 1e-9 * abs(top) + 1e-6 >= low:
                    out.append((n, mine, int(rows["qblock"].iloc[0]), cell))
        return pd.DataFrame(out, columns=["dim", "qgroup", "qblock", "cell"]).astype("int32")

    live = asked.groupBy("dim", "qgroup", "qblock").applyInPandas(surviving, "dim int, qgroup int, qblock int, cell int")
    others = stage(live.join(blocks.drop("qgroup"), ["dim", "cell"]).select("dim", "qgroup", "qblock", "cell", "block"), "topk-others")
    every = stage(one.union(_meet(asked, data, others, rules)), "topk-found")
    top = every.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k)
    # vectors back to rows: at most k + 1 ids a vector
    named = top.join(distinct.select(F.col("vid").alias("found"), "ids"), "found").select(
        F.col("query").alias("vid"), "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("vid").orderBy(F.desc("score"), "vec_id")
    named = named.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")
    lists = named.groupBy("vid").agg(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")).alias("l"))  # k + 1 at most
    ids = rows.where(is_query).join(distinct.where("asks").select("v", "vid"), "v").select("vid", F.col("vec_id").alias("query_id"))
    kept = ids.join(lists, "vid").select("query_id", F.posexplode(F.slice(
        F.filter(F.sort_array("l"), lambda e: e["vec_id"] != F.col("query_id")), 1, rules.k)).alias("p", "e"))
    return kept.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), (-F.col("e.s")).alias("score"))
