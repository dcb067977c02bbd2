"""Top-k search against brute force."""


import numpy as np
from pyspark.sql import functions as F

from martcraft.llm import topk as T

SCHEMA = "vec_id long, embedding array<float>, score string, v int"


def slow(rows, k, query):
    good = {}
    for i, e, *_ in rows:
        if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            good[i] = np.floor(256 * np.array(e, np.float32).astype(float)).astype(int)
    out = []
    for i in filter(query, good):
        scores = sorted((-int(good[i] @ v), j) for j, v in good.items() if j != i and len(v) == len(good[i]))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def table(n=700, dim=12):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(5, dim))
    x = middle[rng.integers(0, 5, n)] + 0.3 * rng.normal(size=(n, dim))
    x[::3] = x[0]  # a third of the rows are one vector
    x[5::40] = x[5]
    rows = [(i, [float(v) for v in x[i]], "s", 1) for i in range(n)]
    odd = [(1000, None), (1050, [None] * dim), (1100, [float("nan")] * dim), (1150, [float("inf")] + [0.0] * (dim - 1)), (None, [0.1] * dim),
           (1200, [0.5, 0.25]), (1250, [1.0, -1.0]), (1300, [3.0]), (1350, []), (1400, [0.0] * dim)]
    return [*rows, *[(i, e, None, None) for i, e in odd], rows[50]]


def run(spark, rows, rules, step=50):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = T.top_k(T.quantize(df), F.col("vec_id") % step == 0, rules).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)


def test_against_brute_force(spark):
    rows = table()
    want = slow(rows, 5, lambda i: i % 50 == 0)
    assert run(spark, rows, T.SearchRules()) == want
    small = T.SearchRules(block=60, query_block=4, cells=6, sample=200, leaf=4, branch=3)
    assert run(spark, rows, small) == want


def test_few_and_empty(spark):
    rows = [(0, [1.0, 2.0], "", 0), (50, [1.0, 2.0], "", 0), (7, [0.0, -1.0], "", 0)]
    assert run(spark, rows, T.SearchRules()) == slow(rows, 5, lambda i: i % 50 == 0)
    assert run(spark, rows[:1], T.SearchRules()) == []
    df = spark.createDataFrame([], SCHEMA)
    assert T.top_k(T.quantize(df), F.col("vec_id") % 50 == 0).count() == 0


def test_trees_prune_and_cover():
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(20, 8)) * 300
    data = (middle[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 8)) * 9).astype(int)
    queries = data[::50]
    best, who, done = T.dual_search(queries, data, np.arange(3000), 6, np.full(len(queries), -np.inf), 16, 8)
    s = queries @ data.T
    for i in range(len(queries)):
        order = sorted(range(3000), key=lambda j: (-s[i, j], j))[:6]
        assert who[i].tolist() == order and best[i].tolist() == [s[i, j] for j in order]
    assert done < 0.75 * s.size

    def visit(node):
        x = data.astype(float)
        assert np.sqrt(((x[node[3]] - x[node[0]]) ** 2).sum(axis=1)).max() <= node[1] + 1e-9
        if node[2]:
            assert sorted(np.concatenate([c[3] for c in node[2]])) == sorted(node[3])
        for c in node[2]:
            visit(c)

    visit(T.CoverTree(data.astype(float), 16, 8).root)


def test_scores_beyond_floats_stay_exact(spark):
    big = 2 ** 27
    rows = [(i, [big + i % 7, 3 * i, i % 3]) for i in range(0, 120)]
    df = spark.createDataFrame(rows, "vec_id long, v array<bigint>").repartition(2)
    got = sorted(tuple(r) for r in T.top_k(df, F.col("vec_id") % 50 == 0, T.SearchRules(k=3, block=30, query_block=2, cells=3, leaf=4, branch=3)).collect())
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    want = []
    for i, v in rows[::50]:
        best = sorted((-dot(v, w), j) for j, w in rows if j != i)[:3]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert got == sorted(want) and got[0][3] > 2 ** 54 and any(r[3] % 2 for r in got)
