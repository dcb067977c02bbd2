"""Hard negatives against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martcraft.llm import negatives
from martcraft.llm.negatives import MiningRules

SMALL = MiningRules(block=16, tasks=1, scores=40)


def plain(rows, is_anchor, rules):
    rows = sorted({(i, lab, tuple(v)) for i, lab, v in rows})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, lab, v in rows:
        if not is_anchor(i):
            continue
        others = [(-dot(v, w), j, m) for j, m, w in rows if j != i and len(w) == len(v)]
        for s, pos, _ in sorted(o for o in others if o[2] == lab)[:rules.positives]:
            hit = sorted(o for o in others if o[2] != lab and rules.low * -s <= 100 * -o[0] <= rules.high * -s)
            out += [(i, pos, r + 1, neg, -s, -t) for r, (t, neg, _) in enumerate(hit[:rules.negatives])]
    return sorted(out)


def mined(spark, rows, rules=SMALL, step=3):
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<bigint>")
    return sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % step == 0, rules).collect())


@pytest.mark.parametrize("seed,rules", [(1, SMALL), (2, MiningRules(positives=2, negatives=1, low=0, high=100, block=7, tasks=1, scores=1)),
                                        (3, MiningRules())])
def test_against_brute_force(spark, seed, rules):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(3), [rng.randrange(-3, 9) for _ in range(rng.choice([4, 4, 4, 2]))]) for i in range(90)]
    rows += rows[:9] + [(3, 1, [5, 5, 5, 5]), (3, 2, [5, 5, 5, 5])] + [(100 + i, i % 2, [1, 1, 1, 1]) for i in range(40)]
    want = plain(rows, lambda i: i % 3 == 0, rules)
    assert want and mined(spark, rows, rules) == want


def test_hot_label_and_equal_vectors(spark):
    rows = [(i, 0, [3, 4]) for i in range(120)] + [(200 + i, 1 + i % 4, [i % 5, 3]) for i in range(60)]
    assert mined(spark, rows) == plain(rows, lambda i: i % 3 == 0, SMALL)


def test_windows_at_the_limits(spark):
    rows = [(0, 0, [10]), (1, 0, [10]), (2, 0, [-4]), (4, 0, [0])] + [(10 + x, 1, [x]) for x in range(-3, 12)]
    got = mined(spark, rows, step=50)
    assert [r[1:4] for r in got if r[0] == 0 and r[1] == 1] == [(1, 1, 19), (1, 2, 18), (1, 3, 17)]  # 50 <= 10 x <= 95
    assert [r[1:4] for r in got if r[0] == 0 and r[1] == 4] == [(4, 1, 10)]  # only a zero score
    assert not [r for r in got if r[1] == 2]


def test_scores_beyond_floats(spark):
    big = 2 ** 27
    rows = [(0, 0, [big, 1]), (1, 0, [big, 3]), (2, 1, [big * 9 // 10, 7]), (3, 1, [big * 9 // 10, 8])]
    got = mined(spark, rows, step=50)
    assert got == plain(rows, lambda i: i % 50 == 0, SMALL) and got[0][4] == 2 ** 54 + 3
    wide = negatives.products(np.array([[2 ** 62, 2 ** 62]]), np.array([[4, 4], [1, -1]]))
    assert wide.tolist() == [[2 ** 63 - 1, 0]]


def test_rows_that_take_no_part(spark):
    rows = [(0, 0, [1.0, 0.5]), (1, 0, [0.9, 0.5]), (2, 1, [0.5, 0.5]), (None, 1, [0.6, 0.5]), (4, None, [0.6, 0.5]),
            (5, 1, None), (6, 1, [0.6, None]), (7, 1, [float("nan"), 0.5]), (8, 1, [float("inf"), 0.5]), (9, 1, [])]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, label int, embedding array<double>, block int, dim int")
    kept = negatives.labelled(table)
    assert sorted(r.vec_id for r in kept.collect()) == [0, 1, 2, 9]
    got = negatives.mine(kept, F.col("vec_id") % 50 == 0).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 256 * 230 + 128 * 128, 256 * 128 + 128 * 128)]
    assert negatives.mine(kept.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    with pytest.raises(ValueError):
        negatives.mine(kept, F.lit(True), MiningRules(low=60, high=50))
