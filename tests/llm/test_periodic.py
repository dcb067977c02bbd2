"""Runs of words against brute force, and the query's digests."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from martcraft.llm import periodic, registry
from martcraft.llm.periodic import Catchers, RunRules

SPACES = " \t\n\x0b\x0c\r"


def plain_runs(words, ratio=4, least=6):
    """For each period the stretches of equal words q apart; of one stretch
    only the smallest period stays."""
    n, out = len(words), []
    for q in range(1, n // ratio + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, ratio * q):
                stretch = words[i:j + q]
                if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def caught(texts, rules=RunRules()):
    bounds = np.cumsum([0] + [len(t) for t in texts])
    rows = Catchers(np.array([w for t in texts for w in t], np.int32), bounds, rules).runs()
    return [[tuple(r[1:]) for r in rows.tolist() if r[0] == d] for d in range(len(texts))]


@pytest.mark.parametrize("ratio,least", [(4, 6), (2, 2), (3, 1), (5, 9)])
def test_runs_against_brute_force(ratio, least):
    rng = random.Random(ratio)
    texts = []
    for k in range(250):
        letters = rng.choice([1, 2, 3, 6])
        unit = [rng.randrange(letters) for _ in range(rng.randrange(1, 14))]
        texts.append([rng.randrange(letters) for _ in range(rng.randrange(0, 40))] + unit * rng.randrange(0, 8)
                     + [rng.randrange(letters) for _ in range(rng.randrange(0, 30))] + unit * rng.randrange(0, 6))
    rules = RunRules(ratio=ratio, least=least, steps=3, slab=64)
    assert caught(texts, rules) == [plain_runs(t, ratio, least) for t in texts]
    assert sum(map(len, caught(texts, rules))) > 100


def test_long_repetitions_stay_cheap():
    n = 300_000
    fib = [0]
    a, b = [0], [0, 1]
    while len(b) < 20_000:
        a, b = b, b + a
    assert caught([[7] * n]) == [[(0, n, 1)]]
    assert caught([[1, 2, 3] * 60_000, list(range(9)), [5] * 5, [5] * 6]) == [[(0, 180_000, 3)], [], [], [(0, 6, 1)]]
    unit = list(range(40_000))
    assert caught([unit * 4 + unit[:5]]) == [[(0, 160_005, 40_000)]]
    assert caught([b]) == [[]]  # a Fibonacci word holds no fourth power
    assert fib == [0]


def test_operator_rows(spark):
    rows = [(1, "x a b a b a b a b y"), (2, None), (3, ""), (3, " \t\n"), (None, "z z z z z z z"),
            (1, "x a b a b a b a b y"), (4, "a  a  a  a  a  a  ".replace(" ", "\x0b"))]
    docs = spark.createDataFrame([(*r, 5, "c", [1]) for r in rows], "doc_id long, text string, id int, collapsed string, runs array<int>")
    got = sorted(periodic.find_runs(docs).collect(), key=str)
    want = [(1, 10, [(1, 8, 2)], "x a b y"), (2, 0, [], ""), (3, 0, [], ""), (3, 0, [], ""), (None, 7, [(0, 7, 1)], "z"),
            (1, 10, [(1, 8, 2)], "x a b y"), (4, 6, [(0, 6, 1)], "a ")]
    assert sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3]) for r in got), key=str) == sorted(want, key=str)
    assert periodic.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(docs, RunRules(ratio=1))


def test_text_longer_than_a_piece(spark):
    words = [f"w{i}" for i in range(200_000)] + ["u", "v"] * 300_000
    docs = spark.createDataFrame([(9, "\n".join(words))], "doc_id long, text string")
    row = periodic.find_runs(docs).first()
    assert [tuple(x) for x in row["runs"]] == [(200_000, 600_000, 2)] and row["n_words"] == 800_000
    assert row["collapsed"] == " ".join(words[:200_002])


def plain_row(doc_id, text):
    words = "".join(" " if c in SPACES else c for c in text or "").split(" ")
    words = [w for w in words if w]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(12)
    rows = [(i, rng.choice(["", "  "]) + rng.choice(SPACES).join(rng.choice(["a", "b", "é", f"w{rng.randrange(50)}"]) for _ in range(rng.randrange(0, 120))))
            for i in range(400)] + [(400, None), (401, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    cols = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted(tuple(r) for r in registry.op12_periodic(spark, str(tmp_path)).select(*cols).collect())
    assert got == sorted(plain_row(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > 20
