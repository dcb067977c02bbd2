"""SimHash linking against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from martcraft.llm import simhash as S
from martcraft.llm.components import components

SCHEMA = "doc_id long, text string, fp string, n_chars int"


def slow_fingerprint(text, n=4):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps, most=4):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= most:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def corpus():
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(300)]
    texts = [None, "", " \n", "A b C", "a B c", "Ünï \x1c x\x0by z q", "one two three four"]
    for _ in range(6):
        base = [rng.choice(vocab) for _ in range(rng.randint(30, 400))]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            texts.append(" ".join(own))
    texts += [" ".join(rng.choice(vocab) for _ in range(9000))] * 2
    rows = [(i * 3 + 1, t, "x", 1) for i, t in enumerate(texts)]
    return [*rows, rows[10], (None, texts[20], None, None), (None, "nobody else has this text at all", "y", 2)]


def test_fingerprint():
    for _, t, *_ in corpus():
        assert S.fingerprint(None if t is None else t.encode(), 4) == slow_fingerprint(t)


def test_plan_covers_every_pair():
    rng = random.Random(3)
    for most in (2, 3, 4, 6):
        for segments in (2, 3, 4, 5):
            plan = S._plan(most, segments)
            for _ in range(3000):
                x = sum(1 << b for b in rng.sample(range(64), most))
                assert any((x >> s & ((1 << w) - 1)).bit_count() <= r for s, w, r in plan)


@pytest.mark.parametrize("hot", [64, 2])
def test_near_duplicates(spark, hot, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 8)
    rows = corpus()
    got = S.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), hot_bucket=hot).collect()
    fps = [slow_fingerprint(r[1]) for r in rows]
    want = sorted(zip([r[0] for r in rows], fps, slow_components([r[0] for r in rows], fps)), key=str)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=str) == want
    assert len({w[2] for w in want}) < len(rows) / 2


def test_deduplicate(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    out = S.deduplicate(df)
    assert out.columns == df.columns
    fps = [slow_fingerprint(r[1]) for r in rows]
    comp = set(slow_components([r[0] for r in rows], fps)) - {None}
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(comp)
    assert ids.count(None) == 2
    assert S.deduplicate(df.where("false")).count() == 0


def test_shared_ids_are_decided_row_by_row(spark):
    """Rows with one id: equal rows leave one, others go with their own group."""
    long = " ".join(f"w{i}" for i in range(60))
    data = [(1, long, "a", 1), (1, long, "a", 1), (2, long, "b", 2), (2, "quite another text " * 9, "c", 3), (5, "quite another text " * 9, "d", 4),
            (7, "alone with words of its own here", "e", 5)]
    got = sorted(tuple(r) for r in S.deduplicate(spark.createDataFrame(data, SCHEMA)).collect())
    assert got == sorted({data[0], data[3], data[5]})


def test_groups_with_one_least_id_keep_a_row_each(spark):
    a, b = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    data = [(1, a, {"k": 1}, "x"), (1, b, {"k": 2}, "y"), (2, a, None, "x"), (3, b, {}, "y"), (1, b, {"k": 3}, "a")]
    df = spark.createDataFrame(data, "doc_id long, text string, extra map<string,int>, _id string")
    out = S.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == [data[4], data[0]]


def test_components_on_random_graphs(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 240)] + [(300, i) for i in range(301, 330)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    for n in near:
        if near[n] != {n}:
            seen, todo = {n}, [n]
            while todo:
                for x in near[todo.pop()] - seen:
                    seen.add(x)
                    todo.append(x)
            assert got[n] == min(seen)
    assert np.all([r <= n for n, r in got.items()])
