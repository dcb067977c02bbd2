"""Placement against a plain version of the table, balance, few moves."""

from collections import Counter

import pytest

from martcraft.llm import sharding as S

SCHEMA = "doc_id long, text string, shard string, slot int"


def slow_table(names, size, weights=None):
    order = sorted(names)
    lists = {}
    for n in order:
        a, b = S._preference(n, size)
        lists[n] = iter([(a + j * b) % size for j in range(size)])
    table, left = {}, size
    while left:
        for n in order:
            for _ in range((weights or {}).get(n, 1)):
                if left:
                    s = next(x for x in lists[n] if x not in table)
                    table[s] = n
                    left -= 1
    return [table[s] for s in range(size)]


def test_refused_plans():
    for shards, size, weights in ((("a", "b"), 7, {"a": 0, "b": 0}), (("a", "b"), 7, {"a": -1}), (("a", "b", "c", "d"), 3, None)):
        with pytest.raises(ValueError):
            S.lookup_table(shards, size, weights)
    assert set(S.lookup_table(("a", "b"), 7, {"a": 0})) == {1}


def test_table():
    names = tuple(f"n{i}" for i in (3, 1, 2, 7, 5))
    got = [names[k] for k in S.lookup_table(names, 257)]
    assert got == slow_table(names, 257)
    heavy = [names[k] for k in S.lookup_table(names, 257, {"n7": 3})]
    assert heavy == slow_table(names, 257, {"n7": 3})
    assert Counter(heavy)["n7"] > 2 * Counter(heavy)["n1"]
    with pytest.raises(ValueError):
        S.lookup_table(names, 256)
    with pytest.raises(ValueError):
        S.lookup_table(("a", "a"), 257)


def test_balance_and_few_moves():
    t = S.lookup_table()
    n = Counter(t.tolist())
    assert len(n) == len(S.SHARDS) and max(n.values()) - min(n.values()) <= 1
    fewer = S.lookup_table(S.SHARDS[:-1])
    stay = sum(S.SHARDS[a] == S.SHARDS[b] for a, b in zip(t, fewer))
    assert stay > 0.9 * len(t)


def test_place(spark):
    rows = [(i, "x", "s", 1) for i in range(500)] + [(7, "", None, 2), (None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    names = tuple(f"n{i}" for i in range(7))
    got = S.place(df, names, 251).collect()
    table = slow_table(names, 251)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert all(r.shard_name == table[r.slot] == names[r.shard] for r in got)
    assert len({r.slot for r in got if r.doc_id == 7}) == 1
    assert S.place(df.where("false")).count() == 0
    assert S.place(df, names, 251, keep_row=True).select("__llm_row.*").columns == df.columns


def test_write(spark, tmp_path):
    df = spark.createDataFrame([(i, "x", "s", 1) for i in range(50)], SCHEMA)
    S.write_shards(S.place(df, ("a", "b"), 101), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50
