"""Packing: exact round trip against the tokenizer, mixture, brute force."""

import json
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from martcraft.llm import packing as P

SCHEMA = "doc_id long, text string, source string, start string, ids int"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.default_tokenizer())


def corpus():
    rng = random.Random(4)
    odd = ["", None, " \t\n", "don't we'll IT'S", "Σίσυφος ΑΣ ὈΔΥΣΣΕΎΣ", "é ́x İstanbul", "a b c\x1cd\x85e", "½ ² Ⅷ 1234 x5y",
           "<|endoftext|> mid<|endoftext|>dle <|startoftext|>", "Ünïcode, wörds!! ?? ÀÖØöøÿ ×÷", "𝄞 日本語 テキスト 한국어 가", "a,b;c:d... e!", "x" * 3000]
    rows = [(i, t, "odd", "s", 1) for i, t in enumerate(odd)]
    for i in range(len(odd), 240):
        n = rng.choice([5, 80, 400, 1500])
        rows.append((i, " ".join(rng.choice(["the", "Mächtig,", "été", "runs.", "quick", "zzyx", "über"]) + rng.choice(["", "s", "42"]) for _ in range(n)),
                     rng.choice(["a"] * 6 + ["b", "c", None]), "s", 2))
    return [*rows, rows[20], (None, "no id here", "a", None, None)]


def check(rows, pieces, tokenizer):
    want = {}
    for i, t, *_ in rows:
        want.setdefault(i, []).append(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4"))
    seqs, covered = {}, {}
    for p in pieces:
        ids = next(x for x in want[p.doc_id])
        assert p.doc_tokens == len(ids)
        part = ids[p.start:p.start + p.length]
        assert len(part) == p.length and zlib.crc32(part.tobytes()) == p.ids_crc32
        assert p.ids == part.tolist()
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
        covered.setdefault(p.doc_id, np.zeros(len(ids), int))[p.start:p.start + p.length] += 1
    for i, c in covered.items():
        assert (c == len(want[i])).all()
    assert set(covered) == set(want)
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at == 4096 or at & (at - 1) == 0
    assert sorted(seqs) == list(range(len(seqs)))


@pytest.mark.parametrize("size", [1 << 20, 9000])
def test_round_trip(spark, tokenizer, size):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = P.pack(df, P.PackRules(chunk_tokens=size), with_ids=True).collect()
    check(rows, out, tokenizer)


def test_runs_equal_whole_text(tokenizer):
    enc = P.WordIds(P.default_tokenizer())
    for _, t, *_ in corpus()[:60]:
        got = np.frombuffer(enc.encode((t or "").encode()), "<u2").tolist()
        assert got == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_any_run_equals_the_general_path(tokenizer):
    enc, rng = P.WordIds(P.default_tokenizer()), random.Random(5)
    letters = "abcDEFtheING019'!?.,;:#$%&*|<>=+()_-@/\\~^`{}[]\"é\x7f\x1c"
    runs = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(6000)}
    added = [t["content"] for t in json.loads(tokenizer.to_str())["added_tokens"]]
    runs |= {a + b + c for a in ("", "x", "(") for b in [*added, *map(str.upper, added), "<|", "don't", "it's9", "Ü12!"] for c in ("", "y", ".")}
    for run in runs:
        assert np.frombuffer(enc[run.encode()], "<u2").tolist() == tokenizer.encode(run, add_special_tokens=False).ids, run


def test_mixture_is_held_in_every_window():
    rng = random.Random(1)
    names = ["hot"] * 6 + ["b", "c", "d"]
    entries = [(rng.choice(names), rng.randint(50, 3000)) for _ in range(3000)]
    total = sum(n for _, n in entries)
    share = {s: sum(n for x, n in entries if x == s) / total for s in set(names)}
    out = P.fill([e[0] for e in entries], [e[1] for e in entries], [(s, w, 0.0) for s, w in share.items()], 4096, 256)
    windows = total // 4096
    served = {s: np.zeros(windows) for s in share}
    for k, _, n, seq, _ in out:
        if seq < windows:
            served[entries[k][0]][seq] += n
    for s, w in share.items():
        drift = np.cumsum(served[s]) - w * 4096 * np.arange(1, windows + 1)
        assert np.abs(drift[: int(windows * 0.95)]).max() < 1100, s


def test_deficit_is_carried():
    """A queue that is owed tokens comes first."""
    out = P.fill(["a", "b"], [20_000, 20_000], [("a", 0.5, -4096.0), ("b", 0.5, 4096.0)], 4096, 256)
    first = {}
    for k, _, n, seq, _ in out:
        first.setdefault(seq, {0: 0, 1: 0})[k] += n
    assert first[0][1] == 4096 and first[0][0] == 0
    assert first[3] == {0: 2048, 1: 2048}


def test_targets_and_empty(spark, tokenizer):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    check(rows, P.pack(df, P.PackRules(targets=(("a", 0.2), ("b", 0.8))), with_ids=True).collect(), tokenizer)
    assert P.pack(df.where("false")).count() == 0


def shares(out, names):
    """Tokens of each source in every full window."""
    size = {}
    for p in out:
        size[p.sequence_id] = size.get(p.sequence_id, 0) + p.length
    full = sorted(i for i, n in size.items() if n == 4096)
    row = {i: k for k, i in enumerate(full)}
    got = np.zeros((len(full), len(names)))
    for p in out:
        if p.sequence_id in row:
            got[row[p.sequence_id], names.index(p.source)] += p.length
    return got


def clustered(spark, counts, words=700):
    """Rows sorted by source, over as many partitions."""
    rows = [(i, " ".join(f"w{(i * 31 + j) % 400}" for j in range(words)), s) for i, s in enumerate(s for s, n in counts.items() for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).repartitionByRange(len(counts), "source")


def test_sources_in_long_runs_are_mixed(spark):
    names = ["a", "b", "c"]
    df = clustered(spark, {"a": 300, "b": 200, "c": 100})
    got = shares(P.pack(df, P.PackRules(span_tokens=1 << 17, chunk_tokens=1 << 16)).collect(), names)
    assert len(got) > 200
    kept = got[: int(0.97 * len(got))]
    # every run of windows holds the sources' shares, to a few pieces
    for k in range(0, len(kept) - 8, 4):
        assert np.abs(kept[k:k + 8].sum(axis=0) / (8 * 4096) - [1 / 2, 1 / 3, 1 / 6]).max() < 0.06, k
    assert (kept[:, 0] > 0).all()


def test_targets_other_than_the_supply_hold_until_a_source_runs_out(spark):
    names = ["a", "b", "c"]
    df = clustered(spark, {"a": 300, "b": 100, "c": 50})
    rules = P.PackRules(targets=(("a", 0.25), ("b", 0.75)), span_tokens=1 << 17)
    got = shares(P.pack(df, rules).collect(), names)
    per = got.sum() / 450
    until = int(100 * per / 0.75 / 4096)      # b runs out
    assert np.abs(got[: until - 4].mean(axis=0) / 4096 - [0.25, 0.75, 0]).max() < 0.02
    for k in range(0, until - 12, 4):
        assert np.abs(got[k:k + 8].sum(axis=0) / (8 * 4096) - [0.25, 0.75, 0]).max() < 0.06, k
    then = got[until + 4: int((400 * per) / 4096) - 40]
    assert len(then) > 50 and (then[:, 0] == 4096).all() and got[-20:, 2].sum() > 0.9 * 20 * 4096


def test_phases():
    got = P.phases({"a": 100, "b": 300, "z": 9}, {"a": 1.0, "b": 1.0, "z": 0.0})
    assert got == [{"a": (0.0, 100.0), "b": (0.0, 100.0)}, {"b": (100.0, 300.0)}]


@pytest.mark.parametrize("span", [1 << 12, 3000, 1 << 16])
def test_many_small_sources_round_trip(spark, tokenizer, span):
    rng = random.Random(span)
    rows = [(i, " ".join(rng.choice(["the", "quick", "zz9", "été"]) for _ in range(rng.choice([0, 3, 90, 900]))), rng.choice(["hot"] * 40 + [f"s{k}" for k in range(40)] + [None]),
             "s", 1) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = P.pack(df, P.PackRules(span_tokens=span, chunk_tokens=7000, min_piece=64), with_ids=True).collect()
    check(rows, out, tokenizer)
    targets = P.PackRules(span_tokens=span, chunk_tokens=7000, targets=(("hot", 0.5), ("s1", 0.5), ("none", 0.3)))
    check(rows, P.pack(df, targets, with_ids=True).collect(), tokenizer)
