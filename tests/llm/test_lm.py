"""Language-model scores: normalised, equal to a plain sum, better than counts."""

import random
from dataclasses import replace

import numpy as np

from martcraft.llm import hashing
from martcraft.llm import lm as L

SCHEMA = "doc_id long, text string, n_tokens string"
RULES = L.LmRules(vocabulary=64, rare=16, own_class=8, classes=16, own_input=24, width=8, stride=1, batch=256, rate=0.03)


def corpus(seed=1, docs=60):
    """Sentences with a pattern that both sides reveal: a b c after a, c."""
    rng = random.Random(seed)
    out = []
    for _ in range(docs):
        words = []
        for _ in range(rng.randint(3, 60)):
            k = rng.randrange(4)
            words += [f"open{k}", f"mid{k}", f"close{k}"]
            if rng.random() < 0.1:
                words.append(f"rare{rng.randrange(10_000)}")
        out.append(" ".join(words))
    return out


def rows():
    texts = [None, "", " \n", "Single", *corpus()]
    out = [(i, t, "x") for i, t in enumerate(texts)]
    return [*out, out[9], (None, texts[8], None)]


def plain(texts):
    """Vocabulary counted in Python."""
    counts = {}
    for t in texts:
        for h in hashing.hashed_words([t.encode()], [0])[1].tolist():
            counts[h] = counts.get(h, 0) + 1
    return counts


def test_hashes_follow_words():
    texts = [b"the cat  THE\ncat", None, b"", b"\tcat the", "é".encode()]
    at, h = hashing.hashed_words(texts, list(range(5)))
    assert at.tolist() == [0, 0, 0, 0, 3, 3, 4]
    assert h[0] == h[2] == h[5] and h[1] == h[3] == h[4] and len(set(h.tolist())) == 3
    many = [f"w{i}" for i in range(20000)]
    assert len(set(hashing.hashed_words([" ".join(many).encode()], [0])[1].tolist())) == 20000


def test_counts_and_scores(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    counts = L.word_counts(df)
    assert {np.int64(r.h).view(np.uint64): r.n for r in counts.collect()} == {
        np.uint64(h): n for h, n in plain([t for _, t, _ in data if t]).items()}
    words = L.vocabulary(counts, RULES)
    # within each class the shares of all words sum to 1
    types = {}
    for h in plain([t for _, t, _ in data if t]):
        tok = int(words.tokens(np.array([h], np.uint64))[0])
        types[tok] = types.get(tok, 0) + 1
    mass = np.zeros(RULES.classes)
    for tok, n in types.items():
        mass[words.klass[tok]] += n * np.exp(words.share[tok])
    assert (np.abs(mass[np.unique(words.klass[list(types)])] - 1) < 0.2).all()
    net = L.train(L.encode(df, words), words, RULES)
    got = {}
    for r in L.score(df, RULES).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(data)
    for i, t, _ in data:
        r = got[i][0]
        n = len((t or "").split())
        assert r.n_tokens == n
        if not n:
            assert r.log_likelihood == 0 and r.mean_log_likelihood is None
            continue
        tok = words.tokens(hashing.hashed_words([t.encode()], [0])[1])
        line = [words.boundary] * 2 + words.inputs[tok].tolist() + [words.boundary] * 2
        total = 0.0
        for j, x in enumerate(tok):
            z = net.parts[1] + sum(net.parts[0][k, line[j + 2 + s]] for k, s in enumerate(L.SIDES))
            z = np.tanh(z) @ net.parts[2] + net.parts[3]
            total += z[words.klass[x]] - z.max() - np.log(np.exp(z - z.max()).sum()) + words.share[x]
        assert abs(r.log_likelihood - total) < 1e-2 + 2e-3 * abs(total)


def test_learns_from_both_sides(spark):
    rules = replace(RULES, rounds=3)
    df = spark.createDataFrame([(i, t, "") for i, t in enumerate(corpus(docs=200))], SCHEMA).repartition(4)
    fresh = corpus(seed=99, docs=20)
    words = L.vocabulary(L.word_counts(df), rules)
    encoded = L.encode(df, words)
    net = L.train(encoded, words, rules)
    rng = random.Random(0)
    shuffled = [" ".join(rng.sample(t.split(), len(t.split()))) for t in fresh]

    def mean(texts):
        ids = [words.tokens(hashing.hashed_words([t.encode()], [0])[1]).astype("<u4").tobytes() for t in texts]
        return L.token_scores(net, words, ids)[0].mean()

    counts = np.bincount(words.klass[words.tokens(np.concatenate([hashing.hashed_words([t.encode()], [0])[1] for t in fresh]))], minlength=16)
    unigram = mean(fresh) - 0  # the network beats class counts alone by far
    baseline = (counts[counts > 0] / counts.sum() * np.log(counts[counts > 0] / counts.sum())).sum()
    assert mean(fresh) > mean(shuffled) + 0.5
    assert unigram > baseline


def test_average_tree_and_empty(spark, monkeypatch):
    monkeypatch.setattr(L, "FAN", 2)
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    assert L.score(df, RULES).count() == len(rows())
    assert L.score(df.where("false"), RULES).count() == 0
