"""The production model predicts the tokens themselves from both sides."""

import random

import numpy as np

from martcraft.llm import hashing
from martcraft.llm import lm as L

RULES = L.LmRules()


def corpus(seed, docs):
    """200 triples of words, each as frequent as any other."""
    rng = random.Random(seed)
    return [" ".join(w for k in (rng.randrange(200) for _ in range(rng.randint(20, 100)))
                     for w in (f"open{k}", f"mid{k}", f"close{k}")) for _ in range(docs)]


def ids(words, texts):
    return [words.tokens(hashing.hashed_words([t.encode()], [0])[1]).astype("<u4").tobytes() for t in texts]


def test_shuffled_documents_score_lower(spark):
    df = spark.createDataFrame(list(enumerate(corpus(1, 3000))), "doc_id long, text string").repartition(2)
    words = L.vocabulary(L.word_counts(df), RULES)
    # every vocabulary word has an input row and a class place of its own
    assert len(set(words.inputs.tolist())) == len(words.inputs)
    assert len(set(zip(words.klass.tolist(), words.member.tolist()))) == len(words.klass)
    net = L.train(L.encode(df, words), words, RULES)
    fresh, rng = corpus(99, 40), random.Random(0)
    shuffled = [" ".join(rng.sample(t.split(), len(t.split()))) for t in fresh]
    good, n = L.token_scores(net, words, ids(words, fresh))
    bad, _ = L.token_scores(net, words, ids(words, shuffled))
    ends = np.cumsum(n)[:-1]
    each = [a.mean() - b.mean() for a, b in zip(np.split(good, ends), np.split(bad, ends))]
    assert np.mean(each) > 1 and min(each) > 0
    assert good.mean() > -np.log(600) + 1


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(0, "a b c a b d e"), (1, "b c a")], "doc_id long, text string")
    words = L.vocabulary(L.word_counts(df), RULES)
    net = L.Network(words, RULES)
    for i in (2, 4):
        net.parts[i] += np.random.default_rng(3).normal(size=net.parts[i].shape).astype(np.float32)
    sides = np.array([[0, 1], [3, 2], [1, 4], [2, 2]], np.int32)
    every = np.arange(len(words.klass))
    both = [net.token_log_probs(np.repeat(sides[:, i:i + 1], len(every), axis=1), words.klass, np.arange(len(words.klass))) for i in (0, 1)]
    assert all(abs(np.exp(p).sum() - 1) < 1e-3 for p in both)
    # the sides change the tokens' shares inside a class
    inside = [p[words.klass == 3] - np.log(np.exp(p[words.klass == 3]).sum()) for p in both]
    assert np.abs(inside[0] - inside[1]).max() > 0.1


def test_gradient():
    h = np.arange(1, 40, dtype=np.uint64)
    words = L._every_token(h, np.arange(39.0, 0, -1), np.zeros(8), np.zeros(8), L.LmRules(rare=8, classes=5))
    rules = L.LmRules(rare=8, classes=5, width=3)
    net, rng = L.Network(words, rules), np.random.default_rng(0)
    sides, x = rng.integers(0, 47, (4, 50)), rng.integers(0, 47, 50)
    loss = lambda: -float(net.token_log_probs(sides, words.klass[x], x).astype(float).mean())
    net.parts = [p.astype(float) for p in net.parts]
    rows, grads = net.gradient(sides, words.klass[x], x)
    for i, g in enumerate(grads):
        full = net.parts[i] if rows[i] is None else net.parts[i].reshape(-1, net.parts[i].shape[-1])
        for at in [tuple(rng.integers(0, d) for d in g.shape) for _ in range(5)]:
            k = at if rows[i] is None else (rows[i][at[0]], at[1])
            was = full[k]
            full[k] = was + 1e-2
            up = loss()
            full[k] = was - 1e-2
            down = loss()
            full[k] = was
            assert abs((up - down) / 2e-2 - g[at]) < 2e-4 + 2e-2 * abs(g[at]), (i, at)


def test_rounds_cover_every_window(spark, monkeypatch):
    lengths = np.array([0, 7, 1, 12, 0, 3])
    for stride in (1, 2, 5):
        taken = np.concatenate([L.turn_windows(lengths, turn, stride) for turn in range(stride)])
        assert sorted(taken) == list(range(23))
    # a partition's model reports the windows it has learned from
    rounds, whole = [], L.stage

    def seen(df, name):
        out = whole(df, name)
        if name == "lm-models":
            rounds.append(sum(r.seen for r in out.collect()))
        return out

    monkeypatch.setattr(L, "stage", seen)
    texts = corpus(2, 30)
    L.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), RULES)
    assert sum(rounds) == sum(len(t.split()) for t in texts)


def test_scores_are_plain_sums(spark, monkeypatch):
    """Every document's score from the parameters, token by token."""
    nets, train = [], L.train
    monkeypatch.setattr(L, "train", lambda *a: nets.append((train(*a), a[1])) or nets[-1][0])
    texts = [*corpus(4, 40), "", "one", None, "new words that nobody wrote"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in L.score(df, RULES).collect()}
    net, words = nets[0]
    e, bias, w, b, tree, turn = [p.astype(float) for p in net.parts]
    for i, t in enumerate(texts):
        tok = words.tokens(hashing.hashed_words([(t or "").encode()], [0])[1])
        line = [words.boundary] * 2 + words.inputs[tok].tolist() + [words.boundary] * 2
        total = 0.0
        for j, x in enumerate(tok):
            h = np.tanh(bias + sum(e[k, line[j + 2 + s]] for k, s in enumerate(L.SIDES)))
            z = h @ w + b
            total += z[words.klass[x]] - np.log(np.exp(z - z.max()).sum()) - z.max() + words.share[x]
            node, place = 0, int(words.member[x])
            for level in reversed(range(net.depth)):
                right = place >> level & 1
                row = int(words.klass[x]) * ((1 << net.depth) - 1) + node
                u = float(tree[row] @ h + turn[row, 0])
                total -= np.logaddexp(0, -u if right else u)
                node = 2 * node + 1 + right
        assert got[i].n_tokens == len(tok)
        assert abs(got[i].log_likelihood - total) < 1e-2 + 1e-3 * abs(total), i


def test_changes_are_averaged_by_the_steps_that_met_a_row():
    h = np.arange(1, 20, dtype=np.uint64)
    rules = L.LmRules(rare=8, classes=3, width=2)
    words = L._every_token(h, np.ones(19), np.zeros(8), np.zeros(8), rules)
    sent, nets = [], []
    for k, met in enumerate((0, 1)):
        net = L.Network(words, rules)
        before = [p.copy() for p in net.parts]
        touched = [np.zeros(net.sparse_rows(i), int) for i in range(len(net.parts))]
        net.parts[0][0, met] += k + 1.0          # a row of its own each
        net.parts[0][1, 5] += 4.0 * (k + 1)      # one that both have met
        touched[0][met] = 3
        touched[0][net.shapes[0][1] + 5] = 1 + 2 * k
        net.parts[1] += k
        sent.append(L.changes(net, before, touched, 10 * (k + 1)))
        nets.append(net)
    mean, weight = L.merged(nets[0], sent)
    assert np.allclose(mean[0][0, 0], 1) and np.allclose(mean[0][0, 1], 2)
    assert np.allclose(mean[0][1, 5], (4 + 3 * 8) / 4, atol=1e-2)
    assert np.allclose(mean[1], 20 / 30, atol=1e-3) and not mean[0][2].any() and weight[1] == 30


def test_run_sums():
    """Sums of runs, long and short, with and without a long one at the end."""
    rng = np.random.default_rng(1)
    for lengths in ([1], [30], [1, 2, 8, 7, 9, 1, 40, 3], [9, 9, 1, 2, 12], [1, 1, 5]):
        index = np.repeat(np.arange(len(lengths)), lengths)
        rows = rng.normal(size=(len(index), 3))
        starts, found = L._runs(index)
        assert found.tolist() == sorted(lengths, reverse=True)
        want = np.array([rows[index == i].sum(axis=0) for i in index[starts]])
        assert np.allclose(L._run_sums(rows, starts, found), want)


def test_order_of_windows_is_no_matter():
    """Gradients of windows as they come and in the order of their nodes."""
    rules = L.LmRules(rare=8, classes=5, width=3)
    words = L._every_token(np.arange(1, 40, dtype=np.uint64), np.arange(39.0, 0, -1), np.zeros(8), np.zeros(8), rules)
    net, rng = L.Network(words, rules), np.random.default_rng(0)
    sides, x = rng.integers(0, 47, (4, 300)), rng.integers(0, 47, 300)
    order = net.ordered(x)
    assert (np.diff(net.node[:, x[order]], axis=1) >= 0).all()
    one = net.gradient(sides, words.klass[x], x)
    two = net.gradient(sides[:, order], words.klass[x[order]], x[order])
    for (r, g), (s, d) in zip(zip(*one), zip(*two)):
        if r is not None:
            assert len(set(r.tolist())) == len(r)
            g, d = g[np.argsort(r)], d[np.argsort(s)]
        assert np.allclose(g, d, atol=1e-6)
