"""Mixing: totals meet the targets; projected gradient in plain numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from martcraft.llm import mixing as M
from martcraft.llm.common import held_out, read

SCHEMA = "doc_id long, text string, rate string, p int, n_chars int"
LABELS = "doc_id long, quality int, toxic int, extra string"


def tables(spark):
    rng = random.Random(5)
    good, bad = [f"fine{i}" for i in range(40)], [f"nasty{i}" for i in range(6)]
    docs, labels = [(0, None, "r", 1, 0), (1, "", "r", 1, 0), (2, " \n", "r", 1, 0)], []
    for i in range(3, 400):
        toxic = i % 5 == 0
        text = [rng.choice(good) for _ in range(rng.randint(20, 200))]
        if toxic:
            text[::6] = [rng.choice(bad) for _ in text[::6]]
        docs.append((i, " ".join(text), "r", 1, 3))
        if i % 2:
            labels.append((i, 1, int(toxic), "z"))
    docs += [docs[50], (None, docs[60][1], None, None, None)]
    labels += [(None, 1, 1, None), (7, None, 1, None), (9999, 1, 0, "")]
    return spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(labels, LABELS), docs


RULES = M.MixRules(bits=10, targets=(("quality=1,toxic=1", 0.05),))


def test_totals_meet_targets(spark):
    docs, labels, rows = tables(spark)
    out = M.mix(docs, labels, RULES).collect()
    assert len(out) == len(rows)
    assert out[0].domains == ["quality=1,toxic=0", "quality=1,toxic=1"]
    p = np.array([r.p for r in out])
    tokens = np.array([r.tokens for r in out], float)
    rate = np.array([r.rate for r in out])
    assert (np.abs(p.sum(axis=1) - 1) < 1e-9).all() and (rate >= 0).all()
    assert sorted(tokens) == sorted(len((t or "").split()) for _, t, *_ in rows)
    want = tokens.sum() * np.array([0.95, 0.05])
    assert np.abs((tokens * rate) @ p - want).sum() < 2e-3 * tokens.sum()
    inverse = np.linalg.inv((p * tokens[:, None]).T @ p)
    # the same steps in plain numpy, totals taken from the rates themselves
    total = lambda x: (tokens * x) @ p
    r = before = np.ones(len(p))
    since, off = 0, np.inf
    for _ in range(RULES.max_steps):
        worse, off = np.abs(total(r) - want).sum() > off, np.abs(total(r) - want).sum()
        if off <= RULES.tolerance * tokens.sum():
            break
        since = 0 if worse else since
        v = r + since / (since + 3) * (r - before)
        before, r = r, np.maximum(0, v - p @ (inverse @ (total(v) - want)))
        since += 1
    assert np.abs(r - rate).max() < 1e-6
    right = [r.domain.endswith("toxic=1") == (r.doc_id % 5 == 0) for r in out if r.doc_id is not None and r.doc_id > 2]
    assert np.mean(right) > 0.97


def test_resample_and_edges(spark):
    docs, labels, _ = tables(spark)
    rated = M.mix(docs, labels, RULES)
    out = M.resample(docs, labels, RULES)
    assert out.columns == docs.columns
    assert out.count() == rated.agg(F.sum("copies")).first()[0]
    assert M.mix(docs.where("false"), labels, RULES).count() == 0
    alone = M.mix(docs, labels.where("false"), RULES).collect()
    assert {r.domain for r in alone} == {"all"} and {r.rate for r in alone} == {1.0}


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_held_out_labels_come_nearer_to_their_targets(spark, sf):
    """By the label table, not by the posteriors, on labels the fit never saw."""
    docs, labels = read(spark, f"/root/testdata/sf{sf}", "documents"), read(spark, f"/root/testdata/sf{sf}", "labels")
    rows = M.mix(docs, labels.where(~held_out())).join(labels.where(held_out()), "doc_id").where("quality is not null and toxic is not null").collect()
    assert rows[0].residual <= M.MixRules().tolerance
    named, names = dict(M.MixRules().targets), rows[0].domains
    of = [f"quality={r.quality},toxic={r.toxic}" for r in rows]
    share = lambda w: np.array([sum(x for x, d in zip(w, of) if d == n) for n in names]) / sum(w)
    before, after = share([r.tokens for r in rows]), share([r.tokens * r.rate for r in rows])
    want = np.array([named.get(n, 0.0) for n in names])
    want += (1 - want.sum()) * (want == 0)
    # each nearer, or near already: the smallest domain has some 25 held-out documents
    assert (np.abs(after - want) <= np.maximum(np.abs(before - want), 0.035)).all(), (names, before, after)
    assert np.abs(after - want).sum() < np.abs(before - want).sum()


def test_residual_and_clashing_names(spark):
    docs, labels, _ = tables(spark)
    extra = docs.withColumnsRenamed({"rate": "_k"}).withColumn("_id", F.lit("x")).withColumn("domain", F.lit(1))
    assert M.resample(extra, labels, RULES).columns == extra.columns
    with pytest.warns(UserWarning, match="off their targets"):
        off = M.mix(docs, labels, M.MixRules(bits=10, targets=RULES.targets, max_steps=0)).first().residual
    assert off > 0.01


def test_goals():
    own = np.array([600.0, 300.0, 100.0, 0.0])
    names = ["a", "b", "c", "d"]
    assert M.goals(names, own, (("b", 0.5),)).tolist() == [500 * 600 / 700, 500, 500 * 100 / 700, 0]
    assert abs(M.goals(names, own, (("a", 0.9), ("d", 0.1))).sum() - 1000) < 1e-9


def test_both_metrics_share_their_passes(spark, monkeypatch):
    """Targets out of reach: two descents, one pass over the rows for a step of both."""
    p = [[0.9, 0.1], [0.8, 0.2], [0.85, 0.15]]
    rows = spark.createDataFrame([(10 * i + 5, p[i % 3]) for i in range(30)], "tokens long, p array<double>").repartition(2)
    passes, totals = [], M.totals
    monkeypatch.setattr(M, "totals", lambda *a, **k: passes.append(a) or totals(*a, **k))
    rules = M.MixRules(targets=(("b", 0.01),), max_steps=4)
    with pytest.warns(UserWarning, match="off their targets"):
        fit = M.fit_rates(rows, ["a", "b"], rules)
    assert len(passes) == 5
    tokens = np.array([10 * i + 5 for i in range(30)], float)
    every = np.array([p[i % 3] for i in range(30)])
    y = (tokens * M._rates(every, fit.steps)) @ every
    assert abs(np.abs(y - tokens.sum() * np.array([0.99, 0.01])).sum() / tokens.sum() - fit.residual) < 1e-9


def test_distinct():
    x = np.random.default_rng(0).integers(0, 50, 200)
    assert M._distinct(x).tolist() == sorted(set(x.tolist())) and len(M._distinct(x[:0])) == 0
