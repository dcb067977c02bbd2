"""Fuzzy lexicon against plain edit distances; scores on labelled rows."""

import random

from pyspark.sql import functions as F

from martcraft.llm import toxicity as T
from martcraft.llm.common import read

SCHEMA = "doc_id long, text string, lang string, score string, held_out int"


def distance(a, b):
    """Edits and swapped neighbours (a swap is not edited further)."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_automaton_equals_edit_distance():
    rng = random.Random(2)
    words = ["idiot", "moron", "worthless", "scum", "disgusting", "abcab", "mororn"]
    trie = T.FuzzyTrie(words, ["veque", "lowei"])
    tries = list(words) + ["", "vequ", "veque", "vequemo", "vxque", "id1ot", "idoit", "wrothles", "worthlss", "disgutsign", "scums", "abca", "morron"]
    for w in words * 60:
        for _ in range(rng.randint(0, 3)):
            i, k = rng.randrange(len(w) + 1), rng.randrange(4)
            w = (w[:i] + rng.choice("abcdiotx") + w[i:] if k == 0 else w[:i] + w[i + 1:] if k == 1
                 else w[:i] + rng.choice("abmosx") + w[i + 1:] if k == 2 else w[:i] + w[i + 1:i + 2] + w[i:i + 1] + w[i + 2:])
        tries.append(w)
    for w in tries:
        near = any(distance(w, t) <= T.allowed(t) for t in words)
        stem = w.startswith(("veque", "lowei"))
        kind = trie.kind(w)
        assert (kind == T.FuzzyTrie.WORD) == (w in words), w
        assert (kind == T.FuzzyTrie.STEM) == (stem and w not in words), w
        if not stem:
            assert (kind > 0) == near, w


def test_quotation():
    quoted = lambda s, i: T._quoted(s.split(), i, 6)
    assert quoted('he said "you idiot" to me', 3)
    assert quoted("the word “idiot” is rude", 2)
    assert quoted('they wrote "what a total idiot here" then', 5)
    assert not quoted("you idiot of a man", 1)
    assert not quoted('"hello there" you idiot and "bye now"', 3)


def rows():
    rng = random.Random(8)
    plain = [f"word{i}" for i in range(60)] + ["moran"]
    nasty = ["idiot", "pathetic", "scumbag", "moron"]
    docs, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 90))]
        toxic = i % 4 == 0
        if toxic:
            for k in rng.sample(range(len(words)), 4):
                words[k] = rng.choice(nasty)
        docs.append((i, " ".join(words), "en", None, 0))
        labels.append((i, 1, int(toxic), "x"))
    return docs, labels


def test_learned_scores(spark):
    docs, labels = rows()
    clean = " ".join(f"word{i}" for i in range(30))
    odd = [(1000, None), (1001, ""), (1002, "Word1 word2 IDIOT, word3 pahtetic! word4 m0ron word5 scumbags"), (1003, clean + ' they said "idiot" and "moron" word1 word2'),
           (1004, clean + " moran " * 9), (1005, clean * 4000), (None, "idiot idiot moron word1")]
    df = spark.createDataFrame(docs + [(i, t, None, "z", None) for i, t in odd] + docs[:1], SCHEMA).repartition(3)
    marks = spark.createDataFrame([*labels, (None, 1, 1, ""), (5, 0, None, None)], "doc_id long, quality int, toxic int, text string")
    model = T.fit(df, marks)
    assert {"idiot", "pathetic", "scumbag", "moron"} <= set(model.words) and len(model.words) < 10
    assert "moran" in model.ordinary
    got = T.score(df, model).collect()
    assert len(got) == len(docs) + len(odd) + 1
    by = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert [by[i].predicted for i in (1000, 1001, 1002, 1003, 1004, 1005, None)] == [0, 0, 1, 0, 0, 0, 1]
    assert by[1002].n_fuzzy == 3 and by[1003].n_quoted == 2
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in held) >= 0.98 * len(held)
    assert T.score(df.where("false"), model).count() == 0


def test_no_labels_and_held_out_rows(spark):
    docs, labels = rows()
    df = spark.createDataFrame(docs, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")
    empty = T.fit(df, marks.where("false"))
    assert {r.score for r in T.score(df, empty).collect()} == {0.0}
    flipped = marks.withColumn("toxic", F.when(T.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.fit(df, marks), T.fit(df, flipped)
    assert a.words == b.words and a.stems == b.stems and (a.weights == b.weights).all()


def test_held_out_accuracy(spark):
    docs, labels = (read(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    got = T.score(docs, T.fit(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out")
    right = got.select(F.avg((F.col("toxic") == F.col("predicted")).cast("int"))).first()[0]
    assert right > 0.93
