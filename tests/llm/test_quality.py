"""Quality rules against a plain-Python version."""

import re
from collections import Counter

from martcraft.llm import quality as Q

SCHEMA = "doc_id long, text string, lang string, source string, kept string, n_words int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    again = {p for i, w in enumerate(windows) if seen[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))


def rows():
    base = "the of and to\tin is was that for it\x0bwith as his on be at by"
    texts = [None, "", "  \n\t ", "one", "one two", "a b c", "a a a a a", " lead\nlead\n lead\n\nx # *$", "x y z x y z", "  a b c\x1cd",
             base, base + "\n" + base, "ü é 𝄞 | <b> " * 40, " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i % 1500}" for i in range(3000)),
             " ".join(f"w{i} w{i % 7} q" for i in range(500)) + "\n" + " ".join(f"w{i} w{i % 7} q" for i in range(500))]
    clean = [" ".join(f"{c}{i}{j}" for j in range(80)) + "." for i, c in enumerate("abcdefgh" * 8)]
    out = [(i, t, "en" if i % 3 else None, "s" if i % 2 else None, "x", 7) for i, t in enumerate(texts + clean)]
    return [*out, out[5], out[5], (None, "p q r", None, None, None, None)]


def test_counts_and_verdict(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    got = Q.judge(df).collect()
    want = Counter((r[0], *counts(r[1])) for r in rows())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert {r.doc_id for r in got if r.kept} >= set(range(16, 80))


def test_thresholds_match_brute_force(spark, tmp_path):
    """Bins, merged levels and limits recomputed from the counts."""
    rules = Q.QualityRules(prior=6.0)
    data = []
    for i in range(60):
        group = ("en", "a") if i < 30 else ("en", "b") if i < 34 else ("de", None) if i < 50 else (None, "c")
        data.append((i, " ".join(f"{'#' * (i % 5)}w{j}{'x' * (i % 3)}" for j in range(60)), *group, "k", 0))
    got = {r.doc_id: r for r in Q.judge(spark.createDataFrame(data, SCHEMA), rules).collect()}

    def limit(values, q_mid, q_high, spread, slack):
        s = sorted(v if v < 64 else v >> (v.bit_length() - 6) << (v.bit_length() - 6) for v in values)
        at = lambda q: s[max(0, -(-int(len(s) * q * 100) // 100) - 1)]
        return at(q_high) + spread * (at(q_high) - at(q_mid)) + slack

    for i, _, lang, source, *_ in data:
        levels = [[r for r in data if r[2:4] == (lang, source)], [r for r in data if r[2] == lang], data]
        for name, *fence in rules.fences:
            own, middle, whole = ([got[r[0]][f"ratio_{name}"] for r in group] for group in levels)
            above = (len(middle) * limit(middle, *fence) + 6 * limit(whole, *fence)) / (len(middle) + 6)
            want = (len(own) * limit(own, *fence) + 6 * above) / (len(own) + 6)
            assert abs(got[i][f"max_{name}"] - want) < 1e-9, (i, name)


def test_fences_follow_the_group(spark):
    """A text with 30 % duplicated lines goes where lines never repeat and
    stays where that is usual."""
    def text(i, repeated):
        lines = [f"line{i} of{j} some{i}x{j} words{j} here{i}" for j in range(13)]
        marks = ["item"] * (repeated + 1) + [f"item{j}" for j in range(6 - repeated)]
        return "\n".join(x for j, line in enumerate(lines) for x in [line, *marks[j:j + 1]])

    data = [(i, text(i, 6 if i == 0 else 0), "en", "plain", "x", 0) for i in range(1500)]
    data += [(5000 + i, text(i, 6 if i % 10 == 0 else 0), "en", "lists", "x", 0) for i in range(1500)]
    got = {r.doc_id: r for r in Q.judge(spark.createDataFrame(data, SCHEMA).repartition(4)).collect()}
    assert got[0].ratio_dup_lines == got[5000].ratio_dup_lines == 300
    assert not any(r.base_failed for r in got.values())
    assert {k for k, r in got.items() if not r.kept} == {0}


def test_filter_keeps_columns_and_empty(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    kept = Q.filter_quality(df)
    assert kept.columns == df.columns
    assert kept.count() > 0 and kept.where("kept = 'x'").count() == kept.count()
    assert Q.filter_quality(df.where("false")).count() == 0
    assert Q.judge(df.where("false")).count() == 0


def test_no_python_in_plan(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    plan = Q.judge(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
