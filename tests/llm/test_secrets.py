"""Secret scan against the patterns run plainly, and planted secrets."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from martcraft.llm import common
from martcraft.llm import secrets as S

SCHEMA = "doc_id long, text string, spans string, n_chars long"


def slow_base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def rows():
    rng = random.Random(2)
    key = lambda n, chars="ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789": "".join(rng.choice(chars) for _ in range(n))
    words = "the quick onset thorwhion andered likely_name another2 thing of and it was that".split()
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [None, "", "token", "token=token: abcdefghijk", "api_key : 'abcdefgh1234' APIKEY=\"x.y-z/w+12345=\"", "ſecret=abcdefghij",
             "AKIA AKIAKIA1234567890AB AKIA12345678901", "é𝄞 passwd = short password:longenough", key(31, "0123456789abcdef"), key(32, "0123456789abcdef"),
             "token=" + key(40, "0123456789abcdef") + " " + key(64, "0123456789abcdef") * 2, "SECRET\n= abcdefghijkl", "secretsecret:abcdefgh_passwd=12345678"]
    texts += [prose(60) + " token = \"" + key(40) + "\" " + prose(20) for _ in range(40)]
    texts += ["ü " + prose(30) + " " + key(32) + " " + prose(2000) for _ in range(5)]
    texts += [prose(300) + " this_is_a_long_identifier_name_of_2 4785380592391135478538 " for _ in range(40)]
    out = [(i, t, "keep", len(t or "")) for i, t in enumerate(texts)]
    return [*out, out[-1], (None, "token=abcdefgh", None, None)]


def test_base_and_model_spans(spark):
    data = rows()
    got = sorted(S.find(spark.createDataFrame(data, SCHEMA).repartition(3)).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    data = sorted(data, key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(data)
    for r, (i, text, *_) in zip(got, data):
        base = slow_base(text)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(b[1] == k for b in base) for k in range(3)], i
        line = ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), i
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
        if i is not None and 53 <= i < 58:
            assert r.n_random == 1, i
            span = next(s for s in r.spans.split(",") if s.startswith("random"))
            _, s, e = span.split(":")
            assert re.fullmatch("[A-Za-z0-9]{32}", text[int(s):int(e)])
        if i is not None and i >= 58:
            assert r.n_random == 0, text[-70:]


def test_redact(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    out = S.redact(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[0].text is None and got[1].text == "" and got[2].text == "token"
    assert got[7].text == "é𝄞 passwd = short [SECRET]" and got[7].n_chars == len(got[7].text) and got[7].spans == "keep"
    assert got[4].text == "[SECRET]' [SECRET]\""
    for i, text, *_ in data:
        if i is not None and text and not slow_base(text) and i != 8 and not 53 <= i < 58:
            assert got[i].text == text
    assert S.redact(df.where("false")).count() == 0
    assert S.find(df.where("false")).count() == 0


def test_short_and_one_kind_strings_go_by_the_ratio(spark):
    """12- and 16-character keys and letters-only keys among ordinary words, at
    a false rate of at most 2 in 1,000 other words of that length."""
    rng = random.Random(4)
    alnum, letters = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789", "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
    key = lambda n, chars=alnum: "".join(rng.choice(chars) for _ in range(n))
    ends = ["ation", "ingness", "ership", "ability", "ement"]
    word = lambda: rng.choice(["the", "inter", "over", "under", "counter"]) + rng.choice(["nation", "stand", "form", "place", "port"]) + rng.choice(ends)
    docs, planted = [], {}
    for i in range(300):
        words = [word() for _ in range(80)]
        if i % 3 == 0:
            words[7] = f"token={key(40)}"
        if i % 3 == 1:
            planted[i] = key(12) if i % 2 else key(16) if i % 4 else key(24, letters)
            words[9] = planted[i]
        docs.append((i, " ".join(words), "x", 1))
    got = {r.doc_id: (t, [s.split(":") for s in r.spans.split(",") if s.startswith("random")]) for r in S.find(spark.createDataFrame(docs, SCHEMA)).collect()
           for t in [docs[r.doc_id][1]]}
    hits = {i: {t[int(a):int(b)] for _, a, b in spans} for i, (t, spans) in got.items()}
    found = {n: [p in hits[i] for i, p in planted.items() if len(p) == n] for n in (12, 16, 24)}
    assert all(len(f) >= 20 and sum(f) / len(f) >= 0.9 for f in found.values()), {n: sum(f) / len(f) for n, f in found.items()}
    wrong = sum(len(h - {planted.get(i)}) for i, h in hits.items())
    assert wrong <= 0.002 * 300 * 80


def test_scores_and_limits_equal_plain_ones():
    texts = [t.encode() for _, t, *_ in rows() if t] * 2
    rules = S.SecretRules()
    table = np.random.default_rng(0).normal(size=(S.CODES, S.CODES))
    table[:, 0] = 0
    scan = S.Scan(texts, rules)
    want = []
    for d, t in enumerate(texts):
        base, _ = S.base_spans(t, rules)
        for m in re.finditer(rb"[A-Za-z0-9+/_=-]{8,}", t):
            if not any(m.start() < e and s < m.end() for _, s, e in base):
                want.append((scan.first[d] + m.start(), scan.first[d] + m.end(), S.score_token(m[0], table)))
    starts, ends, ratio = scan.scored(table)
    assert list(zip(starts, ends)) == [w[:2] for w in want] and np.allclose(ratio, [w[2] for w in want])
    histogram = scan.histogram(table)
    assert histogram[:-1].sum() == len(want)
    limits = S.limits_of(histogram, S.SecretRules(false_rate=0.2, min_ratio=-999.0))
    labelled = sorted(100 * S.score_token(t[s:e], table) / (e - s) for t in texts for s, e in S.base_spans(t, rules)[1])
    cap = np.floor(labelled[(len(labelled) - 1) // 2]) / 100 * 0.3
    for k, low in enumerate(S.LENGTHS):
        own = [w[2] for w in want if np.searchsorted(S.LENGTHS, w[1] - w[0], "right") - 1 == k]
        tail = min(x for x in range(S.LOW, S.LOW + S.BINS + 1) if sum(np.floor(o) >= x for o in own) <= 0.2 * len(own))
        assert abs(limits[k] - min(tail, cap * low)) < 1e-9


def test_many_spans_in_one_text(spark):
    text = " ".join(f"token=abcdefgh{i}" for i in range(20_000))
    r = S.find(spark.createDataFrame([(1, text, "", 0)], SCHEMA)).first()
    assert r.n_assign == 20_000 and r.n_random == 0


def test_slices_are_bounded_by_bytes():
    texts = [b"x" * 700, None, b"", b"y" * 5000, *[b"z" * 100] * 30]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "_text"])] * 2
    got = list(common.byte_slices(batches + [batches[0].slice(0, 0)], "_text", 1000))
    assert [t for b in got for t in b.column("_text").to_pylist()] == texts * 2
    assert all(b.num_rows == 1 or sum(len(t or b"") for t in b.column("_text").to_pylist()) <= 1000 for b in got)
    assert len(got) == 2 * 5


def test_scans_hold_a_small_part_of_a_batch(spark, monkeypatch):
    """A worker's arrays are bounded by bytes of text, however many rows come at once."""
    sizes, scan = [], S.Scan.__init__

    def noted(self, texts, rules):
        sizes.append(sum(map(len, texts)))
        scan(self, texts, rules)

    monkeypatch.setattr(S.Scan, "__init__", noted)
    monkeypatch.setattr(S, "released", lambda run, keep=None: run)
    out = []
    frame = type("Frame", (), {"select": lambda s, *a: s, "sparkSession": spark, "columns": ["text"], "schema": {},
                               "mapInArrow": lambda s, run, schema: out.append(run)})()
    monkeypatch.setattr(S, "learn", lambda docs, rules: (np.zeros((S.CODES, S.CODES)), np.full(10, 9.0)))
    S.redact(frame)
    batch = pa.RecordBatch.from_arrays([pa.array(["password=abcdefgh1 " + "a word " * 3000] * 300)], names=["text"])
    got = [t for b in out[0](iter([batch])) for t in b.column("text").to_pylist()]
    assert got == ["[SECRET] " + "a word " * 3000] * 300
    assert max(sizes) <= 1_000_000 and sum(sizes) == 300 * 21019
