"""Secret scan: fixed patterns plus character Markov models.

Three patterns give the base spans (``assign``, ``access``, ``hex``). Two
first-order character models, one of random strings and one of ordinary
identifiers, are trained on labelled samples, all of them from the scanned
table: the values of the base spans are the random strings, every other token
is an ordinary one. Every token of ``min_length`` or more characters that
touches no base span, whatever it is made of, is compared by the
log-likelihood ratio of the two models; those at the limit of their length or
above become spans of kind ``random``.

Short strings carry less evidence, so the limits go by classes of length and
are learned from the samples too: the ratio that at most ``false_rate`` of the
class' ordinary tokens reach, but no more than 0.3 of what a labelled random
string of that length scores (the ordinary tokens may hold unlabelled secrets),
and ``min_ratio`` at least.

The texts are scanned three times, for transition counts, for a histogram of
ratios and for the spans. A scan sends one row a partition or a document's
spans; the counts are summed by Spark over all documents.

Spans are ``kind:start:end`` in code points, end exclusive, of the whole
match. Defined cases: null text is scanned as empty; an empty text has no
spans and the digest of the empty string; with no labelled sample the random
model is uniform; texts are scanned whole, in pieces of 1 MB or one text;
repeated rows and null ids come back each; an empty table gives an empty
result; ``redact`` leaves other columns untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from martcraft.llm.common import byte_slices, released, ship

ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ASSIGN_HINTS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")

#: Token characters get codes from 1; 0 is anything else.
TOKEN_CHARS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CODES = len(TOKEN_CHARS) + 1
_CODE = np.zeros(256, np.uint8)
_CODE[np.frombuffer(TOKEN_CHARS, np.uint8)] = np.arange(1, CODES)
_IS_HEX = np.zeros(256, bool)
_IS_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True

#: Weight of a character's own rate beside its transition counts.
SMOOTH = 200.0

SPAN = StructType([StructField("kind", IntegerType()), StructField("start", LongType()), StructField("end", LongType())])

@dataclass(frozen=True)
class SecretRules:
    min_assign: int = 8
    min_access: int = 16
    min_hex: int = 32
    min_length: int = 8
    min_ratio: float = 2.0
    false_rate: float = 1e-4


#: First length of each class, and the histogram's bins: whole nats.
LENGTHS = np.array([1, 8, 10, 12, 14, 16, 20, 24, 32, 48])
LOW, BINS = -128, 384


def _runs(flag: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True of ``least`` or more."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.view(np.int8), [0]])))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def base_spans(text: bytes, rules: SecretRules, hex_runs: list[tuple[int, int]] | None = None) -> tuple[list, list]:
    """(kind, start, end) of the base rules and the (start, end) of their
    values, in bytes."""
    spans, values = [], []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= rules.min_assign:
                spans.append((0, m.start(), m.end()))
                values.append(m.span(2))
    if b"AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= rules.min_access:
                spans.append((1, m.start(), m.end()))
                values.append(m.span())
    if hex_runs is None:
        hex_runs = [m.span() for m in HEX.finditer(text) if len(m[0]) >= rules.min_hex]
    spans += [(2, a, b) for a, b in hex_runs]
    return spans, values + list(hex_runs)


def _points(text: bytes, spots: list[int]) -> dict[int, int]:
    """Code-point offsets of byte offsets."""
    out, at, n = {}, 0, 0
    for s in sorted(set(spots)):
        n += len(text[at:s].decode("utf-8", "replace"))
        at = s
        out[s] = n
    return out


def _outside(starts: np.ndarray, ends: np.ndarray, base: list) -> np.ndarray:
    """Which of the tokens touch none of the (kind, start, end) spans."""
    spans = np.array(sorted((s, e) for _, s, e in base)).reshape(-1, 2)
    reach = np.concatenate([[-1], np.maximum.accumulate(spans[:, 1])])
    return reach[np.searchsorted(spans[:, 0], ends)] <= starts


class Scan:
    """A batch of texts, each with a line feed behind it: base spans, tokens
    and the transitions into each byte."""

    def __init__(self, texts: list[bytes], rules: SecretRules) -> None:
        self.texts, self.rules = texts, rules
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        code = _CODE[raw]
        self.cell = np.concatenate([[0], code[:-1]]).astype(np.int32) * CODES + code
        self.inside = code > 0
        per_hex: dict[int, list] = {}
        for a, b in zip(*(x.tolist() for x in _runs(_IS_HEX[raw], rules.min_hex))):
            d = int(np.searchsorted(self.first, a, "right")) - 1
            per_hex.setdefault(d, []).append((a - int(self.first[d]), b - int(self.first[d])))
        self.base, self.values = {}, {}
        for d, text in enumerate(texts):
            base, values = base_spans(text, rules, per_hex.get(d, []))
            if base:
                self.base[d], self.values[d] = base, values

    def counts(self) -> np.ndarray:
        """Transitions of the random (row 0) and the other tokens (row 1)."""
        counts = np.zeros((2, CODES * CODES), np.int64)
        counts[1] = np.bincount(self.cell[self.inside], minlength=CODES * CODES)
        for d, values in self.values.items():
            here = slice(int(self.first[d]), int(self.first[d]) + len(self.texts[d]))
            done = np.zeros(len(self.texts[d]), bool)
            for s, e in values:
                done[s:e] = True
            moved = np.bincount(self.cell[here][done & self.inside[here]], minlength=CODES * CODES)
            counts[0] += moved
            counts[1] -= moved
        return counts

    def scored(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and ratios of the tokens that touch no base span."""
        starts, ends = _runs(self.inside, self.rules.min_length)
        for d, base in self.base.items():
            lo, hi = np.searchsorted(starts, self.first[d:d + 2])
            free = np.ones(len(starts), bool)
            free[lo:hi] = _outside(starts[lo:hi] - self.first[d], ends[lo:hi] - self.first[d], base)
            starts, ends = starts[free], ends[free]
        ratio = np.concatenate([[0.0], np.cumsum(table.ravel()[self.cell])])  # 0 at other characters
        return starts, ends, ratio[ends] - ratio[starts]

    def histogram(self, table: np.ndarray) -> np.ndarray:
        """Of ordinary tokens, by class of length and whole nats; then, in one
        more row, of the base values' nats for each 100 characters."""
        out = np.zeros((len(LENGTHS) + 1, BINS), np.int64)
        starts, ends, ratio = self.scored(table)
        klass = np.searchsorted(LENGTHS, ends - starts, "right") - 1
        nats = np.clip(np.floor(ratio).astype(np.int64) - LOW, 0, BINS - 1)
        out[:-1] = np.bincount(klass * BINS + nats, minlength=len(LENGTHS) * BINS).reshape(len(LENGTHS), BINS)
        for d, values in self.values.items():
            for s, e in values:
                each = 100 * score_token(self.texts[d][s:e], table) / (e - s)
                out[-1, int(np.clip(each - LOW, 0, BINS - 1))] += 1
        return out

    def spans(self, table: np.ndarray, limits: np.ndarray) -> list[list[dict]]:
        """Base and random spans of each text, in code points, by start."""
        starts, ends, ratio = self.scored(table)
        hit = ratio >= limits[np.searchsorted(LENGTHS, ends - starts, "right") - 1]
        starts, ends = starts[hit], ends[hit]
        cut = np.searchsorted(starts, self.first)
        out = []
        for d, text in enumerate(self.texts):
            own = self.base.get(d, []) + [(3, a, b) for a, b in zip(
                (starts[cut[d]:cut[d + 1]] - self.first[d]).tolist(), (ends[cut[d]:cut[d + 1]] - self.first[d]).tolist())]
            at = _points(text, [x for _, s, e in own for x in (s, e)])
            out.append([{"kind": k, "start": s, "end": e} for s, k, e in sorted((at[s], k, at[e]) for k, s, e in own)])
        return out


T_SPAN = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def _texts(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("_text"))


def _summed(docs: DataFrame, rules: SecretRules, of, size: int) -> np.ndarray:
    """The sum over all texts of ``of(scan)``, ``size`` numbers: a row a
    partition, summed by Spark."""
    out = StructType([StructField("counts", ArrayType(LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in byte_slices(batches, "_text"):  # bounds the arrays over the bytes
            total += of(Scan(b.column("_text").to_pylist(), rules)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.int64()))], names=out.names)

    rows = _texts(docs).select("_text").mapInArrow(released(run), out)
    sums = rows.select(F.posexplode("counts").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).where("n > 0").collect()
    counts = np.zeros(size)
    for r in sums:  # one number a cell
        counts[r.i] = r.n
    return counts


def ratio_table(docs: DataFrame, rules: SecretRules) -> np.ndarray:
    """Log-likelihood ratio of each transition, random over ordinary."""
    counts = _summed(docs, rules, Scan.counts, 2 * CODES * CODES).reshape(2, CODES, CODES)[:, :, 1:]
    # each transition is smoothed by the character's own rate in its model
    single = counts.sum(axis=1, keepdims=True) + 0.5
    single /= single.sum(axis=2, keepdims=True)
    prob = (counts + SMOOTH * single) / (counts.sum(axis=2, keepdims=True) + SMOOTH)
    return np.concatenate([np.zeros((CODES, 1)), np.log(prob[0] / prob[1])], axis=1)


def score_token(token: bytes, table: np.ndarray) -> float:
    code = _CODE[np.frombuffer(token, np.uint8)].astype(np.int64)
    return float(table[np.concatenate([[0], code[:-1]]), code].sum())


def limits_of(histogram: np.ndarray, rules: SecretRules) -> np.ndarray:
    """Least ratio of each class of lengths."""
    ordinary, labelled = histogram[:-1], histogram[-1]
    over = np.cumsum(ordinary[:, ::-1], axis=1)[:, ::-1]  # tokens at this many nats or more
    few = over <= rules.false_rate * ordinary.sum(axis=1, keepdims=True)
    tail = np.where(few.any(axis=1), few.argmax(axis=1), BINS) + LOW
    if labelled.sum():
        each = (np.searchsorted(np.cumsum(labelled), labelled.sum() / 2) + LOW) / 100
        tail = np.minimum(tail, 0.3 * each * LENGTHS)
    return np.maximum(tail, rules.min_ratio).astype(float)


def learn(docs: DataFrame, rules: SecretRules) -> tuple[np.ndarray, np.ndarray]:
    """The ratio of each transition, and the limits."""
    table = ratio_table(docs, rules)
    found = _summed(docs, rules, lambda scan: scan.histogram(table), (len(LENGTHS) + 1) * BINS)
    return table, limits_of(found.reshape(-1, BINS), rules)


def find(docs: DataFrame, rules: SecretRules = SecretRules()) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans (string)
    and found (array of spans)."""
    table, limits = learn(docs, rules)
    longs = ("n_assign", "n_access", "n_hex", "n_random")
    out = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *[StructField(n, LongType()) for n in longs],
                      StructField("base_sha256", StringType()), StructField("spans", StringType()), StructField("found", ArrayType(SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        line = lambda spans: ",".join(f"{KINDS[s['kind']]}:{s['start']}:{s['end']}" for s in spans)
        for b in byte_slices(batches, "_text"):
            found = Scan(b.column("_text").to_pylist(), rules).spans(table, limits)
            n = np.array([[sum(s["kind"] == k for s in every) for k in range(4)] for every in found], np.int64).reshape(-1, 4)
            digests = [hashlib.sha256(line([s for s in every if s["kind"] < 3]).encode()).hexdigest() for every in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(n[:, i].copy()) for i in range(4)], pa.array(digests, pa.string()),
                 pa.array([line(every) for every in found], pa.string()), pa.array(found, T_SPAN)], names=out.names)

    return _texts(docs).mapInArrow(released(run), out)


def _without(text: bytes, spans: list, mark: str) -> str:
    """The text with every span replaced, overlapping or touching ones by one
    mark. ``spans`` by start."""
    whole, out, at, stop = text.decode("utf-8", "replace"), [], 0, -1
    for s in spans:
        if s["start"] > stop:
            out += [whole[at:s["start"]], mark]
        stop = at = max(stop, s["end"])
    return "".join(out) + whole[at:]


def redact(docs: DataFrame, rules: SecretRules = SecretRules(), mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (overlapping spans by
    one), ``n_chars`` set anew where the text changed. No row is staged, and
    the last scan replaces as it finds."""
    table, limits = learn(docs, rules)
    counted = "n_chars" in docs.columns and docs.schema["n_chars"].dataType in (IntegerType(), LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in byte_slices(batches, "text"):
            texts = b.column("text").cast(pa.binary()).to_pylist()
            found = Scan([t or b"" for t in texts], rules).spans(table, limits)
            changed = {i: _without(texts[i], spans, mark) for i, spans in enumerate(found) if spans}
            del texts, found
            if changed:
                cols = {name: b.column(name) for name in b.schema.names}
                cols["text"] = pa.array([changed.get(i, t) for i, t in enumerate(cols["text"].to_pylist())], b.column("text").type)
                if counted:
                    n = cols["n_chars"].to_pylist()
                    cols["n_chars"] = pa.array([len(changed[i]) if i in changed else x for i, x in enumerate(n)], b.column("n_chars").type)
                b = pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
            yield b

    return docs.mapInArrow(released(run), docs.schema)
