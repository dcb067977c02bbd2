"""Mixing documents to target domain weights with soft membership.

The labelled table names domains (its combinations of ``quality`` and
``toxic``). A naive Bayes classifier over the hashed signs that a text has
(its words, their last two bytes, how many of its words are distinct; each
once), kept where a sign's rate in a domain differs clearly from its rate
elsewhere, gives every document a posterior over the domains. What counts as
clear is learned: the sample is cut into two halves, each half's signs score
the other one at several levels, and the level whose calibrated posteriors
predict the held-out labels best is taken; the calibration (a softmax
regression on those held-out scores, weighted by tokens as totals are) makes
the domains' expected totals those of the labels.

Nonnegative rates r are then fitted so that the expected domain totals
y_k = sum of tokens * r * p_k meet the targets b_k: accelerated projected
gradient on the least squares ``(y - b)' W (y - b)`` (W: the inverse of the
sums over all rows of tokens * p p'), started at r = 1. In the metric that
weighs a document by its tokens a step from v is
``r <- max(0, v - p' W (y(v) - b))``; its length is safe, as the curvature of
that objective is 1 at most, and where no rate falls to zero one step is exact.
v is r moved on along its last change (momentum, restarted when the residual
grows). A step needs only the K totals of the rates before, so every iteration
is one pass over (tokens, posterior) rows with K sums; a document's rate
follows from the list of past steps and is never shuffled. What the totals are
off their targets by in the end is returned, and warned of above ``tolerance``.
Targets out of reach are approached by the first step whose residual is hardly
above the least one (``slack``); the steps after it gain little and drive ever
more rates to zero.

The classifier learns from at most ``max_labelled`` documents of each domain
(least hash of doc_id), a documented bound. Posteriors, totals and rates cover
all documents.

Domains and their shares are those of the labels whose documents are in
``docs``: a domain that an earlier step has removed is none here.

Defined cases: null and empty texts have no tokens and the rate of their
posterior; with no labelled document there is one domain, ``all``; domains
without a target keep their own share, scaled to what the targets leave; a
target whose domain has no document in ``docs`` is left to the others;
targets that no nonnegative rates meet are approached for ``max_steps``;
repeated rows are rated each; null ids are rated (drawn as the empty text); an
empty table gives an empty result; other columns are carried.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from martcraft.llm.common import ROW, bounded_sample, carry, released, ship, stage
from martcraft.llm.hashing import hashed_words_and_tails, pieces


@dataclass(frozen=True)
class MixRules:
    max_labelled: int = 2000
    bits: int = 17
    levels: tuple[float, ...] = (1.5, 2.0, 2.5, 3.0, 4.0, 6.0)  # standard deviations by which a sign's rate must differ
    #: target share of tokens by domain name
    targets: tuple[tuple[str, float], ...] = (("quality=1,toxic=1", 0.02), ("quality=0,toxic=0", 0.01), ("quality=0,toxic=1", 0.01))
    max_steps: int = 60
    tolerance: float = 1e-3
    slack: float = 0.05  # targets out of reach: how far above the least residual the first step that counts may be


def _distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values, ascending (``np.unique`` hashes them, slower here)."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def signs(texts: list[bytes | None], part: list[int], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position in ``part``, cell) of every sign that a text has, each once,
    and the texts' numbers of words."""
    at, h, end = hashed_words_and_tails(texts, part)
    n = np.bincount(at, minlength=len(part))
    size = 1 << bits
    cell = (h >> np.uint64(64 - bits)).astype(np.int64)
    tail = ((end.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)
    words = _distinct(at * size + cell)
    distinct = np.bincount(words // size, minlength=len(part))
    # of ten words, how many are distinct
    tenth = np.where(n > 0, 10 * distinct // np.maximum(n, 1), 11)
    every = _distinct(np.concatenate([words, at * size + tail, np.arange(len(part)) * size + tenth]))
    return every // size, every % size, n


@dataclass
class Classifier:
    domains: list[str]
    table: np.ndarray      # cell x domain: a sign's log ratio, domain over the rest
    weights: np.ndarray    # (domains + 1) x domains: calibration of the summed log ratios
    bits: int

    def logits(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and log-likelihoods (without prior) of each text."""
        n, out = np.zeros(len(texts), np.int64), np.zeros((len(texts), len(self.domains)))
        for part in pieces(texts):
            at, cell, n[part] = signs(texts, part, self.bits)
            values = self.table[cell]
            for k in range(len(self.domains)):
                out[part, k] = np.bincount(at, values[:, k], minlength=len(part))
        return n, out

    def posterior(self, logits: np.ndarray) -> np.ndarray:
        return _softmax(_inputs(logits) @ self.weights)


def _inputs(logits: np.ndarray) -> np.ndarray:
    return np.concatenate([np.clip(logits, -40, 40) / 10, np.ones((len(logits), 1))], axis=1)


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _calibrate(logits: np.ndarray, domain: np.ndarray, share: np.ndarray, tokens: np.ndarray, steps: int = 1500) -> np.ndarray:
    """Softmax regression by accelerated gradient steps; rows are weighted by
    their tokens, and so that the domains have their shares of the label
    table."""
    x, k = _inputs(logits), len(share)
    y = np.eye(k)[domain]
    w = (share / np.maximum(y.sum(axis=0), 1))[domain] * np.maximum(tokens, 1)
    w /= max(w.sum(), 1e-300)
    size = np.linalg.eigvalsh((x * w[:, None]).T @ x)[-1] / 2 + 1e-3
    now = before = np.zeros((x.shape[1], k))
    for t in range(steps):
        at = now + t / (t + 3) * (now - before)
        grad = (x * w[:, None]).T @ (_softmax(x @ at) - y) + 1e-4 * at
        before, now = now, at - grad / size
    return now


def _domain() -> Column:
    return F.concat(F.lit("quality="), F.col("quality"), F.lit(",toxic="), F.col("toxic"))


def train(docs: DataFrame, labels: DataFrame, rules: MixRules) -> Classifier:
    ship(docs.sparkSession)
    named = labels.select(F.col("doc_id").alias("__llm_id"), _domain().alias("domain")).where("__llm_id is not null and domain is not null")
    here = docs.select(F.col("doc_id").alias("__llm_here")).where("__llm_here is not null").distinct()
    named = stage(named.join(here, F.expr("__llm_id = __llm_here"), "left_semi"), "mixing-labels")
    share = {r.domain: r["count"] for r in named.groupBy("domain").count().collect()}  # as many as the labels have kinds
    names = sorted(share)
    if not names:
        return Classifier(["all"], np.zeros((1 << rules.bits, 1)), np.zeros((2, 1)), rules.bits)
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("domain")) - 1
    picked = stage(bounded_sample(named.select("__llm_id", number.cast("int").alias("__llm_k")), "__llm_id", rules.max_labelled, ("__llm_k",)).withColumn(
        "__llm_half", F.pmod(F.xxhash64(F.col("__llm_id").cast("string")), F.lit(2)).cast("int")), "mixing-chosen")
    sample = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("__llm_id")).select(
        "__llm_k", "__llm_half", F.col("text").cast("binary").alias("text"))
    sample = stage(sample.toDF("k", "half", "text"), "mixing-sample")
    size, bits = 1 << rules.bits, rules.bits
    out = StructType([StructField("half", IntegerType()), StructField("cell", LongType()), StructField("n", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, k, half = b.column("text").to_pylist(), np.array(b.column("k").to_pylist(), np.int64), np.array(b.column("half").to_pylist(), np.int64)
            for part in pieces(texts):
                at, cell, _ = signs(texts, part, bits)
                both, n = np.unique((half[part][at] * len(names) + k[part][at]) * size + cell, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((both // (size * len(names))).astype(np.int32)), pa.array(both % (size * len(names))), pa.array(n.astype(np.int64))],
                    names=out.names)

    docs_in, counts = np.zeros((2, len(names))), np.zeros((2, len(names) * size))
    for r in sample.groupBy("half", "k").count().collect():
        docs_in[r.half, r.k] = r["count"]
    for r in sample.mapInArrow(released(count), out).groupBy("half", "cell").agg(F.sum("n").alias("n")).collect():  # cells are bounded
        counts[r.half, r.cell] = r.n
    counts = counts.reshape(2, len(names), size)

    def tables(half: int | None) -> list[np.ndarray]:
        """Log ratios of the signs of one half (None: all) at each level."""
        c = counts.sum(axis=0) if half is None else counts[half]
        n = (docs_in.sum(axis=0) if half is None else docs_in[half])[:, None]
        other, n_out = c.sum(axis=0) - c, n.sum() - n
        p, rest = (c + 0.5) / (n + 1), (other + 0.5) / (n_out + 1)
        pool = (c.sum(axis=0) + 0.5) / (n.sum() + 1)
        apart = np.abs(p - rest) / np.sqrt(pool * (1 - np.minimum(pool, 0.999)) * (1 / (n + 1) + 1 / (n_out + 1)))
        shown = np.where(p > rest, c, other) > 0  # a sign speaks only for a side that has it
        return [np.where((apart >= z) & shown, np.log(p / rest), 0.0).T.copy() for z in rules.levels]

    part = np.array([share[n] for n in names], float) / sum(share.values())
    halves = [np.concatenate(tables(half), axis=1) for half in (0, 1)]  # all levels side by side
    held = []
    for half in (0, 1):
        both = Classifier([f"{i}" for i in range(halves[half].shape[1])], halves[half], np.zeros((halves[half].shape[1] + 1, 1)), bits)
        held += _scored(sample.where(f"half = {1 - half}"), both, ["k", "half"]).collect()  # bounded by the sample
    z, k = np.array([r.logits for r in held]).reshape(len(held), len(rules.levels), len(names)), np.array([r.k for r in held], np.int64)
    tokens = np.array([r.tokens for r in held], float)
    # one fold calibrates, the other judges the level
    fold = np.arange(len(held)) % 2
    losses = []
    for i in range(len(rules.levels)):
        lost = 0.0
        for f in (0, 1):
            own = _calibrate(z[fold != f, i], k[fold != f], part, tokens[fold != f], steps=400)
            q = _softmax(_inputs(z[fold == f, i]) @ own)[np.arange((fold == f).sum()), k[fold == f]]
            lost -= (tokens[fold == f] * np.log(np.maximum(q, 1e-12))).sum()
        losses.append(lost)
    best = int(np.argmin(losses))
    weights = np.zeros((len(names) + 1, len(names)))
    weights[-1] = np.log(part)
    if len(held) > len(names):
        weights = _calibrate(z[:, best], k, part, tokens)
    return Classifier(names, tables(None)[best], weights, bits)


def _scored(docs: DataFrame, model: Classifier, keep: list[str]) -> DataFrame:
    """``keep`` columns, tokens, logits and posterior p of each row (column
    text: binary)."""
    fields = [docs.schema[c] for c in keep]
    out = StructType([*fields, StructField("tokens", LongType()), StructField("logits", ArrayType(DoubleType())),
                      StructField("p", ArrayType(DoubleType()))])
    t = pa.list_(pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, z = model.logits(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(n), pa.array(z.tolist(), t), pa.array(model.posterior(z).tolist(), t)], names=out.names)

    return docs.select(*keep, "text").mapInArrow(released(run), out)


def _rates(p: np.ndarray, steps: list[tuple[float, np.ndarray]]) -> np.ndarray:
    """Rates after the steps (momentum, direction by domain)."""
    before = r = np.ones(len(p))
    for m, g in steps:
        before, r = r, np.maximum(0.0, r + m * (r - before) - p @ g)
    return r


def _matrix(column: pa.Array, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


def totals(rows: DataFrame, k: int, ways: list[list[tuple[float, np.ndarray]]], squares: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain at the rates after each of several lists
    of steps, all from one pass; with ``squares`` the k x k sums of
    tokens * p p', else none."""
    out = StructType([StructField("y", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y, h = np.zeros((len(ways), k)), np.zeros((k * squares, k * squares))
        for b in batches:
            p, tokens = _matrix(b.column("p"), k), b.column("tokens").to_numpy()
            for i, steps in enumerate(ways):
                y[i] += (tokens * _rates(p, steps)) @ p
            if squares:
                h += (p * tokens[:, None]).T @ p
        yield pa.RecordBatch.from_arrays([pa.array([y.ravel().tolist() + h.ravel().tolist()], pa.list_(pa.float64()))], names=["y"])

    n = k * len(ways)
    sums = rows.select("tokens", "p").mapInArrow(run, out).agg(*[F.sum(F.col("y")[i]).alias(f"y{i}") for i in range(n + k * k * squares)]).first()
    sums = np.array([v or 0.0 for v in sums])
    return sums[:n].reshape(len(ways), k), sums[n:].reshape(k * squares, k * squares)


def goals(domains: list[str], own: np.ndarray, targets: tuple[tuple[str, float], ...]) -> np.ndarray:
    """Target totals: named shares of all tokens; the other domains divide
    what is left by their own totals. A target without any such document, or
    targets that leave nothing, are scaled to sum to all tokens."""
    named = dict(targets)
    share = np.array([named.get(d, 0.0) for d in domains]) * (own > 0)
    free = np.array([d not in named for d in domains]) * own
    left = max(0.0, 1.0 - share.sum())
    if free.sum() > 0:
        share = share + left * free / free.sum()
    return own.sum() * (share / share.sum() if share.sum() > 0 else own / max(own.sum(), 1e-300))


@dataclass
class Fit:
    steps: list[tuple[float, np.ndarray]]
    residual: float  # share of all tokens by which the totals miss the targets


class Descent:
    """Steps in one metric."""

    def __init__(self, own: np.ndarray, b: np.ndarray, metric: np.ndarray, rules: MixRules) -> None:
        self.own, self.b, self.metric, self.rules = own, b, metric, rules
        self.steps: list[tuple[float, np.ndarray]] = []
        self.y = self.last = own
        self.since, self.off = 0, np.abs(own - b).sum()
        self.offs = [self.off]

    @property
    def goes_on(self) -> bool:
        return len(self.steps) < self.rules.max_steps and self.off > self.rules.tolerance * self.own.sum()

    def next_step(self) -> list[tuple[float, np.ndarray]]:
        m = self.since / (self.since + 3.0)
        moved = self.y + m * (self.y - self.last)
        self.steps.append((m, self.metric @ (moved - self.b)))
        return self.steps

    def take(self, y: np.ndarray) -> None:
        """The totals after the last step."""
        self.last, self.y = self.y, y
        before, self.off = self.off, np.abs(y - self.b).sum()
        self.since = 0 if self.off > before else self.since + 1
        self.offs.append(self.off)

    def fit(self, slack: float = 0.0) -> Fit:
        """Up to the first step whose residual is at most this share above the
        least one."""
        taken = int(np.argmax(np.array(self.offs) <= (1 + slack) * min(self.offs)))
        return Fit(self.steps[:taken], float(self.offs[taken] / self.own.sum()))


def fit_rates(rows: DataFrame, domains: list[str], rules: MixRules) -> Fit:
    """The projected-gradient steps. Totals are linear in the rates, so those
    at the moved point follow from the last two. Where the posteriors' metric
    does not get there (no nonnegative rates meet the targets, or domains are
    hardly told apart), the steps ``(y_k - b_k) / T_k`` (T: totals at rate 1)
    are tried too, and the smaller residual counts; both go along in the same
    passes over the rows."""
    k = len(domains)
    first, squares = totals(rows, k, [[]], squares=True)
    own = first[0]
    if not own.sum():
        return Fit([], 0.0)
    b = goals(domains, own, rules.targets)
    first = Descent(own, b, np.linalg.pinv(squares, rcond=1e-10, hermitian=True), rules)
    plain = Descent(own, b, np.diag(1 / np.where(own > 0, own, np.inf)), rules)
    while first.goes_on or (plain.goes_on and first.fit().residual > rules.tolerance):
        moving = [d for d in (first, plain) if d.goes_on]
        found, _ = totals(rows, k, [d.next_step() for d in moving])
        for d, y in zip(moving, found):
            d.take(y)
    fit = first.fit()
    if fit.residual > rules.tolerance:
        best = min(first, plain, key=lambda d: min(d.offs))
        fit = best.fit()
        if fit.residual > rules.tolerance:
            fit = best.fit(rules.slack)
            warnings.warn(f"mixing: the totals are {fit.residual:.4f} of all tokens off their targets", stacklevel=2)
    return fit


def mix(docs: DataFrame, labels: DataFrame, rules: MixRules = MixRules(), keep_row: bool = False) -> DataFrame:
    """doc_id (or the carried row), tokens, domain (likeliest), p (posterior
    over ``domains``), domains, rate, copies: the rate rounded up or down at
    random by a hash of doc_id, and residual: the share of all tokens by which
    the expected totals miss the targets."""
    model = train(docs, labels, rules)
    first = [carry(docs)] if keep_row else []
    src = docs.select(*first, "doc_id", F.col("text").cast("binary").alias("text"))
    keep = [f.name for f in src.schema.fields if f.name != "text"]
    rows = stage(_scored(src, model, keep).drop("logits"), "mixing-posteriors")
    k = len(model.domains)
    fit = fit_rates(rows, model.domains, rules)
    steps = fit.steps
    out = StructType([*rows.schema.fields, StructField("rate", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rate = _rates(_matrix(b.column("p"), k), steps)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rate)], names=out.names)

    names = F.array(*[F.lit(d) for d in model.domains])
    chance = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("mix")), F.lit(1 << 30)) / (1 << 30)
    return rows.mapInArrow(released(run), out).select(
        *keep, "tokens", F.element_at(names, F.array_position("p", F.array_max("p")).cast("int")).alias("domain"), "p",
        names.alias("domains"), "rate", F.floor(F.col("rate") + chance).cast("int").alias("copies"), F.lit(fit.residual).alias("residual"))


def resample(docs: DataFrame, labels: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """The rows of ``docs``, each as often as its copies say."""
    rated = mix(docs, labels, rules, keep_row=True).where("copies > 0")
    return rated.select(ROW, F.explode(F.expr("sequence(1, copies)"))).select(f"{ROW}.*")
