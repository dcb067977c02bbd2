"""Masked pseudo-likelihood scores of documents.

A small window network, trained in numpy, predicts every token from the two
tokens on each side of it: their embeddings (one table a position, a row for
every token) are summed, squashed and mapped to an exact distribution over all
tokens in two levels, both learned and both seeing the two sides: a softmax
over the classes, then the turns of a binary tree whose leaves are the tokens
of the class. The biases start at the corpus' shares. A document's score is the sum over all its tokens of
log P(class | both sides) + log P(token | class, both sides).

With ``own_class`` > 0 the model is a coarse one: only so many tokens are
classes, the others fall into the rest by hash and have their corpus share
inside it, whatever stands around them.

The corpus statistics cover all documents: hashes of all words are counted by
Spark; at most ``vocabulary`` most frequent are tokens of their own, each rarer
word belongs to one of ``rare`` buckets, inside which the distinct words are
alike. The network trains on all windows of all partitions: in a round each
partition runs Adam over every ``stride``-th window of its documents from the
same start, the next round takes the next ones, and there are at least
``stride`` rounds, so none is left out. There is a model for every
``model_windows`` windows of the corpus. A round's changes are averaged in a
tree of Spark groups of ``FAN`` models, each row of the tables by the steps
that met it, and the next round starts from the average.

Defined cases: null, empty and blank texts have no tokens, log-likelihood 0
and a null mean; one word alone is predicted from the boundary marks; repeated
rows and null ids come back each; an empty table gives an empty result; only
doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructField, StructType

from martcraft.llm.common import leading_bits, released, ship, stage
from martcraft.llm.hashing import hashed_words, pieces

WINDOW = 2
SIDES = (-2, -1, 1, 2)
FAN = 8
LEAD = 18     # leading bits of a word's hash that are looked up
BLOCK = 4096  # rows worked on at once, so that they stay in a core's cache


@dataclass(frozen=True)
class LmRules:
    vocabulary: int = 32_768
    rare: int = 1024
    own_class: int = 0       # coarse model: the most frequent tokens are classes of their own
    classes: int = 64
    own_input: int = 32_768  # the most frequent tokens have embeddings of their own
    width: int = 16
    stride: int = 2
    rounds: int = 2
    batch: int = 8192
    rate: float = 0.01
    seed: int = 7
    model_windows: int = 4_000_000  # windows that one task's model learns from in all rounds


@dataclass
class Vocabulary:
    """Token of each word hash, and each token's class, input and log share
    of its class."""

    hashes: np.ndarray      # sorted
    ranks: np.ndarray
    klass: np.ndarray
    inputs: np.ndarray
    share: np.ndarray
    rare: int
    member: np.ndarray      # number of each token inside its class
    mass: np.ndarray | None # occurrences of each token; None: coarse model

    @property
    def boundary(self) -> int:
        return int(self.inputs.max(initial=0)) + 1

    @cached_property
    def _first(self) -> tuple[np.ndarray, int]:
        """By leading bits, where their hashes begin, and the most hashes that
        share them."""
        lead = np.arange((1 << LEAD) + 1, dtype=np.uint64)
        first = np.searchsorted(self.hashes >> np.uint64(64 - LEAD), lead)
        return first.astype(np.int32), int(np.diff(first).max())

    def _places(self, h: np.ndarray) -> np.ndarray:
        """``searchsorted`` of the hashes, by their leading bits; by halving
        where many hashes share them."""
        first, most = self._first
        if most > 16:
            return np.searchsorted(self.hashes, h)
        at = first.take((h >> np.uint64(64 - LEAD)).astype(np.int64))
        for _ in range(most):
            at += self.hashes.take(at, mode="clip") < h
        return np.minimum(at, len(self.hashes))

    def tokens(self, h: np.ndarray) -> np.ndarray:
        out = len(self.hashes) + (h % np.uint64(self.rare)).astype(np.int64)
        if len(self.hashes):
            at = np.minimum(self._places(h), len(self.hashes) - 1)
            known = self.hashes[at] == h
            out[known] = self.ranks[at[known]]
        return out


def word_counts(docs: DataFrame) -> DataFrame:
    """h, n: every distinct word hash of the corpus and its count."""
    out = StructType([StructField("h", LongType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            found = [hashed_words(texts, part)[1] for part in pieces(texts)]
            h, n = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=out.names)

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, out).groupBy("h").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, rules: LmRules) -> Vocabulary:
    """The words above the least count that leaves at most ``vocabulary`` of
    them (to the width of a histogram's bin). These rows, the histogram and two
    numbers a rare bucket come to the driver, whatever the corpus."""
    bins = counts.groupBy(F.expr(leading_bits("n", 7)).alias("low")).agg(F.count("*").alias("words")).collect()
    least, held = None, 0
    for r in sorted(bins, key=lambda r: -r.low):
        held += r.words
        if held > rules.vocabulary:
            break
        least = r.low
    top = [] if least is None else counts.where(F.col("n") >= least).collect()
    top.sort(key=lambda r: (-r.n, r.h))
    h = np.array([r.h for r in top], np.int64).view(np.uint64)
    n = np.array([r.n for r in top], float)
    low = F.col("h").bitwiseAND(F.lit(rules.rare - 1))  # rare: a power of two
    per_bucket = counts.groupBy(low.alias("b")).agg(F.count("*").alias("types"), F.sum("n").alias("n")).collect()
    types, mass = np.zeros(rules.rare), np.zeros(rules.rare)
    for r in per_bucket:
        types[r.b], mass[r.b] = r.types, r.n
    own = (h % np.uint64(rules.rare)).astype(np.int64)
    types -= np.bincount(own, minlength=rules.rare)
    mass -= np.bincount(own, n, minlength=rules.rare)
    if not rules.own_class:
        return _every_token(h, n, types, mass, rules)
    shared = rules.classes - rules.own_class
    ranks = np.arange(len(h))
    mixed = ((h >> np.uint64(17)) % np.uint64(shared)).astype(np.int64)
    buckets = np.arange(rules.rare)
    klass = np.concatenate([np.where(ranks < rules.own_class, ranks, rules.own_class + mixed), rules.own_class + buckets % shared])
    inputs = np.concatenate([np.where(ranks < rules.own_input, ranks, rules.own_input + mixed), rules.own_input + buckets % shared])
    # a bucket that has met no word yet counts as one word met half a time
    each = np.concatenate([n, np.maximum(mass, 0.5)])
    total = np.bincount(klass, each, minlength=rules.classes)
    share = np.log(each / total[klass]) - np.log(np.concatenate([np.ones(len(h)), np.maximum(types, 1)]))
    order = np.argsort(h)
    return Vocabulary(h[order], ranks[order], klass.astype(np.int32), inputs.astype(np.int32), share, rules.rare,
                      np.zeros(len(klass), np.int32), None)


def _every_token(h: np.ndarray, n: np.ndarray, types: np.ndarray, mass: np.ndarray, rules: LmRules) -> Vocabulary:
    """Every token is predicted itself; the most frequent ones lie in
    different classes."""
    each = np.concatenate([n, np.maximum(mass, 0.5)])
    place = np.empty(len(each), np.int64)
    place[np.argsort(-each, kind="stable")] = np.arange(len(each))
    share = -np.log(np.concatenate([np.ones(len(h)), np.maximum(types, 1)]))
    inputs = np.arange(len(each))
    if rules.own_input < len(h):
        inputs = np.where(inputs < rules.own_input, inputs, rules.own_input + inputs % rules.classes)
    order = np.argsort(h)
    return Vocabulary(h[order], order, (place % rules.classes).astype(np.int32), inputs.astype(np.int32), share, rules.rare,
                      (place // rules.classes).astype(np.int32), each)


def _turns(klass: np.ndarray, member: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes on the way to each token in its class' tree, and 1 where the way
    turns right there."""
    level = np.arange(depth)
    node = (1 << level) - 1 + (member[:, None] >> (depth - level))
    node = klass[:, None].astype(np.int64) * ((1 << depth) - 1) + node
    return node.astype(np.int32), ((member[:, None] >> (depth - 1 - level)) & 1).astype(np.float32)


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal numbers, longest first."""
    return _placed_runs(ordered)[:2]


def _placed_runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same, and which of the runs as they come each one is."""
    new = np.empty(len(ordered), bool)
    new[:1] = True
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    starts = np.flatnonzero(new)
    ends = np.empty_like(starts)
    ends[:-1], ends[-1:] = starts[1:], len(ordered)
    lengths = ends - starts
    order = _order(len(ordered) - lengths, len(ordered))
    return starts.take(order), lengths.take(order), order


def _run_sums(rows: np.ndarray, starts: np.ndarray, lengths: np.ndarray, short: int = 8) -> np.ndarray:
    """Sums of the runs. Short ones, nearly all, are added up together: their
    first rows, their second ones, ...; a reduction costs more for each run
    than for its rows."""
    out = rows.take(starts, axis=0)
    if long := int(np.searchsorted(-lengths, -short)):
        place = np.argsort(starts[:long])
        ends = np.stack([starts[place], starts[place] + lengths[place]], axis=1).ravel()
        out[place] = np.add.reduceat(rows, ends[:-1] if ends[-1] == len(rows) else ends, axis=0)[::2]
    for k in range(1, short):
        end = int(np.searchsorted(-lengths, -k))
        if end <= long:
            break
        out[long:end] += rows.take(starts[long:end] + k, axis=0)
    return out


def _order(index: np.ndarray, most: int) -> np.ndarray:
    """Stable order of numbers up to ``most`` (of 16 bits: a radix sort)."""
    return np.argsort(index.astype(np.uint16) if most < 1 << 16 else index, kind="stable")


def _widened(column: np.ndarray, width: int) -> np.ndarray:
    """A column repeated; rows are multiplied by it in one go, where numpy
    takes a broadcast column row by row."""
    return np.repeat(column, width).reshape(-1, width)


def _flat(part: np.ndarray) -> np.ndarray:
    return part.reshape(-1, part.shape[-1])


class Network:
    """Parameters: embeddings by side, their bias, class weights and bias, and
    (but in the coarse model) weights and bias of the nodes of each class' tree."""

    def __init__(self, words: Vocabulary, rules: LmRules) -> None:
        rng = np.random.default_rng(rules.seed)
        inputs, mass = words.boundary + 1, words.mass
        self.shapes = [(len(SIDES), inputs, rules.width), (rules.width,), (rules.width, rules.classes), (rules.classes,)]
        if mass is not None:
            self.depth = int(words.member.max()).bit_length()
            nodes = rules.classes * ((1 << self.depth) - 1)
            self.shapes += [(nodes, rules.width), (nodes, 1)]
        self.parts = [(rng.normal(size=s) * (0.1 if s[-1] > 1 and len(s) > 1 else 0)).astype(np.float32) for s in self.shapes]
        if mass is not None:
            total = np.bincount(words.klass, mass, minlength=rules.classes)
            self.parts[3] = np.log(np.maximum(total, 1e-9) / total.sum()).astype(np.float32)
            node, right = _turns(words.klass, words.member, self.depth)
            self.node, self.right = np.ascontiguousarray(node.T), np.ascontiguousarray(right.T)  # by level, of every token
            place = np.empty(len(node), np.int64)
            place[np.lexsort((words.member, words.klass))] = np.arange(len(node))
            self.place = place  # of every token among the leaves: windows in this order meet each level's nodes in runs
            sides = [np.bincount(node.ravel(), (mass[:, None] * (right == k)).ravel(), minlength=nodes) for k in (0, 1)]
            self.parts[5][:, 0] = np.clip(np.log(np.maximum(sides[1], 1e-20)) - np.log(np.maximum(sides[0], 1e-20)), -30, 30)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts])

    def load(self, flat: np.ndarray) -> Network:
        at = 0
        for i, s in enumerate(self.shapes):
            n = int(np.prod(s))
            self.parts[i] = flat[at:at + n].reshape(s).astype(np.float32)
            at += n
        return self

    def sparse_rows(self, i: int) -> int:
        """Rows of a part of which a step meets some only; 0 for the others."""
        return int(np.prod(self.shapes[i][:-1])) if i == 0 or i > 3 else 0

    def hidden(self, sides: np.ndarray) -> np.ndarray:
        e, b = self.parts[:2]
        z = e[0].take(sides[0], axis=0)
        z += b
        for k in range(1, len(SIDES)):
            z += e[k].take(sides[k], axis=0)
        return np.tanh(z, out=z)

    def logits(self, hidden: np.ndarray) -> np.ndarray:
        """Logits of the classes, less their greatest where exponentials
        might leave the range (|hidden| is 1 at most)."""
        w, b = self.parts[2:4]
        z = hidden @ w
        z += b
        if (np.abs(w).sum(axis=0) + np.abs(b)).max() > 30:
            z -= z.max(axis=1, keepdims=True)
        return z

    def log_probs(self, hidden: np.ndarray) -> np.ndarray:
        z = self.logits(hidden)
        return z - np.log(np.exp(z).sum(axis=1))[:, None]

    def token_log_probs(self, sides: np.ndarray, klass: np.ndarray, token: np.ndarray) -> np.ndarray:
        n = len(klass)
        h = self.hidden(sides)
        z = self.logits(h)
        own = z[np.arange(n), klass]
        out = (own - np.log(np.exp(z, out=z) @ np.ones(z.shape[1], z.dtype))).astype(np.float64)
        if len(self.parts) > 4:
            # one logarithm of the product of 1 + exp(+-u); past 60 the 1 is lost anyway
            product, far = np.ones(n), np.zeros(n)
            for node, right in zip(self.node, self.right):
                at = node.take(token)
                u = np.einsum("ij,ij->i", self.parts[4].take(at, axis=0), h)
                u += self.parts[5].take(at)
                u *= 1 - 2 * right.take(token)
                over = np.maximum(u - 60, 0)
                far += over
                u -= over
                np.exp(u, out=u)
                product *= 1 + u.astype(np.float64)
            out -= np.log(product) + far
        return out

    def ordered(self, token: np.ndarray) -> np.ndarray:
        """An order of windows in which equal nodes of every level adjoin."""
        return _order(self.place.take(token), len(self.place)) if len(self.parts) > 4 else np.arange(len(token))

    def gradient(self, sides: np.ndarray, klass: np.ndarray, token: np.ndarray) -> tuple[list, list[np.ndarray]]:
        """Of each part the rows that the windows hold (None: all; the
        embeddings of all sides are one list), and their gradients."""
        e, _, w = self.parts[:3]
        n = len(klass)
        if len(self.parts) > 4 and (np.diff(self.place.take(token)) < 0).any():
            order = self.ordered(token)
            sides, klass, token = sides[:, order], klass[order], token[order]
        h = self.hidden(sides)
        dh, dw, db = np.empty_like(h), 0, 0
        for i in range(0, n, BLOCK):
            some, own = h[i:i + BLOCK], klass[i:i + BLOCK]
            p = self.logits(some)
            np.exp(p, out=p)
            total = p @ np.ones(p.shape[1], p.dtype)
            p[np.arange(len(own)), own] -= total
            part = 1 / (n * total)  # of each row of p; its products are narrower
            wide = _widened(part, h.shape[1])
            np.multiply(p @ w.T, wide, out=dh[i:i + BLOCK])
            dw = dw + (some * wide).T @ p
            db = db + part @ p
        at, more = [], []
        if len(self.parts) > 4:
            rows, sums, turns = [], [], []
            for node, right in zip(self.node, self.right):
                of = node.take(token)
                own = self.parts[4].take(of, axis=0)
                u = np.einsum("ij,ij->i", own, h)
                u += self.parts[5].take(of)
                np.clip(u, -60, 60, out=u)
                np.exp(np.negative(u, out=u), out=u)
                u += 1
                g = np.reciprocal(u, out=u)
                g -= right.take(token)
                g /= n
                wide = _widened(g, h.shape[1])
                own *= wide
                dh += own
                np.multiply(h, wide, out=own)
                starts, lengths, order = _placed_runs(of)
                rows.append(of.take(starts))
                sums.append(_run_sums(own, starts, lengths))
                turns.append(np.add.reduceat(g, np.sort(starts)).take(order)[:, None])
            rows = np.concatenate(rows)
            at, more = [rows, rows], [np.concatenate(sums), np.concatenate(turns)]
        dz = dh * (1 - h * h)
        rows, de = [], []
        for k, side in enumerate(sides):
            order = _order(side, e.shape[1])
            side = side.take(order)
            starts, lengths = _runs(side)
            rows.append(side.take(starts).astype(np.int64) + k * e.shape[1])
            de.append(_run_sums(dz.take(order, axis=0), starts, lengths))
        return [np.concatenate(rows), None, None, None, *at], [np.concatenate(de), dz.sum(axis=0), dw, db, *more]


class Adam:
    """Steps on the rows given."""

    def __init__(self, net: Network, rate: float) -> None:
        self.net, self.rate, self.t = net, rate, 0
        self.m = [np.zeros_like(p) for p in net.parts]
        self.v = [np.zeros_like(p) for p in net.parts]

    def step(self, rows: list, grads: list[np.ndarray]) -> None:
        self.t += 1
        # the moments are kept 10 and 100 times as large, which spares factors
        scale = np.float32(self.rate * np.sqrt(1 - 0.99 ** self.t) / (1 - 0.9 ** self.t))
        for i, (at, g) in enumerate(zip(rows, grads)):
            tables = self.m[i], self.v[i], self.net.parts[i]
            if at is None:
                _move(*tables, g, scale)
                continue
            for j in range(0, len(at), BLOCK):
                some = at[j:j + BLOCK]
                held = [_flat(x).take(some, axis=0) for x in tables]
                _move(*held, g[j:j + BLOCK], scale)
                for x, y in zip(tables, held):
                    _whole_rows(x)[some] = _whole_rows(y)


def _move(m: np.ndarray, v: np.ndarray, p: np.ndarray, g: np.ndarray, scale: np.float32) -> None:
    """One step, in place."""
    m *= np.float32(0.9)
    m += g
    v *= np.float32(0.99)
    change = g * g
    v += change
    np.sqrt(v, out=change)
    change += np.float32(1e-7)
    np.divide(m, change, out=change)
    change *= scale
    p -= change


def _whole_rows(part: np.ndarray) -> np.ndarray:
    """Each row of a table as one element, which numpy copies at once."""
    return _flat(part).view(np.dtype((np.void, part.shape[-1] * part.itemsize)))[:, 0]


def encode(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """doc_id, ids: the tokens of each document (little-endian 32 bit)."""
    src = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    out = StructType([docs.schema["doc_id"], StructField("ids", BinaryType())])
    shared = docs.sparkSession.sparkContext.broadcast(words)  # its size is a parameter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ids = b.column("text").to_pylist(), []
            for part in pieces(texts):
                at, h = hashed_words(texts, part)
                token = shared.value.tokens(h).astype("<u4")
                ends = np.cumsum(np.bincount(at, minlength=len(part)))
                ids += [t.tobytes() for t in np.split(token, ends[:-1])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], names=out.names)

    return src.mapInArrow(run, out)


def windows(batch: list[bytes], words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a batch of documents, the inputs on their sides, and the
    documents' lengths."""
    docs = [np.frombuffer(b, "<u4") for b in batch]
    lengths = np.array([len(d) for d in docs], np.int64)
    token = np.concatenate(docs).astype(np.int64) if docs else np.empty(0, np.int64)
    place = np.arange(len(token)) + np.repeat(WINDOW * (2 * np.arange(len(docs)) + 1), lengths)
    line = np.full(len(token) + 2 * WINDOW * len(docs), words.boundary, np.int32)
    line[place] = words.inputs[token]
    return token, np.stack([line[place + s] for s in SIDES]) if len(token) else np.empty((len(SIDES), 0), np.int32), lengths


def turn_windows(lengths: np.ndarray, turn: int, stride: int) -> np.ndarray:
    """The windows of a round: by their place in the document, so that
    ``stride`` rounds take each once however the rows are dealt."""
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.flatnonzero(place % stride == turn % stride)


def _grouped(rows: list[bytes], most: int = 400_000) -> Iterator[list[bytes]]:
    part, held = [], 0
    for r in rows:
        part.append(r)
        held += len(r) // 4
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def _count(touched: list[np.ndarray], met: list[list[np.ndarray]]) -> None:
    """Count the rows that some steps met (each step a row once), and forget them."""
    for times, rows in zip(touched, met):
        if rows:
            times += np.bincount(np.concatenate(rows), minlength=len(times))
            rows.clear()


def changes(net: Network, before: list[np.ndarray], touched: list[np.ndarray], seen: int) -> tuple[bytes, bytes]:
    """What a task sends: the change of every parameter (16-bit floats, with a
    scale for each part) and how many steps met each row of the sparse parts;
    all steps count for the others."""
    out, scales = [], []
    for p, b in zip(net.parts, before):
        d = p - b
        scales.append(max(float(np.abs(d).max(initial=0)), 1e-30))
        out.append((d / np.float32(scales[-1])).astype("<f2").ravel())
    return np.array(scales, "<f8").tobytes() + np.concatenate(out).tobytes(), np.concatenate(
        [t.astype("<f4") for t in touched] + [np.array([seen], "<f4")]).tobytes()


def _unpacked(net: Network, data: bytes, counts: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Change and weight (of each row, or of all) by part."""
    k = len(net.shapes)
    scales, flat = np.frombuffer(data[:8 * k], "<f8"), np.frombuffer(data[8 * k:], "<f2")
    weight, parts, weights, at, w = np.frombuffer(counts, "<f4").astype(np.float64), [], [], 0, 0
    for i, (s, scale) in enumerate(zip(net.shapes, scales)):
        n = int(np.prod(s))
        parts.append(flat[at:at + n].reshape(s).astype(np.float32) * np.float32(scale))
        at += n
        rows = net.sparse_rows(i)
        weights.append(weight[w:w + rows].reshape(*s[:-1], 1) if rows else weight[-1])
        w += rows
    return parts, weights


def merged(net: Network, rows: list[tuple[bytes, bytes]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The mean change of each row, weighted by the steps that met it, and the
    weights' sums: a row that one task alone has met keeps its whole change."""
    total, weight = [np.zeros(s) for s in net.shapes], [0.0] * len(net.shapes)
    for data, counts in rows:
        for i, (d, w) in enumerate(zip(*_unpacked(net, data, counts))):
            total[i] += d * w
            weight[i] = weight[i] + w
    return [(t / np.maximum(w, 1e-9)).astype(np.float32) for t, w in zip(total, weight)], weight


def _averager(start, rules: LmRules):
    def average(rows: pd.DataFrame) -> pd.DataFrame:
        like = Network(start.value[0], rules)
        mean, weight = merged(like, list(zip(rows["change"], rows["counts"])))
        like.parts = mean
        sparse = [np.asarray(w).ravel() for i, w in enumerate(weight) if like.sparse_rows(i)]
        steps = next(w for i, w in enumerate(weight) if not like.sparse_rows(i))
        change, counts = changes(like, [np.zeros_like(p) for p in mean], sparse, steps)
        return pd.DataFrame({"part": [int(rows["part"].iloc[0]) // FAN], "seen": [int(rows["seen"].sum())], "change": [change], "counts": [counts]})

    return average


def train(encoded: DataFrame, words: Vocabulary, rules: LmRules) -> Network:
    net = Network(words, rules)
    sc = encoded.sparkSession.sparkContext
    out = StructType([StructField("part", LongType()), StructField("seen", LongType()), StructField("change", BinaryType()), StructField("counts", BinaryType())])
    # a model for each so many windows, whatever the table's files and the cluster's cores
    parts = encoded if words.mass is None else encoded.coalesce(max(1, int(words.mass.sum()) // rules.model_windows))
    for turn in range(max(rules.rounds, rules.stride)):
        start = sc.broadcast((words, net.flat()))

        def run(batches: Iterator[pa.RecordBatch], turn: int = turn, start=start) -> Iterator[pa.RecordBatch]:
            own, flat = start.value
            local = Network(own, rules).load(flat)
            before = [p.copy() for p in local.parts]
            touched = [np.zeros(local.sparse_rows(i), np.int64) for i in range(len(local.parts))]
            met: list = [[] for _ in local.parts]
            adam, seen = Adam(local, rules.rate / (1 + turn)), 0
            for b in batches:
                for group in _grouped(b.column("ids").to_pylist()):
                    token, sides, lengths = windows(group, own)
                    pick = turn_windows(lengths, turn, rules.stride)
                    pick = pick[np.random.default_rng(rules.seed + turn).permutation(len(pick))]
                    i = 0
                    while i < len(pick):
                        # small steps at first, so that small tables get enough of them
                        at = pick[i:i + min(rules.batch, max(256, seen // 16))]
                        i += len(at)
                        x = token.take(at)
                        order = local.ordered(x)
                        at, x = at.take(order), x.take(order)
                        rows, grads = local.gradient(sides.take(at, axis=1), own.klass.take(x), x)
                        adam.step(rows, grads)
                        for k, r in enumerate(rows):
                            if r is not None:
                                met[k].append(r)
                        if adam.t % 16 == 0:
                            _count(touched, met)
                        seen += len(at)
            _count(touched, met)
            if seen:
                change, counts = changes(local, before, touched, adam.t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([seen], pa.int64()), pa.array([change], pa.binary()),
                     pa.array([counts], pa.binary())], names=out.names)

        models = stage(parts.select("ids").mapInArrow(released(run), out), "lm-models")
        left = models.agg(F.max("part")).first()[0]
        while left:  # one more level of the tree
            models = stage(models.groupBy(F.floor(F.col("part") / FAN).alias("g")).applyInPandas(_averager(start, rules), out), "lm-average")
            left = models.agg(F.max("part")).first()[0]
        for r in models.collect():  # one row
            mean, _ = merged(net, [(r.change, r.counts)])
            net.parts = [p + d for p, d in zip(net.parts, mean)]
    return net


def token_scores(net: Network, words: Vocabulary, batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Conditional log-probability of every token, and the lengths."""
    token, sides, lengths = windows(batch, words)
    out = np.empty(len(token))
    for i in range(0, len(token), BLOCK):
        at = slice(i, i + BLOCK)
        out[at] = net.token_log_probs(sides[:, at], words.klass[token[at]], token[at]) + words.share[token[at]]
    return out, lengths


def score(docs: DataFrame, rules: LmRules = LmRules()) -> DataFrame:
    """doc_id, n_tokens, log_likelihood (the sum) and mean_log_likelihood."""
    ship(docs.sparkSession)
    counts = stage(word_counts(docs), "lm-counts")
    words = vocabulary(counts, rules)
    encoded = stage(encode(docs, words), "lm-tokens")
    net = train(encoded, words, rules)
    shared = docs.sparkSession.sparkContext.broadcast((words, net))
    out = StructType([docs.schema["doc_id"], StructField("n_tokens", LongType()), StructField("log_likelihood", DoubleType()),
                      StructField("mean_log_likelihood", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, model = shared.value
        for b in batches:
            sums, n = [], []
            for group in _grouped(b.column("ids").to_pylist()):
                p, lengths = token_scores(model, own, group)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                total = np.concatenate([[0.0], np.cumsum(p)])
                sums.append(total[ends[1:]] - total[ends[:-1]])
                n.append(lengths)
            n = np.concatenate(n) if n else np.empty(0, np.int64)
            s = np.where(n > 0, np.concatenate(sums) if sums else np.empty(0), 0.0)
            mean = pa.array(np.where(n > 0, s / np.maximum(n, 1), 0.0), mask=n == 0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n), pa.array(s), mean], names=out.names)

    return encoded.mapInArrow(run, out)
