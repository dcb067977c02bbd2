"""Repeated stretches (runs) of words, by online dyadic square catching.

Words are appended one after another. At level b = 1, 2, 4, ... a catcher opens
at every multiple r of b: it holds the completed block of b words before it,
each as the anchor of a candidate period q in [b, 2b). Word r, as it is
appended, keeps the candidates whose anchor equals it; every further word
advances the surviving comparisons, and the words before r are compared
backwards, suffix against suffix. A candidate whose matches reach q words has
caught a square, and squares of one period that touch merge into one run:
a stretch with smallest period q that no neighbouring word extends. Any square
of period q has a multiple of b in its second half, so none is missed; where
only runs of ``ratio`` periods are asked, every (ratio - 1)-th power of two of
the catchers is enough. A candidate inside a known run whose period divides q
is dropped: it would find that run again.

A catcher reads no word but its block and what is appended, and catchers do
not depend on each other, so those of one level of all texts of a batch step
together in numpy: 16 words one at a time, what survives then in growing
stretches. Work is n log n comparisons a text of n words beside the runs
themselves; words are compared as numbers from an exact dictionary, no hashes.

Defined cases: a null or empty text has no words, no runs and an empty
collapsed text; texts are read whole, in pieces of 1 MB; repeated rows and ids
give a row each; an empty table gives an empty result; columns beside the id
and the text are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martcraft.llm.common import ship
from martcraft.llm.hashing import pieces

#: (id, number of words) -> for each word the number of the word that takes
#: its place, None where the text stays.
Rewrite = Callable[[object, int], "np.ndarray | None"]

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class RunRules:
    ratio: int = 4         # a run has at least this many periods (2 or more)
    least: int = 6         # and at least this many words
    steps: int = 16        # words that the catchers of a level take one by one
    slab: int = 1 << 20    # candidates compared at once


@lru_cache(maxsize=4096)
def _primes(n: int) -> tuple[int, ...]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return tuple(out + [n] * (n > 1))


def _ahead(t: np.ndarray, i: int, j: int, most: int) -> int:
    """How many of ``most`` words from i on equal those from j on."""
    done, size = 0, 64
    while done < most:
        m = min(size, most - done)
        differs = t[i + done:i + done + m] != t[j + done:j + done + m]
        if differs.any():
            return done + int(differs.argmax())
        done, size = done + m, 2 * size
    return done


def _behind(t: np.ndarray, i: int, j: int, most: int) -> int:
    """The same for the words before i and before j."""
    done, size = 0, 64
    while done < most:
        m = min(size, most - done)
        differs = t[i - done - m:i - done] != t[j - done - m:j - done]
        if differs.any():
            return done + int(differs[::-1].argmax())
        done, size = done + m, 2 * size
    return done


class Catchers:
    """The catchers over the words ``ids`` of several texts; text d has the
    words from ``bounds[d]`` to ``bounds[d + 1]``."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray, rules: RunRules) -> None:
        self.rules, self.sizes = rules, np.diff(bounds)
        self.pad = 2 * max(1, int(self.sizes.max(initial=1)))  # a block may reach before its text
        self.t = np.concatenate([np.full(self.pad, -1, ids.dtype), ids])
        self.first, self.end = bounds[:-1] + self.pad, bounds[1:] + self.pad
        # of a known run over each word: its first word and its period
        self.run_at = np.zeros(len(self.t), np.int64)
        self.run_period = np.zeros(len(self.t), np.int64)

    def runs(self) -> np.ndarray:
        """Rows (text, first word in it, length, period), in this order."""
        found, b = [], 1
        while self.rules.ratio * b <= self.sizes.max(initial=0):
            new = self._level(b)
            for doc, start, stop, q in sorted(new, key=lambda r: r[2] - r[1]):
                self.run_at[start:stop], self.run_period[start:stop] = start, q
            found += [(d, s - self.first[d], e - s, q) for d, s, e, q in new]
            b *= 2
        out = np.array(found, np.int64).reshape(-1, 4)
        return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]

    def _level(self, b: int) -> list[tuple[int, int, int, int]]:
        """(text, start, stop, period) of the runs with periods in [b, 2b)."""
        rules, step = self.rules, b << ((self.rules.ratio - 1).bit_length() - 1)
        docs = np.flatnonzero(self.sizes >= rules.ratio * b)
        opens = (self.sizes[docs] - 1) // step
        doc = np.repeat(docs, opens)
        at = self.first[doc] + step * (1 + np.arange(len(doc)) - np.repeat(np.cumsum(opens) - opens, opens))
        blocks = np.lib.stride_tricks.sliding_window_view(self.t, b)
        out: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for lo in range(0, len(at), max(1, rules.slab // b)):
            r, d = at[lo:lo + max(1, rules.slab // b)], doc[lo:lo + max(1, rules.slab // b)]
            which, place = np.nonzero(blocks[r - 2 * b + 1] == self.t[r][:, None])
            self._follow(r[which], 2 * b - 1 - place, d[which], out)
        return [run for run in out.values() if not self._shorter(run[1], run[3])]

    def _follow(self, r: np.ndarray, q: np.ndarray, doc: np.ndarray, out: dict) -> None:
        """Advance the candidates of period q whose anchor equals word r."""
        t, rules = self.t, self.rules
        known = self.run_period[r]
        again = (self.run_at[r] <= r - q) & (q % np.where(known > 0, known, q + 1) == 0)
        keep = ~again & (r - q >= self.first[doc]) & (rules.ratio * q <= self.sizes[doc])
        r, q, doc = r[keep], q[keep], doc[keep]
        first, end = self.first[doc], self.end[doc]
        ahead, behind = np.ones(len(r), np.int64), np.zeros(len(r), np.int64)
        up = down = np.arange(len(r))
        for _ in range(rules.steps):
            at = r[up] + ahead[up]
            inside = at < end[up]
            up, at = up[inside], at[inside]
            up = up[t[at] == t[at - q[up]]]
            ahead[up] += 1
            at = r[down] - behind[down] - 1
            inside = at - q[down] >= first[down]
            down, at = down[inside], at[inside]
            down = down[t[at] == t[at - q[down]]]
            behind[down] += 1
            if not len(up) and not len(down):
                break
        live = np.zeros(len(r), bool)
        live[up] = live[down] = True
        enough = ahead + behind + q >= np.maximum(rules.least, rules.ratio * q)
        for i in np.flatnonzero(enough & ~live).tolist():
            start, stop = int(r[i] - behind[i] - q[i]), int(r[i] + ahead[i])
            out[start, int(q[i])] = int(doc[i]), start, stop, int(q[i])
        rest = np.flatnonzero(live)
        rest = rest[np.lexsort((r[rest], q[rest]))]
        rr, qq, i = r[rest], q[rest], 0
        while i < len(rest):
            at, period, k = int(rr[i]), int(qq[i]), rest[i]
            stop = at + _ahead(t, at, at - period, int(end[k]) - at)
            begin = at - _behind(t, at, at - period, at - period - int(first[k]))
            if stop - begin + period >= max(rules.least, rules.ratio * period):
                out[begin - period, period] = int(doc[k]), begin - period, stop, period
            # the other catchers inside these matches would merge with them
            same = int(np.searchsorted(qq, period, "right"))
            i += 1 + int(np.searchsorted(rr[i + 1:same], stop))

    def _shorter(self, start: int, q: int) -> bool:
        """Whether the stretch has a smaller period (which then divides q)."""
        t = self.t
        return any(np.array_equal(t[start:start + q - q // p], t[start + q // p:start + q]) for p in _primes(q))


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """False for the words of a run after its first period. ``runs``: rows
    (start, length, period)."""
    cut = np.zeros(n + 1, np.int64)
    np.add.at(cut, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cut, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(cut)[:n] == 0


def _words(raw: bytes, most: int = 1_000_000) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``most`` bytes."""
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + most) if len(raw) - at > most else None
        stop = cut.start() if cut else len(raw)
        yield raw[at:stop].split()
        at = stop


def _numbered(raw: bytes, number: defaultdict) -> np.ndarray:
    parts = [np.fromiter(map(number.__getitem__, w), np.int32, len(w)) for w in _words(raw)]
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def _collapsed(raw: bytes, keep: np.ndarray, order: np.ndarray | None) -> bytes:
    if order is not None:
        words = [w for part in _words(raw) for w in part]
        return b" ".join([words[i] for i in order[keep].tolist()])
    out, at = [], 0
    for part in _words(raw):
        out.append(b" ".join(compress(part, keep[at:at + len(part)].tolist())))
        at += len(part)
    return b" ".join(p for p in out if p)


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _scan(rules: RunRules, rewrite: Rewrite | None):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in pieces(texts):
                number: defaultdict = defaultdict()
                number.default_factory = number.__len__
                ids, orders = [], []
                for i in part:
                    found = _numbered(texts[i] or b"", number)
                    order = rewrite(batch.column(0)[i].as_py(), len(found)) if rewrite else None
                    ids.append(found if order is None else found[order])
                    orders.append(order)
                del number
                bounds = np.cumsum([0] + [len(x) for x in ids])
                runs = Catchers(np.concatenate(ids), bounds, rules).runs()
                cuts = np.searchsorted(runs[:, 0], np.arange(len(part) + 1))
                texts_out = [_collapsed(texts[i] or b"", kept_words(len(x), runs[a:z, 1:]), order)
                             for i, x, order, a, z in zip(part, ids, orders, cuts, cuts[1:])]
                spans = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in (1, 2, 3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part[0], len(part)), pa.array(np.diff(bounds).astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans), pa.array(texts_out, pa.binary())],
                    names=["id", "n_words", "runs", "collapsed"])

    return scan


def find_runs(docs: DataFrame, rules: RunRules = RunRules(), id_col: str = "doc_id", text: str = "text",
              rewrite: Rewrite | None = None) -> DataFrame:
    """One row for each row: its id, ``n_words``, ``runs`` (structs start,
    length, period, by start, then period) and ``collapsed``, the words outside
    the repetitions (a run's first period stays), joined by one space.
    ``rewrite`` may put other words of the same text in a word's place first."""
    if rules.ratio < 2:
        raise ValueError("a run has at least two periods")
    ship(docs.sparkSession)
    id_field = docs.schema[id_col]
    schema = StructType([StructField("id", id_field.dataType), StructField("n_words", LongType())]).simpleString()
    fields = schema[len("struct<"):-1] + ",runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:binary"
    out = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("binary").alias("raw")).mapInArrow(
        _scan(rules, rewrite), fields)
    return out.select(F.col("id").alias(id_col), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def strongest(runs: str = "runs") -> Column:
    """The run of greatest exact length / period, the first of equal ones; null
    without a run."""
    better = lambda a, x: x["length"] * a["period"] > a["length"] * x["period"]
    return F.when(F.size(runs) > 0, F.aggregate(
        F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(F.col(runs), F.lit(0)),
        lambda a, x: F.when(better(a, x), x).otherwise(a)))
