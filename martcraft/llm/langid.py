"""Language identification by prediction by partial matching (PPM).

For every language a byte context tree of order ``ORDER`` is counted on
labelled texts and frozen. A byte that a context has seen n_s of n times, with
d different bytes seen there, has the probability n_s / (n + d); the escape
probability d / (n + d) goes to the bytes not seen there, shared as the next
shorter context predicts them (renormalised); below the empty context all 256
bytes are alike. A text's exact code length in bits under each language's
statistics is summed over all of its bytes; the shortest wins. Because the
statistics are frozen, the code lengths of each (context, byte) are tabulated
once and a text is scored by table look-ups.

The trees learn from at most ``max_documents`` documents of each language
(least hash of doc_id, held-out rows and null languages never), the documented
bound, and keep every context counted there. The ``max_contexts`` most frequent
of the full order are tabulated for all bytes; the others hold the bytes they
have seen and their escape, and a text meets them by search, with the same code
lengths.

Defined cases: null text and text without any letter is ``und`` with score 0,
and so is every text where nothing could be learned; equal code lengths go to
the first language by name; texts are scored whole, in pieces of 1 MB or one
text; repeated rows and null ids come back each (null ids are not learned
from); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from martcraft.llm.common import WORKER_TABLES, bounded_sample, held_out, released, ship, stage

ORDER = 3
START = b"\n" * ORDER  # what stands before a text
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


@dataclass(frozen=True)
class LanguageRules:
    max_documents: int = 300
    max_contexts: int = 20_000


def _grams(raw: np.ndarray, order: int) -> np.ndarray:
    """Context of ``order`` bytes and the next byte, packed, of each byte
    after START."""
    out = np.zeros(len(raw) - ORDER, np.int64)
    for k in range(order, -1, -1):
        out = out << 8 | raw[ORDER - k:len(raw) - k]
    return out


def count(docs: DataFrame, rules: LanguageRules) -> list[tuple[str, int, int, int]]:
    """(language, order, packed context and byte, count) of the sample."""
    ship(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    chosen = stage(bounded_sample(rows.select(F.col("lang").alias("__llm_lang"), F.col("doc_id").alias("__llm_id")), "__llm_id", rules.max_documents,
                                  ("__llm_lang",))
                   .distinct(), "langid-chosen")
    sample = docs.join(F.broadcast(chosen), (F.col("lang") == F.col("__llm_lang")) & (F.col("doc_id") == F.col("__llm_id")))
    sample = sample.where("text is not null").select("lang", F.col("text").cast("binary").alias("text"))
    out = StructType([StructField("lang", StringType()), StructField("order", LongType()),
                      StructField("gram", LongType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                raw = np.frombuffer(START + text, np.uint8).astype(np.int64)
                for order in range(ORDER + 1):
                    gram, n = np.unique(_grams(raw, order), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(gram), pa.string()), pa.array(np.full(len(gram), order, np.int64)),
                         pa.array(gram), pa.array(n.astype(np.int64))], names=out.names)

    table = sample.mapInArrow(run, out).groupBy("lang", "order", "gram").agg(F.sum("n").alias("n"))
    return [(r.lang, r.order, r.gram, r.n) for r in table.collect()]


class Tables:
    """Code lengths of every kept context and byte class, for all languages.
    Bytes that no language has seen form class 0: they cost the same in every
    context, so the classes lose nothing."""

    def __init__(self, counts: list[tuple[str, int, int, int]], max_contexts: int) -> None:
        self.langs = sorted({c[0] for c in counts})
        lang_no = {x: i for i, x in enumerate(self.langs)}
        langs = len(self.langs)
        lang = np.array([lang_no[c[0]] for c in counts], np.int64)
        order = np.array([c[1] for c in counts], np.int64)
        gram = np.array([c[2] for c in counts], np.int64)
        n = np.array([c[3] for c in counts], float)
        self.klass = np.zeros(256, np.int32)
        used = np.unique(np.concatenate([gram[order == 0], np.frombuffer(START, np.uint8)]))
        self.klass[used] = np.arange(1, len(used) + 1)
        self.size = size = len(used) + 1

        def packed(values: np.ndarray, bytes_: int) -> np.ndarray:
            out = np.zeros(len(values), np.int64)
            for k in range(bytes_ - 1, -1, -1):
                out = out * size + self.klass[values >> 8 * k & 255]
            return out

        below = np.full((1, size, langs), 1 / 256)  # order -1
        parent = np.zeros(1, np.int64)
        tables, self.node, base, self.rare = [], np.zeros(size ** ORDER, np.int32), 0, None
        for k in range(ORDER + 1):
            mine = order == k
            context, symbol = packed(gram[mine] >> 8, k), self.klass[gram[mine] & 255]
            keep, total = np.unique(context, return_inverse=True)
            if k == ORDER and len(keep) > max_contexts:
                weight = np.bincount(total, n[mine])
                top = np.sort(np.argsort(-weight, kind="stable")[:max_contexts])
                inside = np.isin(context, keep[top])
                mine = np.flatnonzero(mine)
                self._sparse(context[~inside], symbol[~inside], lang[mine[~inside]], n[mine[~inside]], below)
                mine = mine[inside]
                context, symbol, keep = context[inside], symbol[inside], keep[top]
            at = np.searchsorted(keep, context)
            seen = np.zeros((len(keep), size, langs))
            np.add.at(seen, (at, symbol, lang[mine]), n[mine])
            if k:
                parent = np.searchsorted(self._keys, keep % size ** (k - 1))
            prior = below[parent]
            has = seen > 0
            kinds, total = has.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
            rest = 1 - (prior * has).sum(axis=1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                p = np.where(has, seen / (total + kinds), kinds / (total + kinds) * prior / np.maximum(rest, 1e-300))
            below = np.where(kinds > 0, p, prior)
            self._keys = keep
            tables.append((-np.log2(below)).astype(np.float32).reshape(-1, langs))
            # the longest kept context of a triple wins
            grid = self.node.reshape((size,) * ORDER)
            digits = [keep // size ** i % size for i in range(k - 1, -1, -1)]
            grid[(..., *digits)] = base + np.arange(len(keep), dtype=np.int32)
            base += len(keep)
        self.cost = np.concatenate(tables)

    def _sparse(self, context: np.ndarray, symbol: np.ndarray, lang: np.ndarray, n: np.ndarray, below: np.ndarray) -> None:
        """Contexts kept by their seen bytes: number of each triple's context
        (-1: none), escape costs, and the costs of seen (context, byte)s (NaN
        where a language has not seen it)."""
        keep, at = np.unique(context, return_inverse=True)
        shape = len(keep), len(self.langs)
        prior = below[np.searchsorted(self._keys, keep % self.size ** (ORDER - 1))[at], symbol, lang]
        total, kinds, met = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        for into, value in ((total, n), (kinds, 1.0), (met, prior)):
            np.add.at(into, (at, lang), value)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(kinds > 0, kinds / (total + kinds) / np.maximum(1 - met, 1e-300), 1.0)
            self.escape = -np.log2(escape).astype(np.float32)
        self.rare = np.full(self.size ** ORDER, -1, np.int32)
        self.rare[keep] = np.arange(len(keep))
        self.seen, place = np.unique(at * self.size + symbol, return_inverse=True)
        self.seen_cost = np.full((len(self.seen), shape[1]), np.nan, np.float32)
        self.seen_cost[place, lang] = -np.log2(n / (total + kinds)[at, lang])

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language."""
        out = np.zeros((len(texts), len(self.langs)))
        part, held = [], 0
        for i, t in enumerate(texts):
            part.append(i)
            held += len(t)
            if held > 1_000_000 or i + 1 == len(texts):
                self._part(texts, part, out)
                part, held = [], 0
        return out

    def _part(self, texts: list[bytes], part: list[int], out: np.ndarray) -> None:
        part = [i for i in part if texts[i]]
        if not part:
            return
        code = self.klass[np.frombuffer(START + START.join(texts[i] for i in part), np.uint8)]
        size = self.size
        context = (code[:-3] * size + code[1:-2]) * size + code[2:-1]
        cost = self.cost[self.node[context].astype(np.int64) * size + code[3:]]
        if self.rare is not None:
            at = np.flatnonzero(self.rare[context] >= 0)
            own = self.rare[context[at]].astype(np.int64)
            key = own * size + code[3:][at]
            place = np.minimum(np.searchsorted(self.seen, key), len(self.seen) - 1)
            seen = np.where((self.seen[place] == key)[:, None], self.seen_cost[place], np.nan)
            cost[at] = np.where(np.isnan(seen), cost[at] + self.escape[own], seen)
        lengths = np.array([len(texts[i]) for i in part])
        starts = np.concatenate([[0], np.cumsum(lengths + ORDER)[:-1]])
        edges = np.stack([starts, starts + lengths], axis=1).ravel()[:-1]
        out[part] = np.add.reduceat(cost, edges, axis=0, dtype=np.float64)[::2]


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    if _ASCII_LETTER.search(text):
        return True
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def identify(docs: DataFrame, rules: LanguageRules = LanguageRules()) -> DataFrame:
    """doc_id, held_out, lang_pred, score (the language's posterior with equal
    priors) and bits (the shortest code length; null for ``und``)."""
    ship(docs.sparkSession)
    counts = count(docs, rules)
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # bounded by the sample
    src = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("binary").alias("_text"))
    out = StructType([*src.schema.fields[:2], StructField("lang_pred", StringType()), StructField("score", DoubleType()),
                      StructField("bits", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for b in batches:
            texts = b.column("_text").to_pylist()
            known = [i for i, t in enumerate(texts) if has_letter(t)] if shared.value else []
            pred, score, best = ["und"] * len(texts), np.zeros(len(texts)), [None] * len(texts)
            if known:
                tables = tables or _tables(shared.value, rules.max_contexts)
                bits = tables.bits([texts[i] for i in known])
                first = bits.argmin(axis=1)
                least = bits.min(axis=1)
                chance = 1 / np.exp2(np.minimum(least[:, None] - bits, 0)).sum(axis=1)
                for j, i in enumerate(known):
                    pred[i], score[i], best[i] = tables.langs[first[j]], chance[j], float(least[j])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(pred, pa.string()), pa.array(score),
                 pa.array(best, pa.float64())], names=out.names)

    return src.mapInArrow(released(run, "langid"), out)


_LAST: dict = WORKER_TABLES.setdefault("langid", {})


def _tables(counts: list, max_contexts: int) -> Tables:
    """The tables of these counts, built once in a worker."""
    if _LAST.get("of") is not counts or _LAST["most"] != max_contexts:
        _LAST.update(of=counts, most=max_contexts, tables=Tables(counts, max_contexts))
    return _LAST["tables"]
