"""Toxicity scores from a fuzzy lexicon and the context of its hits.

The lexicon is learned from labelled documents: words, and word stems, that
documents marked toxic hold far more often than others (log-likelihood ratio).
Its trie is intersected with the Levenshtein automaton of each word of a text
(insertions, deletions, substitutions, swapped neighbours; 0, 1 or 2 by the
term's length), so misspelled terms are found too; both are run as one lazily
determinised automaton. Words that match by chance and that labelled clean
documents use are left out. Every hit has a context window: hits inside
quotation marks are counted apart (no evidence unless labels say so), and the
window's words add log-odds learned from labelled hits. A logistic regression
over these counts gives the score.

The model learns from at most ``max_labelled`` documents of each label (those
with the least hash of doc_id, held-out rows never), a documented bound.
lang, source and doc_id are no inputs of a score; whole texts are read.

Defined cases: null and empty texts have no hits and get the score of that;
without labelled documents of both kinds every score is 0; null labels are
ignored; repeated rows and null ids come back each; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from martcraft.llm.common import bounded_sample, held_out, ship, stage

OPEN, CLOSE = "\"'“„«‘‹", "\"'”“»’›"
EDGE = " .,;:!?()[]{}<>|*#$%&\"'“”„«»‘’‹›…"
CONTEXT_CELLS = 4096
#: What ``str.split`` takes for white space, as a pattern of Java's.
BLANKS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
FEATURES = ("exact", "stems", "fuzzy", "quoted", "density", "context")


@dataclass(frozen=True)
class ToxicityRules:
    max_labelled: int = 4000
    min_evidence: float = 28.0   # log-likelihood ratio (G squared) of a term
    clean_share: float = 0.02    # at most this much of the toxic rate in clean documents
    stem_lengths: tuple[int, ...] = (4, 5, 6, 7)
    window: int = 4
    threshold: float = 0.7


@dataclass
class Model:
    words: list[str] = field(default_factory=list)
    stems: list[str] = field(default_factory=list)
    ordinary: list[str] = field(default_factory=list)
    context: np.ndarray = field(default_factory=lambda: np.zeros(CONTEXT_CELLS))
    weights: np.ndarray | None = None
    window: int = 4


def allowed(term: str) -> int:
    """Edits that a term of this length may have."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class FuzzyTrie:
    """Lexicon trie times Levenshtein automaton. A state is a set of (trie
    node, edits so far, character still due after a swap); states and moves
    are kept as they are met, at most ``MAX_STATES``."""

    MAX_STATES = 100_000
    WORD, STEM, FUZZY = 1, 2, 3

    def __init__(self, words: list[str], stems: list[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[int] = [-1]      # edits allowed for the word that ends here
        self.stem: list[bool] = [False]
        self.room: list[int] = [0]       # most edits allowed for a word below
        for term in words:
            self._add(term, allowed(term), False)
        for term in stems:
            self._add(term, 0, True)
        self._clear()

    def _add(self, term: str, edits: int, stem: bool) -> None:
        node = 0
        self.room[0] = max(self.room[0], edits)
        for ch in term:
            if ch not in self.children[node]:
                self.children[node][ch] = len(self.children)
                self.children.append({})
                self.ends.append(-1)
                self.stem.append(False)
                self.room.append(0)
            node = self.children[node][ch]
            self.room[node] = max(self.room[node], edits)
        if stem:
            self.stem[node] = True
        else:
            self.ends[node] = edits

    def _clear(self) -> None:
        self.moves: dict[tuple[int, str], int] = {}
        self.ids: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.kinds: list[int] = []
        self.start = self._state({(0, 0, "")})

    def _state(self, items: set) -> int:
        todo = list(items)
        while todo:  # the text lacks a character of the term
            node, e, due = todo.pop()
            if not due:
                for child in self.children[node].values():
                    new = (child, e + 1, "")
                    if e < self.room[child] and new not in items:
                        items.add(new)
                        todo.append(new)
        key = frozenset(items)
        if key not in self.ids:
            self.ids[key] = len(self.sets)
            self.sets.append(key)
            kind = 0
            for node, e, due in key:
                if node < 0 or (e == 0 and self.stem[node]):
                    kind = kind or self.STEM
                elif not due and 0 <= e <= self.ends[node]:
                    kind = self.WORD if e == 0 else kind or self.FUZZY
            self.kinds.append(kind)
        return self.ids[key]

    def _move(self, state: int, ch: str) -> int:
        out = set()
        for node, e, due in self.sets[state]:
            if node < 0 or (e == 0 and self.stem[node]):
                out.add((-1, 0, "-"))
                if node < 0:
                    continue
            if due:
                if ch == due:
                    out.add((node, e, ""))
                continue
            kids = self.children[node]
            if ch in kids:
                out.add((kids[ch], e, ""))
            if e < self.room[node]:
                out.add((node, e + 1, ""))
            for c, child in kids.items():
                if e < self.room[child]:
                    if c != ch:
                        out.add((child, e + 1, ""))
                    swapped = self.children[child].get(ch)
                    if swapped is not None and e < self.room[swapped] and c != ch:
                        out.add((swapped, e + 1, c))
        return self._state(out) if out else -1

    def kind(self, word: str) -> int:
        """WORD, STEM or FUZZY where the lexicon has the word, else 0."""
        if len(self.sets) > self.MAX_STATES:
            self._clear()
        state, moves = self.start, self.moves
        for ch in word:
            key = (state, ch)
            state = moves.get(key, -2)
            if state == -2:
                state = moves[key] = self._move(*key)
            if state < 0:
                return 0
        return self.kinds[state]


class Matcher(dict):
    """token -> kind of hit, filled as tokens are met; bounded."""

    MOST = 400_000

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.trie, self.ordinary = FuzzyTrie(model.words, model.stems), frozenset(model.ordinary)

    def __missing__(self, token: str) -> int:
        core = token.strip(EDGE)
        kind = 0 if not core or core in self.ordinary else self.trie.kind(core)
        if len(self) >= self.MOST:
            self.clear()
        self[token] = kind
        return kind


def _quoted(words: list[str], i: int, window: int) -> bool:
    """Whether an opening mark stands at or before word i and a closing one
    at or after it, within the window and with no closing mark between."""
    for j in range(i, max(-1, i - window - 1), -1):
        if j < i and words[j].rstrip(".,;:!?")[-1:] in CLOSE and words[j].rstrip(".,;:!?"):
            return False
        if words[j][0] in OPEN:
            break
    else:
        return False
    return any((w := words[j].rstrip(".,;:!?")) and w[-1] in CLOSE and (j > i or len(w) > 1)
               for j in range(i, min(len(words), i + window + 1)))


def _cell(word: str) -> int:
    return zlib.crc32(word.encode()) % CONTEXT_CELLS


def look(text: str | None, matcher: Matcher, window: int) -> tuple[list[int], list[int]]:
    """Counts (exact, stems, fuzzy, quoted, words) and the context cells of
    the hits outside quotations."""
    words = (text or "").lower().split()
    n, cells = [0, 0, 0, 0, len(words)], []
    kinds = [matcher[w] for w in words]
    if any(kinds):
        for i, kind in enumerate(kinds):
            if kind:
                if _quoted(words, i, window + 2):
                    n[3] += 1
                else:
                    n[kind - 1] += 1
                    cells += [_cell(w) for w in words[max(0, i - window):i] + words[i + 1:i + 1 + window]]
    return n, cells


def design(counts: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Features of documents from their counts and summed context log-odds."""
    exact, stems, fuzzy, quoted, words = counts.T.astype(float)
    hits = exact + stems
    return np.stack([np.log1p(exact), np.log1p(stems), np.log1p(fuzzy), np.log1p(quoted),
                     np.log1p(100 * hits / (words + 5)), np.clip(context, -5, 5), np.ones(len(words))], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> np.ndarray:
    """Newton steps; a feature that never occurs keeps the weight 0."""
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + keep * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return w


def _labelled(docs: DataFrame, labels: DataFrame, rules: ToxicityRules) -> DataFrame:
    """text and toxic of the sample: bounded by rows of each label."""
    rows = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where(
        ~held_out("_id") & F.col("_id").isNotNull())
    chosen = stage(bounded_sample(rows.where("toxic in (0, 1)"), "_id", rules.max_labelled, ("toxic",)), "toxicity-chosen")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("text", "toxic")


def _evidence(n_toxic: float, n_clean: float) -> str:
    """G squared of the toxic and clean counts t and c, SQL text; 0 where
    clean documents have more."""
    et, ec = f"((t + c) * {n_toxic / (n_toxic + n_clean)!r})", f"((t + c) * {n_clean / (n_toxic + n_clean)!r})"
    return (f"if(t * {n_clean!r} <= c * {n_toxic!r}, 0D, 2 * (t * ln(t / {et}) + if(c = 0, 0D, c * ln(c / {ec}))))")


def fit(docs: DataFrame, labels: DataFrame, rules: ToxicityRules = ToxicityRules()) -> Model:
    """Learn the lexicon, the ordinary look-alikes, the context log-odds and
    the weights."""
    ship(docs.sparkSession)
    model = Model(window=rules.window)
    train = stage(_labelled(docs, labels, rules), "toxicity-train")
    sizes = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    n1, n0 = float(sizes.get(1, 0)), float(sizes.get(0, 0))
    if not n1 or not n0:
        return model
    words = F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), BLANKS))
    by_word = stage(
        train.select("toxic", F.explode(words).alias("w")).select("toxic", F.expr(f"btrim(w, {_sql(EDGE)})").alias("w"))
        .where("w <> ''").groupBy("w").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")), "toxicity-words")

    def pick(table: DataFrame, a: float, b: float) -> list[str]:
        rows = (table.where(f"t >= 3 and c * {a!r} <= t * {b!r} * {rules.clean_share!r}")
                .withColumn("g", F.expr(_evidence(a, b))).where(F.col("g") >= rules.min_evidence)
                .select("w").collect())  # at most a third of the sample's distinct words
        return [r.w for r in rows]

    model.words = sorted(pick(by_word, n1, n0))
    heads = by_word.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.substring("w", 1, k).alias("w")) for k in rules.stem_lengths])).alias("e"),
                           F.length("w").alias("n"), "t", "c").where("n > e.k")
    heads = heads.groupBy(F.col("e.w").alias("w")).agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count("*").alias("forms"))
    mass = by_word.agg(F.sum("t"), F.sum("c")).first()
    found = pick(heads.where("forms >= 4"), float(mass[0]), float(max(mass[1], 1))) if mass[0] else []
    short = set()
    for stem in sorted(found, key=len):  # the shortest of nested stems
        if not any(stem[:k] in short for k in range(1, len(stem))):
            short.add(stem)
    model.stems = sorted(short)

    trie = FuzzyTrie(model.words, model.stems)

    def look_alikes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([trie.kind(w) == FuzzyTrie.FUZZY for w in b.column("w").to_pylist()], pa.bool_()))

    alike = by_word.where(f"c >= 1 and c * {n1!r} > 0.2 * t * {n0!r}").mapInArrow(look_alikes, by_word.schema)
    model.ordinary = sorted(r.w for r in alike.select("w").collect())

    looked = stage(_looked(train, model, ["toxic"]), "toxicity-looked")
    seen = np.full((2, CONTEXT_CELLS), 0.0)
    for r in looked.select("toxic", F.explode("cells").alias("cell")).groupBy("toxic", "cell").count().collect():  # two rows a cell at most
        seen[r.toxic, r.cell] = r["count"]
    rate = (seen + 2.0) / (seen + 2.0).sum(axis=1, keepdims=True)
    # cells that only one label's hits have met say little: shrunk by the counts
    model.context = np.log(rate[1] / rate[0]) * (seen.min(axis=0) / (seen.min(axis=0) + 5.0))
    rows = _in_context(looked, model).collect()  # six numbers a row of the sample
    counts = np.array([r.counts for r in rows], float).reshape(-1, 5)
    model.weights = _logistic(design(counts, np.array([r.context for r in rows])), np.array([r.toxic for r in rows], float))
    return model


def _sql(text: str) -> str:
    return "'" + "".join(f"\\u{ord(c):04x}" for c in text) + "'"


def _looked(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    out = StructType([*[docs.schema[c] for c in keep], StructField("counts", ArrayType(LongType())),
                      StructField("cells", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for b in batches:
            got = [look(t, matcher, model.window) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array([g[0] for g in got], pa.list_(pa.int64())),
                 pa.array([g[1] for g in got], pa.list_(pa.int32()))], names=out.names)

    return docs.select(*keep, "text").mapInArrow(run, out)


def _in_context(looked: DataFrame, model: Model) -> DataFrame:
    """toxic, counts and the mean log-odds of the context cells."""
    out = StructType([*looked.schema.fields[:2], StructField("context", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mean = [model.context[c].mean() if c else 0.0 for c in b.column("cells").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), b.column("counts"), pa.array(mean, pa.float64())], names=out.names)

    return looked.mapInArrow(run, out)


def score(docs: DataFrame, model: Model, rules: ToxicityRules = ToxicityRules()) -> DataFrame:
    """doc_id, held_out, score, predicted and the counts of hits."""
    ship(docs.sparkSession)
    src = docs.select("doc_id", held_out().alias("held_out"), "text")
    names = ("n_exact", "n_stems", "n_fuzzy", "n_quoted", "n_words")
    out = StructType([*src.schema.fields[:2], StructField("score", DoubleType()), StructField("predicted", IntegerType()),
                      *[StructField(n, LongType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for b in batches:
            got = [look(t, matcher, model.window) for t in b.column("text").to_pylist()]
            counts = np.array([g[0] for g in got], np.int64).reshape(-1, 5)
            context = np.array([model.context[g[1]].mean() if g[1] else 0.0 for g in got])
            if model.weights is None:
                p = np.zeros(len(got))
            else:
                p = 1 / (1 + np.exp(-np.clip(design(counts, context) @ model.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(p), pa.array((p >= rules.threshold).astype(np.int32)),
                 *[pa.array(counts[:, i].copy()) for i in range(5)]], names=out.names)

    return src.mapInArrow(run, out)
