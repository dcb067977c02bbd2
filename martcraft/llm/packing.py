"""Mixture-controlled packing by deficit round-robin.

Every source is a queue: the stream of its documents' ids, in the order of the
input. Windows are filled in spans of ``span_tokens`` ids. How far each queue
has come by the start of a span follows from the target shares and the queues'
lengths alone (prefix sums, no sequential pass), so a span draws on all
sources' streams wherever their documents lie: sources that are clustered in
the input are mixed as any others, and a hot source is cut by spans.

Inside a span each queue's deficit grows by its target share of the window;
queues are served in turn while their deficit lasts (a queue whose deficit is
under ``min_piece`` waits and keeps it), and room that is left goes to the
largest deficit, which may thereby become negative. Deficits carry over from
window to window, and a span starts with what is owed at its beginning: target
share of all before, less what the whole ids before it hold.

The target shares default to the sources' shares of all tokens. With given
``targets`` the named sources keep their shares until one runs out, the others
then divide its share, and sources without a target come last.

One pass tokenizes and writes, for each chunk of consecutive documents, a row a
source (a chunk holds at most ``chunk_tokens`` ids, longer documents go on in
the next one). The rows are cut at the spans' limits, the pieces go to their
span by a shuffle of 16-bit ids, and spans are filled one by one.

A span's last ids, fewer than a window, form sequences whose lengths are powers
of two, so no sequence needs padding. Each id lies in exactly one piece.

Defined cases: null or empty text is one end id; a null source is a queue of
its own; repeated rows and null ids are packed each; texts are taken whole; an
empty table gives an empty result; columns beside doc_id, text and source are
not read.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from martcraft.llm.common import WORKER_TABLES, released, ship, stage


@dataclass(frozen=True)
class PackRules:
    window: int = 4096
    min_piece: int = 256
    chunk_tokens: int = 1 << 20
    span_tokens: int = 1 << 20
    end_id: int = 2
    tokenizer: str | None = None            # a tokenizers JSON file on every executor
    targets: tuple[tuple[str, float], ...] = ()


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def _little(code: str, numbers: list[int]) -> bytes:
    out = array(code, numbers)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordIds(dict):
    """ids (little-endian 16 bit) of a run of characters without ASCII white
    space. The tokenizer never merges across white space, so the ids of a
    text are those of its runs, and each run is encoded once while it stays
    in this bounded table. Plain Latin words skip the general pre-tokenizer."""

    MOST = 400_000
    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)")

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        self.fast = self._plain_allowed(spec)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are held in 16 bits")
        self.model = self.tokenizer.model
        # bytes 0xA1-0xAC and 0xAE-0xFF stand for themselves, others are moved up
        moved = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
        to = {b: chr(256 + i) for i, b in enumerate(moved)}
        self.byte_chars = {ord(c): "".join(to.get(b, chr(b)) for b in c.encode()) for c in map(chr, range(0xC0, 0x100))}

    @staticmethod
    def _plain_allowed(spec: dict) -> bool:
        kinds = [p["type"] for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        return (spec["model"]["type"] == "BPE" and kinds == ["Split", "ByteLevel"]
                and steps == ["NFC", "Replace", "Lowercase"])

    def __missing__(self, run: bytes) -> bytes:
        text = run.decode("utf-8", "replace")
        m = self.PLAIN.fullmatch(text) if self.fast else None
        if m:
            ids = [t.id for t in self.model.tokenize(m[1].lower().translate(self.byte_chars))]
            if m[2]:
                ids += [t.id for t in self.model.tokenize(m[2])]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        if len(self) >= self.MOST:
            self.clear()
        out = self[run] = _little("H", ids)
        return out

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


_ENCODERS: dict[str, WordIds] = WORKER_TABLES.setdefault("packing", {})


def encoder(path: str) -> WordIds:
    """One table of runs for each Python worker, until another operator runs
    there."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordIds(path)
    return _ENCODERS[path]


def chunks(docs: DataFrame, rules: PackRules) -> DataFrame:
    """part, chunk, source, tokens, parallel arrays about the pieces of that
    source's documents in it, ids."""
    ship(docs.sparkSession)
    path = rules.tokenizer or default_tokenizer()
    src = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    id_type = docs.schema["doc_id"].dataType
    out = StructType([StructField("part", LongType()), StructField("chunk", LongType()), StructField("source", StringType()),
                      StructField("tokens", LongType()), StructField("doc_id", ArrayType(id_type)),
                      *[StructField(c, ArrayType(LongType())) for c in ("start", "n", "doc_tokens")], StructField("ids", BinaryType())])
    size = rules.chunk_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = encoder(path), _little("H", [rules.end_id])
        part, chunk, held, queues, id_arrow = TaskContext.get().partitionId(), 0, 0, {}, None

        def emit() -> pa.RecordBatch:
            rows = [(source, *zip(*pieces)) for source, pieces in queues.items()]
            longs = pa.list_(pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([part] * len(rows), pa.int64()), pa.array([chunk] * len(rows), pa.int64()),
                 pa.array([r[0] for r in rows], pa.string()), pa.array([sum(r[3]) for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.list_(id_arrow)), *[pa.array([r[i] for r in rows], longs) for i in (2, 3, 4)],
                 pa.array([b"".join(r[5]) for r in rows], pa.binary())], names=out.names)

        for b in batches:
            id_arrow = b.column("doc_id").type
            for doc, source, text in zip(*[b.column(c).to_pylist() for c in ("doc_id", "source", "text")]):
                data = words.encode(text) + end
                total, start = len(data) // 2, 0
                while start < total:
                    n = min(total - start, size - held)
                    queues.setdefault(source, []).append((doc, start, n, total, data[2 * start:2 * (start + n)]))
                    start += n
                    held += n
                    if held == size:
                        yield emit()
                        chunk, held, queues = chunk + 1, 0, {}
        if queues:
            yield emit()

    return src.mapInArrow(released(run, "packing"), out)


def phases(named: dict[str, int], targets: dict[str, float]) -> list[dict[str, tuple[float, float]]]:
    """For each phase the named sources that are served in it, with how far
    their streams are at its start and end."""
    at, out = dict.fromkeys(named, 0.0), []
    while live := {s: targets[s] for s in named if targets[s] > 0 and at[s] < named[s]}:
        # tokens of the phase in units of the weights: until the first runs out
        first = min(live, key=lambda s: (named[s] - at[s]) / live[s])
        units = (named[first] - at[first]) / live[first]
        ends = {s: float(named[s]) if s == first else min(float(named[s]), at[s] + w * units) for s, w in live.items()}
        out.append({s: (at[s], ends[s]) for s in live})
        at.update(ends)
    return out


def schedule(per_source: DataFrame, rules: PackRules) -> DataFrame:
    """source, begin, finish (of its stream, in tokens), first (span) and spans
    of each phase in which the source is served."""
    spark = per_source.sparkSession
    targets = {s: w for s, w in rules.targets if w > 0}
    named = {r.source: r.n for r in per_source.where(F.col("source").isin(list(targets))).collect()} if targets else {}  # as many as targets
    rows, span = [], 0
    for phase in phases(named, targets):
        total = sum(z - a for a, z in phase.values())
        count = max(1, round(total / rules.span_tokens))
        rows += [(s, int(a), int(z), span, count) for s, (a, z) in phase.items() if int(z) > int(a)]
        span += count
    rest = per_source.where(F.col("source").isNull() | ~F.col("source").isin(list(named))) if named else per_source
    total = rest.agg(F.sum("n")).first()[0] or 0  # one number
    count = max(1, round(total / rules.span_tokens))
    last = rest.select("source", F.lit(0).cast("long").alias("begin"), F.col("n").alias("finish"), F.lit(span).cast("long").alias("first"),
                       F.lit(count).cast("long").alias("spans"))
    return last.union(spark.createDataFrame(rows, last.schema)) if rows else last


def cuts(chunk_rows: DataFrame, rules: PackRules) -> DataFrame:
    """part, chunk, source, and for each span that gets some of the row's ids
    (span, from, to, share, deficit): ids are numbered in the row, share and
    deficit are those of the source at the start of the span."""
    by = stage(chunk_rows.select("part", "chunk", "source", "tokens"), "packing-counts")
    per_source = stage(by.groupBy("source").agg(F.sum("tokens").alias("n")), "packing-sources")
    plan = stage(schedule(per_source, rules), "packing-schedule").withColumnRenamed("source", "_s")
    # where a row starts in its source's stream: over the input's partitions, then inside each
    outer = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("source", "part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    parts = by.groupBy("source", "part").agg(F.sum("tokens").alias("n")).select(
        F.col("source").alias("_ps"), F.col("part").alias("_pp"), F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("before"))
    rows = by.join(parts, F.expr("part = _pp and source <=> _ps")).select(
        "part", "chunk", "source", "tokens", (F.col("before") + F.coalesce(F.sum("tokens").over(inner), F.lit(0))).alias("at"))
    rows = rows.join(plan, F.expr("source <=> _s and at < finish and at + tokens > begin"))
    # a stream is handed out in quanta of min_piece ids, each source's steps at a place of its own
    quantum, off = f"{rules.min_piece}L", f"pmod(xxhash64(source), {rules.min_piece}L)"
    length = "(finish - begin)"
    limit = lambda j: (f"case when {j} <= 0 then 0L when {j} >= spans then {length} else "  # noqa: E731
                       f"least({length}, {quantum} * cast(floor(({length} * ({j} / spans) + {off}) / {quantum}) as bigint)) end")
    rows = rows.select(
        "part", "chunk", "source", "at", "begin", "finish", "first", "spans", F.expr(f"{length} / spans >= {quantum}").alias("_large"),
        F.expr("greatest(at, begin) - begin").alias("_lo"), F.expr("least(at + tokens, finish) - begin").alias("_hi"))
    # of a large source the spans are numbered, of a small one its quanta
    near = lambda x, d: f"cast(floor(({x} - {off} + {d}) * (spans / {length})) as bigint)"
    rows = rows.withColumn("_x", F.explode(F.expr(
        f"case when _large then sequence(greatest(0L, least(spans - 1, {near('_lo', '0L')} - 1)), least(spans - 1, {near('_hi', quantum)} + 1)) "
        f"else sequence(_lo div {quantum}, (_hi - 1) div {quantum}) end")))
    rows = rows.withColumn("_span", F.expr(
        f"case when _large then _x else least(spans, greatest(1L, cast(ceil(((_x + 1) * {quantum} - {off}) * (spans / {length})) as bigint))) - 1 end"))
    start = f"case when _large then {limit('_x')} else _x * {quantum} end"
    stop = f"case when _large then {limit('(_x + 1)')} else (_x + 1) * {quantum} end"
    rows = rows.select(
        "part", "chunk", "source", (F.col("first") + F.col("_span")).alias("span"),
        F.expr(f"greatest(_lo, {start}) + begin - at").alias("from"), F.expr(f"least(_hi, {stop}) + begin - at").alias("to"),
        F.expr(f"cast({length} / spans as double)").alias("share"),
        F.expr(f"cast({length} * (_span / spans) - ({start}) as double)").alias("deficit"), "at")
    return rows.where(F.col("from") < F.col("to"))


def numbered(cut: DataFrame, rules: PackRules) -> DataFrame:
    """span, first: the number of its first sequence."""
    n = F.col("n")
    sizes = cut.groupBy("span").agg(F.sum(F.col("to") - F.col("from")).alias("n")).select(
        "span", F.expr("span div 4096").alias("block"), (F.floor(n / rules.window) + F.bit_count(n % rules.window)).alias("seqs"))
    # prefix sums in two steps: over blocks of spans, then inside each
    outer = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("block").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.groupBy("block").agg(F.sum("seqs").alias("seqs")).select("block", F.coalesce(F.sum("seqs").over(outer), F.lit(0)).alias("before"))
    return sizes.join(blocks, "block").select("span", (F.col("before") + F.coalesce(F.sum("seqs").over(inner), F.lit(0))).alias("first"))


def fill(sources: list, counts: list[int], queues: list[tuple], window: int, min_piece: int) -> list[tuple[int, int, int, int, int]]:
    """Deficit round-robin over one chunk. ``sources`` and ``counts``: of its
    entries, in order; ``queues``: (source, share, deficit). Returns (entry,
    start in the entry, length, sequence, offset)."""
    line = {s: deque() for s, _, _ in queues}
    left = dict.fromkeys(line, 0)
    for k, (s, n) in enumerate(zip(sources, counts)):
        line[s].append([k, 0, n])
        left[s] += n
    share = {s: w for s, w, _ in queues}
    deficit = {s: d for s, _, d in queues}
    names, total, out, seq, turn = list(line), sum(left.values()), [], 0, 0

    def serve(s, take: int, at: int) -> int:
        left[s] -= take
        deficit[s] -= take
        while take:
            head = line[s][0]
            n = min(take, head[2])
            out.append((head[0], head[1], n, seq, at))
            at += n
            take -= n
            if n == head[2]:
                line[s].popleft()
            else:
                head[1] += n
                head[2] -= n
        return at

    while total:
        size = window if total >= window else 1 << total.bit_length() - 1
        active = [s for s in names if left[s]]
        weight = sum(share[s] for s in active)
        at = 0
        for s in active:
            deficit[s] += size * (share[s] / weight if weight else 1 / len(active))
        turn += 1
        first = turn % len(active)
        for s in active[first:] + active[:first]:
            take = min(int(max(deficit[s], 0)), left[s], size - at)
            if take >= min(min_piece, left[s]) and take:
                at = serve(s, take, at)
        while at < size:
            s = max((x for x in active if left[x]), key=deficit.__getitem__)
            at = serve(s, min(left[s], size - at, max(min_piece, int(max(deficit[s], 0)))), at)
        total -= size
        seq += 1
    return out


def _cut(out: StructType):
    """The pieces of a row's ids for its spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            id_arrow, rows = b.column("doc_id").type, []
            cols = [b.column(c).to_pylist() for c in ("source", "doc_id", "start", "n", "doc_tokens", "ids", "cuts")]
            for source, doc, start, n, tokens, ids, spans in zip(*cols):
                edge = np.concatenate([[0], np.cumsum(n)])
                for c in spans:
                    lo, hi = c["from"], c["to"]
                    a, z = int(np.searchsorted(edge, lo, "right")) - 1, int(np.searchsorted(edge, hi, "left"))
                    cut = np.clip(edge[a:z + 1], lo, hi)
                    rows.append((c["span"], source, c["at"] + lo, c["share"], c["deficit"], doc[a:z],
                                 (np.array(start[a:z]) + cut[:-1] - edge[a:z]).tolist(), np.diff(cut).tolist(), tokens[a:z], ids[2 * lo:2 * hi]))
            longs = pa.list_(pa.int64())
            types = [pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.float64(), id_arrow, longs, longs, longs, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=out.names)

    return run


def _fill(rules: PackRules, with_ids: bool, out: StructType):
    """Spans come one after another, each by source and place in its stream."""
    def filled(span: int, rows: list[tuple], id_arrow) -> pa.RecordBatch:
        sources, n, doc, start, tokens, queues = [], [], [], [], [], {}
        for source, share, deficit, d, s, m, t, _ in rows:
            queues.setdefault(source, (source, share, deficit))
            sources += [source] * len(m)
            n, doc, start, tokens = n + m, doc + d, start + s, tokens + t
        whole = sum(q[1] for q in queues.values())
        order = sorted(queues.values(), key=lambda q: (q[0] is None, q[0] or ""))
        pieces = fill(sources, n, [(s, w / whole if whole else 0.0, d) for s, w, d in order], rules.window, rules.min_piece)
        ids = np.frombuffer(b"".join(r[-1] for r in rows), "<u2").astype("<u4")
        at, raw = np.concatenate([[0], np.cumsum(n)]).tolist(), memoryview(ids.tobytes())
        cols = [[span] * len(pieces), [start[k] + s for k, s, *_ in pieces], [p[2] for p in pieces],
                [zlib.crc32(raw[4 * (at[k] + s):4 * (at[k] + s + m)]) for k, s, m, *_ in pieces],
                [tokens[p[0]] for p in pieces], [p[3] for p in pieces], [p[4] for p in pieces]]
        arrays = [pa.array([doc[p[0]] for p in pieces], id_arrow), *[pa.array(c, pa.int64()) for c in cols],
                  pa.array([sources[p[0]] for p in pieces], pa.string())]
        if with_ids:
            arrays.append(pa.array([ids[at[k] + s:at[k] + s + m].astype(np.int32) for k, s, m, *_ in pieces], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, names=out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, id_arrow = None, [], None
        for b in batches:
            id_arrow = b.column("doc_id").type.value_type
            cols = [b.column(c) for c in ("source", "share", "deficit", "doc_id", "start", "n", "doc_tokens", "ids")]
            for i, span in enumerate(b.column("span").to_pylist()):
                if span != now and rows:
                    yield filled(now, rows, id_arrow)
                    rows = []
                now = span
                rows.append(tuple(c[i].as_py() for c in cols))
        if rows:
            yield filled(now, rows, id_arrow)

    return run


def pack(docs: DataFrame, rules: PackRules = PackRules(), with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source and, if asked for, its ids."""
    rows = stage(chunks(docs, rules), "packing-chunks")
    cut = stage(cuts(rows, rules), "packing-cuts")
    first = stage(numbered(cut, rules), "packing-spans")
    each = cut.groupBy("part", "chunk", "source").agg(F.collect_list(F.struct("span", "from", "to", "share", "deficit", "at")).alias("cuts")).select(
        F.col("part").alias("_part"), F.col("chunk").alias("_chunk"), F.col("source").alias("_source"), "cuts")
    src = rows.join(each, F.expr("part = _part and chunk = _chunk and source <=> _source")).select(
        "source", "doc_id", "start", "n", "doc_tokens", "ids", "cuts")
    id_type = docs.schema["doc_id"].dataType
    piece = StructType([StructField("span", LongType()), StructField("source", StringType()), StructField("at", LongType()),
                        StructField("share", DoubleType()), StructField("deficit", DoubleType()), StructField("doc_id", ArrayType(id_type)),
                        *[StructField(c, ArrayType(LongType())) for c in ("start", "n", "doc_tokens")], StructField("ids", BinaryType())])
    spans = src.mapInArrow(released(_cut(piece), "packing"), piece).repartition("span").sortWithinPartitions("span", "source", "at")
    longs = ("span", "start", "length", "ids_crc32", "doc_tokens", "sequence", "offset")
    fields = [StructField("doc_id", id_type), *[StructField(c, LongType()) for c in longs], StructField("source", StringType())]
    if with_ids:
        fields.append(StructField("ids", ArrayType(IntegerType())))
    out = StructType(fields)
    placed = spans.mapInArrow(released(_fill(rules, with_ids, out), "packing"), out).join(first, "span")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("sequence")).alias("sequence_id"),
                         "offset", "source", *(["ids"] if with_ids else []))
