"""SimHash near-duplicate detection with multi-index hashing.

A document's words (split at ASCII white space, A-Z lowered) form shingles; a
fingerprint bit is set where over half of the shingles' XXH64 values have it.
Fingerprints link at ``max_distance`` or fewer differing bits. The 64 bits are
cut into ``segments``; by the pigeonhole principle linked fingerprints lie
within a small Hamming ball of each other in at least one segment, so each
fingerprint enumerates those balls, fetches the table entries with that
segment value and verifies the complete distance. Only distinct fingerprints
are linked, so exact copies cost nothing there.

A table bucket with more than ``hot_bucket`` entries (a large group of near
copies) is cut into blocks; each pair of blocks is verified in one task and
returns one link per member to a representative, never all pairs, so the
connected components are the same.

Defined cases: null text counts as no words; a document without words has the
fingerprint 0, linked like any other; a null doc_id gets a fingerprint and
component but is never a component's id unless all its members are null;
repeated rows come back each; an empty table gives an empty result; other
columns are carried untouched by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martcraft.llm.common import ROW, carry, released, ship, stage
from martcraft.llm.components import components

BLOCK = 2048


def fingerprint(text: bytes | None, words: int) -> int:
    """The unsigned 64-bit fingerprint of one UTF-8 text."""
    from xxhash import xxh64_intdigest

    parts = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = len(parts) - words + 1
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[words - 1:].tolist())),
                         np.uint64, count)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    most = 2 * bits.sum(axis=0, dtype=np.int64) > count
    return int(np.packbits(most, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, keep_row: bool = False) -> DataFrame:
    """doc_id (or the carried row), fp long (the fingerprint's bits)."""
    ship(docs.sparkSession)
    first = [carry(docs)] if keep_row else []
    src = docs.select(*first, "doc_id", F.col("text").cast("binary").alias("_text"))
    kept = [f for f in src.schema.fields if f.name != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, words) for t in b.column("_text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(f.name) for f in kept] + [pa.array(fps.view(np.int64))], names=[f.name for f in kept] + ["fp"])

    return src.mapInArrow(released(run), StructType([*kept, StructField("fp", LongType())]))


def _plan(max_distance: int, segments: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of the segments to probe. If every one of the
    first ``extra`` segments differs in over ``least`` bits and every other
    in over ``least - 1``, the whole differs in over ``max_distance`` bits."""
    least = max_distance // segments
    extra = max_distance - segments * least + 1
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(cuts[i], cuts[i + 1] - cuts[i], least if i < extra else least - 1)
            for i in range(segments) if i < extra or least > 0]


def _key(plan: list[tuple[int, int, int]], i: int, flip: int = 0) -> Column:
    shift, width, _ = plan[i]
    value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)).bitwiseXOR(F.lit(flip))
    return value * F.lit(len(plan)) + F.lit(i)


def _flips(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _verify_block(max_distance: int):
    import pandas as pd

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        probe = rows["probe"].to_numpy()
        fp = rows["fp"].to_numpy().view(np.uint64)
        left, right = fp[~probe], fp[probe]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        near = np.bitwise_count(left[:, None] ^ right[None, :]) <= max_distance
        none = len(left)
        label = np.arange(none)
        while True:  # least label over the links, both ways, until it stays
            other = np.where(near, label[:, None], none).min(axis=0)
            new = np.minimum(label, np.where(near, other[None, :], none).min(axis=1))
            if (new == label).all():
                break
            label = new
        met = near.any(axis=1)
        a = np.concatenate([left[label[met]], left[other[other < none]]])
        b = np.concatenate([left[met], right[other < none]])
        keep = a != b
        return pd.DataFrame({"a": a[keep].view(np.int64), "b": b[keep].view(np.int64)}).drop_duplicates()

    return run


def links(fps: DataFrame, max_distance: int = 4, segments: int = 3, hot_bucket: int = 64) -> DataFrame:
    """Edges (a, b) over distinct fingerprints ``fps`` (column fp) whose
    connected components are those of all pairs within ``max_distance`` bits.
    ``segments`` should be about 64 / log2(number of fingerprints)."""
    plan = _plan(max_distance, segments)
    index = fps.select("fp", F.explode(F.array(*[_key(plan, i) for i in range(len(plan))])).alias("key"))
    balls = [_key(plan, i, flip) for i, (_, width, radius) in enumerate(plan) for flip in _flips(width, radius)]
    probes = fps.select("fp", F.explode(F.array(*balls)).alias("key"))
    # few rows: a bucket here has over hot_bucket entries
    hot = stage(index.groupBy("key").count().where(F.col("count") > hot_bucket), "simhash-hot")
    cold = index.join(hot.select("key"), "key", "left_anti").withColumnRenamed("fp", "b")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= max_distance
    pairs = probes.join(cold, "key").where(near & (F.col("fp") != F.col("b"))).select(
        F.least("fp", "b").alias("a"), F.greatest("fp", "b").alias("b")).distinct()

    hot_probes = probes.join(hot.select("key"), "key", "left_semi")
    sizes = hot_probes.groupBy("key").agg(F.count("*").alias("probes")).join(hot, "key").select(
        "key", F.ceil(F.col("count") / BLOCK).cast("int").alias("_ni"), F.ceil(F.col("probes") / BLOCK).cast("int").alias("_np"))
    sizes = stage(sizes, "simhash-hot-sizes")
    block = lambda n: F.pmod(F.xxhash64("fp"), n).cast("int")
    table = index.join(sizes, "key").select(
        "key", block(F.col("_ni")).alias("i"), F.explode(F.expr("sequence(0, _np - 1)")).alias("p"), "fp", F.lit(False).alias("probe"))
    asked = hot_probes.join(sizes, "key").select(
        "key", F.explode(F.expr("sequence(0, _ni - 1)")).alias("i"), block(F.col("_np")).alias("p"), "fp", F.lit(True).alias("probe"))
    hooks = table.union(asked).groupBy("key", "i", "p").applyInPandas(_verify_block(max_distance), "a long, b long")
    return pairs.union(hooks)


def _rooted(docs: DataFrame, words: int, max_distance: int, segments: int = 3, hot_bucket: int = 64) -> DataFrame:
    """doc_id, fp, component_id (the least doc_id reachable) and root (the
    component's least fingerprint) of every row."""
    ship(docs.sparkSession)
    fps = stage(fingerprints(docs, words), "simhash-fps")
    reps = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    nodes = components(links(reps.select("fp"), max_distance, segments, hot_bucket))
    rooted = reps.join(nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = stage(rooted.groupBy("root").agg(F.min("rep").alias("component_id")), "simhash-least")
    ids = stage(rooted.join(least, "root").select("fp", "component_id", "root"), "simhash-components")
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id", "root")


def near_duplicates(docs: DataFrame, words: int = 4, max_distance: int = 4, segments: int = 3,
                    hot_bucket: int = 64) -> DataFrame:
    """doc_id, fp and component_id (the least doc_id reachable) of every row."""
    return _rooted(docs, words, max_distance, segments, hot_bucket).drop("root")


def hex_digits(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def deduplicate(docs: DataFrame, words: int = 4, max_distance: int = 4) -> DataFrame:
    """One row of each component: the one with the least doc_id; of repeated
    rows with that id one stays. Components are told apart by their
    fingerprints, so groups that share their least id keep a row each. Rows
    whose doc_id is null all stay. Columns as in ``docs``, of any type.

    Texts move in one join at most, against the ids to drop; no stage table
    holds them. Ids that several rows share are decided row by row."""
    one_id, one_fp = "__llm_id", "__llm_fp"
    found = stage(_rooted(docs, words, max_distance).where("doc_id is not null"), "simhash-found")
    shared = stage(found.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(one_id)), "simhash-shared")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias(one_id)).union(shared).distinct()
    once = docs.join(stage(gone, "simhash-gone"), F.col("doc_id") == F.col(one_id), "left_anti")
    if shared.isEmpty():
        return once
    rows = fingerprints(docs.join(shared, F.col("doc_id") == F.col(one_id), "left_semi"), words, keep_row=True)
    decided = found.join(shared, F.col("doc_id") == F.col(one_id), "left_semi").where("doc_id = component_id").select(
        F.col("doc_id").alias(one_id), F.col("fp").alias(one_fp), "root").distinct()
    # maps have no order: they do not choose among rows that share id and group
    order = [F.col(f"{ROW}.`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    one = (rows.join(decided, (F.col(f"{ROW}.doc_id") == F.col(one_id)) & (F.col("fp") == F.col(one_fp)))
           .groupBy(F.col(one_id), F.col("root")).agg(F.min_by(ROW, F.struct(*order)).alias(ROW)))
    return once.union(one.select(f"{ROW}.*"))
