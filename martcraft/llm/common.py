"""Helpers shared by the operators: stage tables, held-out split, row
carrying, shipping the package to the executors."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
import uuid
import weakref

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martcraft.session import stage_path

#: ASCII white space, U+0020 and U+0009 to U+000D: what separates words.
SPACE = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: Name of the struct that carries an input row past computed columns.
ROW = "__llm_row"

_SHIPPED: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of any cluster (once
    per context), as ``spark-submit --py-files`` would."""
    sc = spark.sparkContext
    if sc not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="martcraft-py-"), f"martcraft-{uuid.uuid4().hex}")
        sc.addPyFile(shutil.make_archive(base, "zip", root, "martcraft"))
        _SHIPPED[sc] = True


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder of
    ``spark.checkpoint.dir`` and read it back: a lineage cut that survives
    lost executors and whose size the optimizer knows."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables that a Python worker keeps from task to task, by name.
WORKER_TABLES: dict[str, dict] = {}


def released(run, keep: str | None = None):
    """``run`` (of mapInArrow) in a form that gives a worker's memory back when
    its partition ends: tables kept by other operators, and what the allocators
    hold. Workers live on, and what they hold counts against the executor in
    every later stage. ``keep``: the table that ``run`` itself uses again."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            free_memory(keep)

    return whole


def small_batches(spark: SparkSession, most: int = 2_000_000) -> None:
    """Arrow batches of about ``most`` bytes, if the session has larger ones.
    A batch of texts is held several times, by the JVM's buffers and by the
    worker, in every running task; the default bounds its rows only."""
    if int(spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()) > most:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", most)


def byte_slices(batches, column: str, most: int = 1_000_000):
    """The batches cut (without a copy) into runs of rows whose texts in
    ``column`` hold about ``most`` bytes, or one row: what a worker makes of a
    batch is bounded by bytes, not by the rows Arrow sends at once."""
    for b in batches:
        n = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(n, dtype=np.int64), 0
        while at < len(n):
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield b.slice(at, stop - at)
            at = stop


def free_memory(keep: str | None = None) -> None:
    for name, table in WORKER_TABLES.items():
        if name != keep:
            table.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def bounded_sample(rows: DataFrame, key: str, most: int, by: tuple[str, ...] = ()) -> DataFrame:
    """At most ``most`` rows of each ``by`` group (of all, without one), those
    with the least hash of ``key``. A first cut by the hash against the group's
    size leaves about twice as many, however many tasks read the table; the
    rest is ranked."""
    chance = F.shiftrightunsigned(F.xxhash64(key), 11).cast("double") / float(1 << 53)
    if not by:
        return rows.where(chance * float(rows.count()) < 2.0 * most).orderBy(F.xxhash64(key), key).limit(most)
    sizes = stage(rows.groupBy(*by).agg(F.count("*").alias("_n")), "sample-sizes")
    sizes = sizes.select("_n", *[F.col(c).alias(f"_by_{c}") for c in by])
    near = rows.join(sizes, F.expr(" and ".join(f"{c} <=> _by_{c}" for c in by)))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64(key), key))
    kept = near.where(chance * F.col("_n") < 2.0 * most).withColumn("_r", rank).where(F.col("_r") <= most)
    return kept.select(*rows.columns)


def leading_bits(x: str, bits: int) -> str:
    """SQL: a nonnegative integer with all but its leading ``bits`` bits
    cleared: the lower edge of its bin in a histogram whose bins have a
    relative width under 2 / 2**bits. Such histograms merge by addition."""
    drop = f"greatest(0, length(bin({x})) - {bits})"
    return f"shiftleft(shiftright({x}, {drop}), {drop})"


def held_out(doc_id: str = "doc_id") -> Column:
    """True for rows whose crc32(doc_id as text) mod 3 is 1 (null id: text '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def carry(docs: DataFrame) -> Column:
    """The whole input row as one struct, so that columns computed beside it
    cannot clash with the names of its own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW)
