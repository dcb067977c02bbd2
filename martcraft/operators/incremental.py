"""Refreshes that rebuild only what changed, by month.

Changes are found by fingerprints, one row a month: a month whose fingerprint
differs from the last run's has changed. ``row_fingerprints`` reads the rows
(count and an order-free sum of two row hashes, so a change goes unseen only if
both 64-bit sums collide); ``listing_fingerprints`` reads no rows, only the
names, sizes and times of the files of a table that is partitioned by month.

``refresh_rollup`` keeps a roll-up partitioned by month and replaces the
partitions of changed months. ``refresh_dense`` keeps a dense series with its
carried running total: the stored month before the first changed one *is* the
carried state (every unit that has begun has a row there), so the tail is built
from it and from the rows since, and nothing older is read but the list of
units.

Each keeps its state beside its rows. Before rows are replaced, the state is
published without the months that are about to change, and whole again
afterwards: a refresh that fails half-way is taken up from there by the next.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from martcraft.functions.dates import month_start
from martcraft.functions.nullsafe import nullsafe_on
from martcraft.operators.calendar import densify_cumulative, in_calendar
from martcraft.operators.publish import publish, published, remove_old
from martcraft.session import materialize, remove_folder

PRINTS = "month date, print string"


def row_fingerprints(df: DataFrame, month: Column) -> DataFrame:
    """month, print: of the rows of each month, whatever their order."""
    return summed_prints(df.groupBy(month.alias("month")).agg(*print_sums(df.columns)))


PRINT_SUMS = ("_rows", "_hash", "_hash2")


def print_sums(columns: Sequence[str]) -> list[Column]:
    """The aggregates of rows with these columns that make up their print. They
    add up, so an aggregate by month and more can carry them along and spare
    the print a pass of its own (``summed_prints``)."""
    # hashes skip NULLs: say where they are
    seen = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    sums = [F.sum(h.cast("decimal(38,0)")) for h in (F.xxhash64(*seen), F.xxhash64(F.lit(1), *reversed(seen)))]
    return [c.alias(name) for c, name in zip([F.count("*"), *sums], PRINT_SUMS)]


def summed_prints(sums: DataFrame) -> DataFrame:
    """month, print: from rows with a month and its ``print_sums``."""
    return sums.groupBy("month").agg(F.concat_ws(":", *[F.sum(c).cast("string") for c in PRINT_SUMS]).alias("print"))


def listing_fingerprints(spark: SparkSession, path: str, column: str) -> DataFrame:
    """month, print: of the files below the ``column=...`` folders of ``path``.
    The files' contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    day = F.regexp_extract("path", f"/{column}=([^/]+)/", 1)
    name = F.element_at(F.split("path", "/"), -1)
    mark = F.xxhash64(name, "length", "modificationTime").cast("decimal(38,0)")
    return files.where(day != "").groupBy(day.try_cast("date").alias("month")).agg(
        F.concat_ws(":", F.count("*").cast("string"), F.sum("length").cast("string"), F.sum(mark).cast("string")).alias("print"))


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: the months that had changed (None stands for rows
    without a month) and whether everything was built anew."""

    changed: list[dt.date | None]
    whole: bool = False
    first_month: dt.date | None = None


def _changed(old: DataFrame, new: DataFrame) -> list[dt.date | None]:
    """Months whose prints differ; one row a month of the calendar."""
    o, n = old.select(F.col("month").alias("_om"), F.col("print").alias("_op")), new.select("month", "print")
    both = n.join(o, F.col("month").eqNullSafe(F.col("_om")), "full")
    found = both.where(~F.col("print").eqNullSafe(F.col("_op"))).select(F.coalesce("month", "_om")).collect()
    return sorted((r[0] for r in found), key=lambda m: m or dt.date.min)


def _state(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    version = published(spark, f"{path}/state")
    if version is None:
        return spark.createDataFrame([], PRINTS), {}
    return spark.read.schema(PRINTS).parquet(version.path), dict(version.info)


def _keep_state(prints: DataFrame, path: str, info: dict) -> None:
    publish(prints.select("month", "print").coalesce(1), f"{path}/state", info=lambda: info)
    remove_old(prints.sparkSession, f"{path}/state")


def _folder(path: str, month: dt.date | None) -> str:
    return f"{path}/rows/month={month.isoformat() if month else '__HIVE_DEFAULT_PARTITION__'}"


def _write_months(df: DataFrame, path: str, files: int) -> None:
    """Replace the months of ``df`` in the rows below ``path``, each in up to
    ``files`` files."""
    spread = F.pmod(F.xxhash64(*[c for c in df.columns if c != "month"]), F.lit(files))
    (df.repartition("month", spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month").parquet(f"{path}/rows"))


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows below ``path``; ``month`` is the partition column, a DATE."""
    fields = [f for f in schema.fields if f.name != "month"] + [StructField("month", DateType())]
    return spark.read.schema(StructType(fields)).parquet(f"{path}/rows").select(*schema.names)


def _ensure(spark: SparkSession, path: str, schema: StructType) -> None:
    """The rows' folder exists (empty at first)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/rows")
    p.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(p)


# --- roll-ups ------------------------------------------------------------------

def refresh_rollup(path: str, prints: DataFrame, build: Callable[[list[dt.date | None]], DataFrame],
                   files: int = 8) -> tuple[DataFrame, Refresh]:
    """Bring the roll-up below ``path`` up to date and read it. ``prints`` are
    the source's fingerprints now; ``build(months)`` gives the roll-up's rows
    (with a DATE column ``month``) of these months and reads only their
    source."""
    spark = prints.sparkSession
    prints = materialize(prints, "prints")
    old, _ = _state(spark, path)
    changed = _changed(old, prints)
    rows = build(changed)
    _ensure(spark, path, rows.schema)
    if changed:
        known = [m for m in changed if m is not None]
        kept = prints.where(~F.col("month").isin(known) if known else F.lit(True)) if None in changed else \
            prints.where(F.col("month").isNull() | ~F.col("month").isin(known))
        if None in changed:
            kept = kept.where("month IS NOT NULL")
        _keep_state(kept, path, {})
        _write_months(rows, path, files)
        have = {r[0] for r in prints.select("month").collect()}  # one row a month
        for month in changed:
            if month not in have:
                remove_folder(spark, _folder(path, month))
        _keep_state(prints, path, {})
    return _stored(spark, path, rows.schema), Refresh(changed)


# --- dense series ----------------------------------------------------------------

def _add_months(d: dt.date, n: int) -> dt.date:
    m = d.year * 12 + d.month - 1 + n
    return dt.date(m // 12, m % 12 + 1, 1)


def refresh_dense(df: DataFrame, path: str, unit_cols: Sequence[str], partition_cols: Sequence[str], measure: str,
                  start: dt.date, as_of: dt.date, out: str = "cumulative_qty", month_col: str = "month",
                  files: int = 8) -> tuple[DataFrame, Refresh]:
    """``densify_cumulative`` of ``df`` kept below ``path``: bring it up to date
    and read it. Built anew are the months from the first that can differ: the
    first changed month, the first new calendar month, or, where units share a
    running total, the beginning of a total that gained or lost a unit. Sums
    start from the carried total, so measures should add exactly (whole numbers
    or decimals)."""
    spark, units, parts = df.sparkSession, list(unit_cols), list(partition_cols)
    df = df.select(*units, F.col(month_col).alias("month"), measure)
    rows = materialize(df, "dense_source")
    inside = in_calendar("month", start, as_of)
    own = rows.where(inside).withColumn("month", F.col("month").cast("date"))
    prints = materialize(row_fingerprints(own, F.col("month")), "prints")
    old, info = _state(spark, path)
    first_day, last = dt.date(start.year, start.month, 1), dt.date(as_of.year, as_of.month, 1)
    shape = {"units": units, "parts": parts, "measure": measure, "out": out, "start": first_day.isoformat(),
             "types": [t for _, t in df.dtypes]}
    known = rows.groupBy(*units).agg(F.min(F.when(inside, month_start("month"))).alias("_begin"))
    known = materialize(known, "units")

    def dense(source: DataFrame, since: dt.date) -> DataFrame:
        return densify_cumulative(source, units, parts, measure, since, as_of, out=out)

    changed = _changed(old, prints)
    done = dt.date.fromisoformat(info["complete_to"]) if info.get("complete_to") else None
    whole = done is None or done > last or any(info.get(k) != v for k, v in shape.items())
    first = first_day
    if not whole:
        starts = list(changed) + ([_add_months(done, 1)] if done < last else [])
        if parts != units:
            before = spark.read.schema(known.schema).parquet(published(spark, f"{path}/units").path)
            moved = known.select(*units).unionByName(before.select(*units)).groupBy(*units).count().where("count = 1")
            moved = moved.select(*[F.col(c).alias(f"_m{i}") for i, c in enumerate(parts)]).distinct()
            begun = own.where(F.col(measure).isNotNull()).join(moved, nullsafe_on(own, moved, parts, [f"_m{i}" for i in range(len(parts))]), "left_semi")
            starts += [m for m in [begun.agg(F.min("month")).first()[0]] if m is not None]
        if not starts:
            return _stored(spark, path, dense(rows.limit(0), first_day).schema), Refresh([])
        first = max(first_day, min(starts))
        whole = first == first_day

    if whole:
        tail = dense(rows, first_day)
    else:
        # the month before: each unit that has begun, one of each total carries it
        kind = dense(rows.limit(0), first_day).schema
        slice_ = _stored(spark, path, kind).where(F.col("month") == F.lit(_add_months(first, -1))).select(*units, out).distinct()
        one = F.row_number().over(Window.partitionBy(*parts).orderBy(*units)) == 1
        carried = slice_.select(*units, F.lit(_add_months(first, -1)).alias("month"), F.when(one, F.col(out)).alias(measure))
        since = own.where(F.col("month") >= F.lit(first)).withColumn(measure, F.col(measure).cast(kind[out].dataType))
        opened = carried.unionByName(since)
        if parts != units:
            # units that wait for their total to begin, or have no month at all
            waiting = known.where(F.col("_begin").isNull() | (F.col("_begin") < F.lit(first))).select(*units)
            opened = opened.unionByName(waiting.select(
                *units, F.lit(_add_months(first, -1)).alias("month"), F.lit(None).cast(kind[out].dataType).alias(measure)))
        tail = dense(opened, _add_months(first, -1)).where(F.col("month") >= F.lit(first))
        tail = tail.select(*[F.col(f.name).cast(f.dataType) for f in kind.fields])

    _ensure(spark, path, tail.schema)
    if whole:
        _keep_state(prints.limit(0), path, {})
        remove_folder(spark, f"{path}/rows")
        _ensure(spark, path, tail.schema)
    else:
        _keep_state(prints.where(F.col("month") < F.lit(first)), path, {**shape, "complete_to": _add_months(first, -1).isoformat()})
    tail = materialize(tail, "dense_tail")
    _write_months(tail, path, files)
    have = {r[0] for r in tail.select("month").distinct().collect()}  # one row a month
    month = first
    while not whole and month <= last:
        if month not in have:
            remove_folder(spark, _folder(path, month))
        month = _add_months(month, 1)
    publish(known, f"{path}/units")
    remove_old(spark, f"{path}/units")
    _keep_state(prints, path, {**shape, "complete_to": last.isoformat()})
    return _stored(spark, path, tail.schema), Refresh(changed, whole, first)
