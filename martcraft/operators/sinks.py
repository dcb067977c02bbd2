"""Mart sinks (SK1-SK3, SK5).

Outputs go to a shared location: the folder the cluster names in
``spark.checkpoint.dir`` (see ``martcraft.session.shared_dir``), or any path
or catalog table the caller gives. Writes are whole-job Spark writes; a lost
executor only re-runs its tasks. Tables are refreshed by published versions
(see ``martcraft.operators.publish``); ``write_overwrite`` alone replaces a
plain folder in place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.operators.publish import Check, Version, base_path, has_data, point, publish, remove_old


def write_overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh (``DROP`` + ``CREATE TABLE AS``): replace the data at
    ``path`` with ``df``. Optional ``partition_by`` (e.g. a year column)
    lets later year-filtered checks prune files."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def create_table(spark: SparkSession, table: str, df: DataFrame, path: str) -> None:
    """Register a parquet table at ``path`` with ``df``'s columns, if the
    catalog does not know it. Files that are there already stay and become its
    rows (a catalog that ends with its session forgets the table, not the
    files); columns they lack read as NULL, columns unknown to ``df`` are an
    error. A known table that lacks one of the columns gets it."""
    if spark.catalog.tableExists(table):
        known = set(spark.table(table).columns)
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in known]
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")
        return
    if has_data(spark, path):
        unknown = set(spark.read.option("mergeSchema", "true").parquet(path).columns) - set(df.columns)
        if unknown:
            raise ValueError(f"{path} holds other columns: {sorted(unknown)}")
    else:
        spark.createDataFrame([], df.schema).write.mode("append").parquet(path)
    spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)


def replace_table(spark: SparkSession, table: str, df: DataFrame, path: str, run_id: str | None = None,
                  check: Check | None = None, info: Callable[[], Mapping] | None = None,
                  sort_by: Sequence[str] = ()) -> Version:
    """Full refresh of a catalog table (``DROP`` + ``CREATE TABLE AS``): its
    rows and columns become those of ``df``, published as a new version below
    ``path``. Until then, and if the write fails or ``check`` rejects the rows,
    the table reads what it read before."""
    version = publish(df, path, run_id, check, info, tuple(sort_by))
    point(spark, table, version.path, spark.read.parquet(version.path).schema)
    remove_old(spark, path)
    return version


def insert_overwrite(df: DataFrame, table: str, columns: Sequence[str], run_id: str | None = None,
                     check: Check | None = None, info: Callable[[], Mapping] | None = None,
                  sort_by: Sequence[str] = ()) -> Version:
    """Full refresh keeping the table (``DELETE`` all + ``INSERT ... SELECT``):
    columns are taken by position, in the given order, and get the table's
    names and types. The rows are published like those of ``replace_table``."""
    spark = df.sparkSession
    fields = spark.table(table).schema.fields
    if len(fields) != len(columns):
        raise ValueError(f"{table} has {len(fields)} columns, not {len(columns)}")
    rows = df.select(*[F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(columns, fields)])
    path = base_path(spark, table)
    version = publish(rows, path, run_id, check, info, tuple(sort_by))
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{version.path}'")
    spark.catalog.refreshTable(table)
    remove_old(spark, path)
    return version


def append(df: DataFrame, target: str, columns: Sequence[str], is_table: bool = False) -> None:
    """``INSERT INTO t (cols) SELECT ...``: append rows in the given column
    order to a path or a catalog table."""
    out = df.select(*columns)
    if is_table:
        out.write.insertInto(target, overwrite=False)
    else:
        out.write.mode("append").parquet(target)


def append_once(df: DataFrame, table: str, columns: Sequence[str], run_id: str) -> bool:
    """``append`` to a table with a ``run_id`` column, unless it holds rows of
    this run: a repeated run adds none. Whether rows were added."""
    spark = df.sparkSession
    if not spark.table(table).where(F.col("run_id") == run_id).isEmpty():
        return False
    append(df.withColumn("run_id", F.lit(run_id)), table, [*columns, "run_id"], is_table=True)
    spark.catalog.refreshTable(table)
    return True


def comment_on_table(spark: SparkSession, table: str, text: str) -> None:
    """``COMMENT ON TABLE t IS 'text'`` (catalog tables only)."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{escaped}'")
