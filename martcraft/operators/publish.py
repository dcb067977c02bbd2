"""Versioned full refreshes: write beside, check, then move the table.

A refresh writes its rows into a new folder ``<path>/v<number>-<id>``, may be
checked there, and becomes the published one by the creation of a small mark
file inside. Only then does the catalog table's location move to it, in one
catalog operation; the version before stays for readers that planned on it and
for ``roll_back``, older ones go. A write that fails or is rejected leaves the
table, its files and its mark as they were.

The mark holds the run's id, so a repeated run finds what it has published
already, and facts about the version for the caller. A session whose catalog
does not know the table finds the newest published version at ``path``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

MARK = "_PUBLISHED"  # hidden from Spark's readers, as all names with an underscore are
Check = Callable[[DataFrame], None]


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    run_id: str | None = None
    info: Mapping = field(default_factory=dict)


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` directly holds files that Spark would read."""
    p, fs = _fs(spark, path)
    return fs.exists(p) and any(not s.getPath().getName().startswith(("_", ".")) and s.isFile() for s in fs.listStatus(p))


def _folders(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    return sorted((int(n[1:9]), f"{path}/{n}") for n in names if n[:1] == "v" and n[1:9].isdigit() and n[9:10] == "-")


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The published versions at ``path``, oldest first."""
    out = []
    for number, folder in _folders(spark, path):
        p, fs = _fs(spark, f"{folder}/{MARK}")
        if fs.exists(p):
            stream = fs.open(p)
            try:
                mark = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
            out.append(Version(number, folder, mark["run_id"], mark["info"]))
    return out


def published(spark: SparkSession, path: str, run_id: str | None = None) -> Version | None:
    """The newest published version (of ``run_id``, if given)."""
    found = [v for v in versions(spark, path) if run_id is None or v.run_id == run_id]
    return found[-1] if found else None


def read_published(spark: SparkSession, path: str) -> DataFrame:
    version = published(spark, path)
    if version is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(version.path)


def publish(df: DataFrame, path: str, run_id: str | None = None, check: Check | None = None,
            info: Callable[[], Mapping] | None = None, sort_by: tuple[str, ...] = ()) -> Version:
    """Write ``df`` as the next version at ``path``. ``check`` reads the written
    rows and raises to reject them; ``info`` is asked after the write.
    ``sort_by`` sorts the rows inside each task's files (no shuffle), so that a
    range of those columns is found by the statistics of row groups and pages
    and the rest is skipped."""
    spark = df.sparkSession
    if run_id is not None and (done := published(spark, path, run_id)):
        return done
    number = 1 + max([n for n, _ in _folders(spark, path)], default=0)
    folder = f"{path}/v{number:08d}-{uuid.uuid4().hex[:12]}"
    try:
        (df.sortWithinPartitions(*sort_by) if sort_by else df).write.parquet(folder)
        if check is not None:
            check(spark.read.schema(df.schema).parquet(folder))
        facts = dict(info()) if info else {}
    except BaseException:
        p, fs = _fs(spark, folder)
        fs.delete(p, True)
        raise
    p, fs = _fs(spark, f"{folder}/{MARK}")
    stream = fs.create(p, False)
    stream.writeBytes(json.dumps({"run_id": run_id, "info": facts}))
    stream.close()
    return Version(number, folder, run_id, facts)


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the ``keep`` newest published versions, and unpublished
    folders that are older than those."""
    live = versions(spark, path)[-keep:]
    for number, folder in _folders(spark, path):
        if live and number < live[-1].number and folder not in {v.path for v in live}:
            p, fs = _fs(spark, folder)
            fs.delete(p, True)


def point(spark: SparkSession, table: str, folder: str, schema: StructType) -> None:
    """Let the (external) catalog table read ``folder``. With its columns
    unchanged that is one change of its location; else its entry is made anew."""
    shape = [(f.name, f.dataType) for f in schema.fields]
    if spark.catalog.tableExists(table):
        if [(f.name, f.dataType) for f in spark.table(table).schema.fields] == shape:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=folder, source="parquet", schema=schema)


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()  # one row a column and property
    return next(r[1] for r in reversed(rows) if r[0] == "Location")


def base_path(spark: SparkSession, table: str) -> str:
    """The path below which a table's versions lie."""
    folder, _, name = location(spark, table).rstrip("/").rpartition("/")
    return folder if name[:1] == "v" and name[1:9].isdigit() and name[9:10] == "-" else f"{folder}/{name}"


def adopt(spark: SparkSession, table: str, path: str) -> bool:
    """Register the newest published version at ``path`` where the catalog does
    not know the table; False if there is none."""
    version = published(spark, path)
    if version is None or spark.catalog.tableExists(table):
        return version is not None
    spark.catalog.createTable(table, path=version.path, source="parquet", schema=spark.read.parquet(version.path).schema)
    return True


def roll_back(spark: SparkSession, table: str, path: str) -> Version:
    """Withdraw the newest version: the table reads the one before."""
    found = versions(spark, path)
    if len(found) < 2:
        raise ValueError(f"no version before the published one at {path}")
    point(spark, table, found[-2].path, spark.read.parquet(found[-2].path).schema)
    p, fs = _fs(spark, found[-1].path)
    fs.delete(p, True)
    return found[-2]
