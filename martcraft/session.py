"""Session helpers: a local session for tests and benchmarks, and the shared
output folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: By Spark context: scratch folder of a local session; (base, stage folder).
_SCRATCH: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_SESSION: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()
_RUN: ContextVar[str | None] = ContextVar("martcraft_stage_run", default=None)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "martcraft") -> SparkSession:
    """A local session configured like the cluster one: AQE on (coalescing,
    skew-join, runtime broadcast under the size threshold), UTC, no UI."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.locality.wait", "0s")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", "8g"))
    if os.environ.get("MARTCRAFT_EVENTLOG"):
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", os.environ["MARTCRAFT_EVENTLOG"]))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(master: str) -> bool:
    """One JVM: driver and executors share the machine's folders."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir`` (read from the session; a
    cluster sets it) or the context's checkpoint directory. Where neither is
    set a scratch folder serves a single-JVM local session only; on any other
    master the executors could not see it, so that is an error. Nothing of the
    session is changed."""
    sc = spark.sparkContext
    d = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if d:
        return d
    if not _is_local(sc.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    if sc not in _SCRATCH:
        _SCRATCH[sc] = tempfile.mkdtemp(prefix="martcraft-ckpt-")
    return _SCRATCH[sc]


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "martcraft", *parts)


def _hadoop_path(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


def _session_folder(spark: SparkSession) -> str:
    """The stage folder of this context, deleted when its JVM ends."""
    sc = spark.sparkContext
    base = ensure_checkpoint_dir(spark)
    if _SESSION.get(sc, ("", ""))[0] != base:
        path = shared_dir(spark, "stage", f"session-{uuid.uuid4().hex}")
        p, fs = _hadoop_path(spark, path)
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _SESSION[sc] = (base, path)
    return _SESSION[sc][1]


@contextmanager
def stage_run(spark: SparkSession, folder: str | None = None, keep: bool = False) -> Iterator[str]:
    """Stage tables written inside go to one run folder (``folder``, or a new
    one in the shared folder), which is removed at the end. Frames built
    inside read those tables: write them before leaving, or ``keep`` the
    folder and remove it (``remove_folder``) once they are written."""
    path = folder or shared_dir(spark, "stage", f"run-{uuid.uuid4().hex}")
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        if not keep:
            remove_folder(spark, path)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path for a stage table: in the current run's folder, else in the
    session's."""
    return os.path.join(_RUN.get() or _session_folder(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df, name: str = "stage"):
    """Cut lineage at a stage boundary by writing a Parquet table into the
    shared folder and reading it back; this runs a Spark job at once.

    Used where one reduced intermediate feeds several branches of a plan (so
    the large input behind it is read once) and where recomputation after an
    executor loss would otherwise reach back to the raw facts. Parquet keeps
    the boundary columnar and compressed, lets later reads prune columns,
    and gives the optimizer real size statistics. The schema is passed back
    explicitly, so an empty result reads back fine."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
