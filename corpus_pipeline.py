"""The corpus pipeline: documents to packed training sequences.

``STAGES`` are (name, function) with function(spark, docs, sf_dir) ->
DataFrame; each result is written as Parquet and read again as the next one's
``docs``. All but the last keep the columns of ``documents``:

1. quality rules: rejected documents go;
2. SimHash near-dedup: of each group the document with the least id stays;
3. secret scans: every span found is replaced by a mark;
4. mixing: documents appear as often as their rate says (0, 1, 2, ...);
5. packing: the ids of what is left, in sequences.

A stage's own stage tables go as soon as the next stage is called, its result
having been written by then; the last stage's go with the session.

Null, empty and repeated rows are treated as each operator's module says.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from martcraft.llm import mixing, packing, quality, secrets, simhash
from martcraft.llm.common import read, small_batches
from martcraft.session import remove_folder, stage_path, stage_run

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: By Spark context: the folder of the stage called last.
_FOLDERS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def _own_folder(function: Stage) -> Stage:
    """The stage with a folder for its stage tables; the folder of the stage
    before is removed unless ``docs`` still reads it."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = _FOLDERS.pop(spark.sparkContext, None)
        if before and not any(before.rsplit("/", 1)[-1] in f for f in docs.inputFiles()):
            remove_folder(spark, before)
        small_batches(spark)
        with stage_run(spark, stage_path(spark, function.__name__), keep=True) as folder:
            if function is not packing_stage.__wrapped__:
                _FOLDERS[spark.sparkContext] = folder
            return function(spark, docs, sf_dir)

    return run_stage


@_own_folder
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_quality(docs)


@_own_folder
def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, words=4, max_distance=4)


@_own_folder
def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


@_own_folder
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.resample(docs, read(spark, sf_dir, "labels"))


@_own_folder
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("secret scans", secrets_stage),
    ("mixing to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: Fingerprints, character models, a classifier and a tokenizer: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, function in STAGES[:-1]:
        path = stage_path(spark, "pipeline-" + name.replace(" ", "-"))
        function(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.schema(docs.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
