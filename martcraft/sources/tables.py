"""Base-table scans."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
)


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Parquet scan of ``<base_dir>/<name>.parquet``. Lazy: Catalyst prunes
    columns and pushes filters into the scan of whatever is built on top."""
    return spark.read.parquet(os.path.join(base_dir, f"{name}.parquet"))
