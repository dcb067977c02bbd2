"""The mart inputs and their binding to production tables.

``Inputs`` holds them as DataFrames. ``inputs_from_tables`` and
``inputs_from_paths`` read them by name and check each against its declared
columns at the boundary; ``guide_id`` must be unique, as the matches count on
it (one aggregate over the guide).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType,
                               TimestampNTZType, TimestampType)


@dataclass(frozen=True)
class Inputs:
    retail: DataFrame        # period, division, internal_code, assembly_variant,
                             # sales_direction, vin, dealer_id, retail_qty,
                             # opening_stock, closing_stock
    guide: DataFrame         # guide_id, name, code65, factory_model,
                             # manufacturer, division
    kit_sales: DataFrame     # month, division, counterparty, drawing_no,
                             # assembly_variant, sales_direction, sold_qty
    realization: DataFrame   # period, product_id, direction_id, qty
    product: DataFrame       # id, product_name, code65, assembly_variant, division_id
    direction: DataFrame     # id, sales_direction
    division: DataFrame      # id, name
    dealer: DataFrame        # id, division
    retail_peer: DataFrame | None = None  # month, retail_qty: another system's mart


WHOLE = (ByteType, ShortType, IntegerType, LongType)
KINDS: dict[str, tuple[type[DataType], ...]] = {
    "text": (StringType,),
    "key": WHOLE,
    "amount": (*WHOLE, DecimalType),
    "time": (DateType, TimestampType, TimestampNTZType),
}

#: Column -> kind of every input.
SCHEMAS: dict[str, dict[str, str]] = {
    "retail": {"period": "time", "division": "text", "internal_code": "text", "assembly_variant": "text", "sales_direction": "text",
               "vin": "text", "dealer_id": "key", "retail_qty": "amount", "opening_stock": "amount", "closing_stock": "amount"},
    "guide": {"guide_id": "key", "name": "text", "code65": "text", "factory_model": "text", "manufacturer": "text", "division": "text"},
    "kit_sales": {"month": "time", "division": "text", "counterparty": "text", "drawing_no": "text", "assembly_variant": "text",
                  "sales_direction": "text", "sold_qty": "amount"},
    "realization": {"period": "time", "product_id": "key", "direction_id": "key", "qty": "amount"},
    "product": {"id": "key", "product_name": "text", "code65": "text", "assembly_variant": "text", "division_id": "key"},
    "direction": {"id": "key", "sales_direction": "text"},
    "division": {"id": "key", "name": "text"},
    "dealer": {"id": "key", "division": "text"},
    "retail_peer": {"month": "time", "retail_qty": "amount"},
}
OPTIONAL = {f.name for f in fields(Inputs) if f.default is None}


def checked(name: str, df: DataFrame) -> DataFrame:
    """``df`` cut to the declared columns of input ``name``; a missing column
    or one of another kind is an error that names it."""
    types = {f.name: f.dataType for f in df.schema.fields}
    for column, kind in SCHEMAS[name].items():
        if column not in types:
            raise ValueError(f"input {name}: no column {column}")
        if not isinstance(types[column], KINDS[kind]):
            raise ValueError(f"input {name}: {column} is {types[column].simpleString()}, not a {kind} column")
    return df.select(*SCHEMAS[name])


def check_unique_guide(guide: DataFrame) -> None:
    """Raise unless ``guide_id`` is unique and never NULL."""
    twice = guide.groupBy("guide_id").count().where(F.col("guide_id").isNull() | (F.col("count") > 1))
    n = twice.agg(F.count("*")).first()[0]
    if n:
        raise ValueError(f"input guide: {n} values of guide_id are NULL or repeated")


def _bind(names: Mapping[str, str], read: Callable[[str], DataFrame], check_guide: bool) -> Inputs:
    unknown = set(names) - set(SCHEMAS)
    missing = set(SCHEMAS) - set(names) - OPTIONAL
    if unknown or missing:
        raise ValueError(f"inputs: unknown {sorted(unknown)}, missing {sorted(missing)}")
    inputs = Inputs(**{k: checked(k, read(v)) for k, v in names.items()})
    if check_guide:
        check_unique_guide(inputs.guide)
    return inputs


def inputs_from_tables(spark: SparkSession, names: Mapping[str, str], check_guide: bool = True) -> Inputs:
    """Inputs from catalog tables: input name -> table name."""
    return _bind(names, spark.table, check_guide)


def inputs_from_paths(spark: SparkSession, paths: Mapping[str, str], check_guide: bool = True) -> Inputs:
    """Inputs from Parquet folders: input name -> path."""
    return _bind(paths, spark.read.parquet, check_guide)
