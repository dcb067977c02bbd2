"""Mart inputs from the supplied TPC-H-style tables, as FIXTURES.md part B
specifies, so that every operator runs on real, scaling data and can be
compared with DuckDB."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martcraft.functions.dates import month_start
from martcraft.sources.dealing import dealt_join
from martcraft.sources.inputs import Inputs
from martcraft.sources.tables import read_table


def _model(pk: Column, ptype: Column, psize: Column) -> Column:
    return (F.when(pk % 97 == 0, F.lit(None).cast("string"))
            .when(pk % 89 == 0, F.lit(""))
            .otherwise(F.concat(ptype, F.lit("-"), (psize % 5).cast("string"))))


def _qty(c: str) -> Column:
    return F.col(c).cast("bigint")


def fixture_inputs(spark: SparkSession, base_dir: str) -> Inputs:
    part = read_table(spark, base_dir, "part")
    orders = read_table(spark, base_dir, "orders")
    lineitem = read_table(spark, base_dir, "lineitem")
    customer = read_table(spark, base_dir, "customer")
    nation = read_table(spark, base_dir, "nation")
    region = read_table(spark, base_dir, "region")

    pk, ptype, psize = F.col("p_partkey"), F.col("p_type"), F.col("p_size")
    model = _model(pk, ptype, psize)

    guide = part.select(
        pk.alias("guide_id"),
        F.col("p_name").alias("name"),
        F.when((pk % 3 == 0) | F.col("p_name").like("hot%"), F.lit(None).cast("string"))
        .otherwise(F.concat(F.when(pk % 2 == 0, F.lit("А")).otherwise(F.lit("С")),
                            psize.cast("string"), F.lit("-"), ptype)).alias("code65"),
        model.alias("factory_model"),
        F.col("p_brand").alias("manufacturer"),
        F.when(psize % 4 == 0, "LCV").when(psize % 4 == 1, "MCV")
        .when(psize % 4 == 2, "BUS").otherwise("OTHER").alias("division"),
    )

    n_lines, n_parts = lineitem.count(), part.count()  # of the files' footers
    li_o = dealt_join(lineitem, orders, "l_orderkey", "o_orderkey", n_lines)
    kit_sales = dealt_join(li_o, part, "l_partkey", "p_partkey", n_lines, n_parts).select(
        month_start("l_shipdate").alias("month"),
        F.when(F.col("l_suppkey") % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("ASIA")).alias("division"),
        F.when(F.col("l_suppkey") % 2 == 0, F.col("p_brand"))
        .otherwise(F.lit("Brand#99")).alias("counterparty"),
        F.when(F.col("l_linenumber") % 2 == 0, model)
        .otherwise(F.concat(F.when(pk % 2 == 0, F.lit("A")).otherwise(F.lit("C")),
                            psize.cast("string"), F.lit("-00"), ptype)).alias("drawing_no"),
        F.col("l_linestatus").alias("assembly_variant"),
        F.col("o_orderstatus").alias("sales_direction"),
        _qty("l_quantity").alias("sold_qty"),
    )

    geo = (customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select("c_custkey", "r_name"))
    # orders meet their customer before the lines do: one shuffle of the lines less
    owned = orders.join(geo, F.col("o_custkey") == F.col("c_custkey"))
    li_owned = dealt_join(lineitem, owned, "l_orderkey", "o_orderkey", n_lines)
    retail = (dealt_join(li_owned, part, "l_partkey", "p_partkey", n_lines, n_parts)
              .select(
                  F.col("l_shipdate").alias("period"),
                  F.col("r_name").alias("division"),
                  F.col("p_name").alias("internal_code"),
                  F.col("l_linestatus").alias("assembly_variant"),
                  F.col("o_orderstatus").alias("sales_direction"),
                  F.col("o_orderpriority").alias("vin"),
                  F.col("o_custkey").alias("dealer_id"),
                  _qty("l_quantity").alias("retail_qty"),
                  F.when(F.col("l_returnflag") == "R", F.lit(None).cast("bigint"))
                  .otherwise(_qty("l_linenumber")).alias("opening_stock"),
                  _qty("l_linenumber").alias("closing_stock"),
              ))

    direction_id = F.substring("o_orderpriority", 1, 1).cast("bigint")
    realization = li_o.select(
        F.col("l_shipdate").alias("period"),  # a stored column, so filters on it reach the scan
        F.col("l_partkey").alias("product_id"),
        direction_id.alias("direction_id"),
        _qty("l_quantity").alias("qty"),
    )
    product = part.select(
        pk.alias("id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("code65"), ptype.alias("assembly_variant"),
        (psize % 5).cast("bigint").alias("division_id"))
    direction = orders.select(
        direction_id.alias("id"),
        F.col("o_orderpriority").alias("sales_direction")).distinct()
    division = region.select(F.col("r_regionkey").cast("bigint").alias("id"),
                             F.col("r_name").alias("name"))
    dealer = customer.select(F.col("c_custkey").alias("id"),
                             F.col("c_mktsegment").alias("division"))
    retail_peer = retail.select(month_start("period").alias("month"), "retail_qty")
    return Inputs(retail=retail, guide=guide, kit_sales=kit_sales,
                  realization=realization, product=product, direction=direction,
                  division=division, dealer=dealer, retail_peer=retail_peer)
