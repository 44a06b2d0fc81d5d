"""Transactions read from an order-line star schema.

Only the joins that the asked-for columns need enter the plan. Dimension joins
carry no broadcast hint: Catalyst broadcasts a dimension whose measured size is
under the threshold and sort-merges it otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, labels: bool = True,
                 stores: bool = False) -> DataFrame:
    """Store-level transactions; (`l_orderkey`, `l_linenumber`) orders rows of a day."""
    line = table(spark, sf_dir, "lineitem")
    tx = line.select(
        F.col("l_partkey").alias("sku_key"),
        F.col("l_shipdate").cast("date").alias("tran_date"),
        F.col("l_orderkey"), F.col("l_linenumber"),
        *([F.col("l_suppkey").alias("store_key")] if stores else []),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
        .otherwise(F.col("l_quantity")).alias("sales"),
        F.try_divide("l_extendedprice", "l_quantity").alias("selling_price"),
        F.try_divide(F.col("l_discount") * F.col("l_extendedprice"),
                     F.col("l_quantity")).alias("avg_discount"),
        ((F.col("l_orderkey") % 41).cast("double") - 4).alias("stock_open"),
    )
    if labels:
        words = F.split("p_name", " ")
        part = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("sku_key"),
            F.col("p_type").alias("sku_department"),
            F.col("p_brand").alias("sku_subdepartment"),
            F.element_at(words, -1).alias("sku_category"),
            F.element_at(words, 1).alias("sku_subcategory"),
            F.col("p_name").alias("sku_label"),
        )
        tx = tx.join(part, "sku_key", "left")
    if stores:
        supplier = table(spark, sf_dir, "supplier")
        nation = table(spark, sf_dir, "nation")
        region = table(spark, sf_dir, "region")
        store = (supplier
                 .join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
                 .join(region, nation.n_regionkey == region.r_regionkey, "left")
                 .select(F.col("s_suppkey").alias("store_key"),
                         F.col("r_name").alias("store_region"),
                         F.when(F.col("s_acctbal") >= 5000, "A")
                         .when(F.col("s_acctbal") >= 0, "B")
                         .otherwise("C").alias("store_grading")))
        tx = tx.join(store, "store_key", "left")
    return tx
