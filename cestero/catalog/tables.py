"""The generated star schema seen as receipts, products and categories.

Each function reads only the tables and columns its caller asks for: the joins
below are on primary keys, so leaving one out changes no row. Ids keep the 64
bits they have in the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def basket_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product ids of each order as one text, which is a receipt's own format.

    The list grows with the lines of one order and has to fit the one cell
    that a receipt is. Lines are brought together before they are listed: lists of
    part of an order, made before the shuffle, hold a line or two and cost more.
    """
    line = F.struct("l_linenumber", "l_partkey")
    parts = F.sort_array(F.collect_list(line))["l_partkey"]
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey")
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.array_join(parts.cast("array<string>"), " ").alias("products"))
    )


def transactions(
    spark: SparkSession, sf_dir: str, store: bool = True, products: bool = True
) -> DataFrame:
    """One row per order; ``products`` is NULL for an order without lines."""
    tx = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.to_date("o_orderdate").alias("transaction_date"),
        F.col("o_custkey").alias("customer_id"),
    )
    if store:
        stores = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("store_id")
        )
        tx = tx.join(stores, "customer_id", "left")
    else:
        tx = tx.withColumn("store_id", F.lit(None).cast("int"))
    if products:
        texts = basket_texts(spark, sf_dir).withColumnRenamed("l_orderkey", "transaction_id")
        tx = tx.join(texts, "transaction_id", "left")
    else:
        tx = tx.withColumn("products", F.lit(None).cast("string"))
    return tx.select("transaction_id", "transaction_date", "store_id", "customer_id", "products")


def receipt_lines(spark: SparkSession, sf_dir: str, store: bool = True) -> DataFrame:
    """Receipts in pieces of one product each.

    They explode to the same rows as whole receipts and need no grouping, so
    an order with any number of lines stays spread over the cluster.
    """
    orders = transactions(spark, sf_dir, store=store, products=False).drop("products")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").cast("string").alias("products"),
    )
    return lines.join(orders, "transaction_id").select(
        "transaction_id", "transaction_date", "store_id", "customer_id", "products"
    )


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .where("p_partkey % 50 <> 0")
        .select(
            F.col("p_partkey").alias("product_id"),
            F.substring("p_brand", 7, 10).cast("int").alias("category_id"),
        )
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .where("p_brand <> 'Brand#11'")
        .select(
            F.substring("p_brand", 7, 10).cast("int").alias("category_id"),
            F.col("p_brand").alias("category_name"),
        )
        .distinct()
    )


def type_baskets(spark: SparkSession, sf_dir: str, store: bool = False) -> DataFrame:
    """The set of product types in each order that has lines, with its store if asked for."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    sets = (
        table(spark, sf_dir, "lineitem")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", "p_type")
        # As in basket_texts.
        .repartition("l_orderkey")
        .groupBy("l_orderkey")
        .agg(F.collect_set("p_type").alias("items"))
    )
    if not store:
        return sets.select("items")
    stores = transactions(spark, sf_dir, products=False).select("transaction_id", "store_id")
    return sets.join(stores, F.col("l_orderkey") == F.col("transaction_id")).select("store_id", "items")
