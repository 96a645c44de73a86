"""Sales per product, overall and per store."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cestero.functions import spread
from cestero.operators.summary import count_by


def store_product_sales(ex: DataFrame) -> DataFrame:
    """Units per store and product, from which the rankings below can be made."""
    return ex.groupBy("store_id", "product_id").agg(F.count("*").alias("num_ventas"))


def product_sales(ex: DataFrame, ordered: bool = False) -> DataFrame:
    """Units per product, all products. ``ordered`` sorts the best seller first."""
    out = count_by(ex, "product_id", "num_ventas")
    return out.orderBy(F.desc("num_ventas"), "product_id") if ordered else out


def product_sales_stats(ex: DataFrame) -> DataFrame:
    return spread(
        product_sales(ex),
        "num_ventas",
        avg="promedio_ventas",
        min="min_ventas",
        max="max_ventas",
    )


def top_products_per_store(ex: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best sellers of every store.

    Spark cuts to n rows per store in every task before the shuffle on the
    store, so one store with most of the sales stays cheap.
    """
    return best_per_store(store_product_sales(ex), n)


def best_per_store(sales: DataFrame, n: int = 10) -> DataFrame:
    """``top_products_per_store`` from ``store_product_sales``."""
    return _ranked(sales, n)


def best_of_stored(sales: DataFrame, n: int = 10) -> DataFrame:
    """``best_per_store`` of stored ``sales``, without a sort of all of them.

    How many products of a store sold how often tells the least number that can be
    among the ``n`` best; what sold less often is not ranked. The histogram has one
    row per store and different number, and its cuts one per store.
    """
    downwards = Window.partitionBy("store_id").orderBy(F.desc("num_ventas"))
    better = F.sum("products").over(downwards.rowsBetween(Window.unboundedPreceding, -1))
    cuts = (
        sales.groupBy("store_id", "num_ventas")
        .agg(F.count("*").alias("products"))
        .withColumn("better", F.coalesce(better, F.lit(0)))
        .where(F.col("better") < n)
        .groupBy(F.struct("store_id").alias("of"))
        .agg(F.min("num_ventas").alias("least"))
    )
    # In a struct, NULL is equal to NULL.
    own = (F.struct("store_id") == F.col("of")) & (F.col("num_ventas") >= F.col("least"))
    return _ranked(sales.join(F.broadcast(cuts), own, "left_semi"), n)


def _ranked(sales: DataFrame, n: int) -> DataFrame:
    best_first = Window.partitionBy("store_id").orderBy(
        F.desc("num_ventas"), F.asc_nulls_first("product_id")
    )
    return (
        sales.withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= n)
        .orderBy("store_id", "rank")
    )
