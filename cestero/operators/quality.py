"""Checks of receipts and reference data, figures per store, and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cestero.functions import basket_tokens, basket_units, trimmed
from cestero.operators.temporal import per_day


def category_report(product_categories: DataFrame, categories: DataFrame) -> DataFrame:
    """Number of products of every category, also of those without any."""
    counted = product_categories.groupBy("category_id").agg(
        F.count_distinct("product_id").alias("num_products")
    )
    return categories.join(counted, "category_id", "left").select(
        "category_id",
        "category_name",
        F.coalesce("num_products", F.lit(0).cast("bigint")).alias("num_products"),
    )


def unknown_categories(product_categories: DataFrame, categories: DataFrame) -> DataFrame:
    """Categories that products refer to and the catalogue lacks."""
    return (
        product_categories.groupBy("category_id")
        .agg(F.count_distinct("product_id").alias("num_products"))
        .join(categories.select("category_id").distinct(), "category_id", "left_anti")
    )


def uncategorised_products(product_counts: DataFrame, product_categories: DataFrame) -> DataFrame:
    """Products sold, given with their units, that are in no category."""
    known = product_categories.select("product_id").distinct()
    return product_counts.join(known, "product_id", "left_anti")


def transaction_quality(tx: DataFrame, id_type: str = "int") -> DataFrame:
    """One row of counts: NULLs per column, odd baskets, odd tokens, repeats.

    What a basket text shows is found where it is read; equal receipts are then
    brought together by a digest of it, so that no text is shuffled.
    """
    columns = ["transaction_date", "store_id", "customer_id", "products"]
    bad = F.array_size(
        F.filter(basket_tokens(clean=True), lambda token: token.try_cast(id_type).isNull())
    )
    text = F.col("products")
    seen = tx.select(
        *columns[:3],
        F.sha2(text.cast("binary"), 256).alias("products"),
        (trimmed() == "").alias("empty"),
        trimmed().contains("  ").alias("double_space"),
        bad.alias("bad"),
    )
    # Receipts of one digest have one text, so any of their values will do.
    distinct = seen.groupBy(*columns).agg(
        F.count("*").alias("n"),
        *(F.max(c).alias(c) for c in ("empty", "double_space", "bad")),
    )
    n = F.col("n")

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0).cast("bigint"))

    zero = F.lit(0).cast("bigint")
    return distinct.agg(
        F.coalesce(F.sum(n), zero).alias("total_transactions"),
        *(total(F.col(c).isNull()).alias(f"null_{c}") for c in columns),
        total(F.col("empty")).alias("empty_products"),
        total(F.col("double_space")).alias("double_space_products"),
        F.coalesce(F.sum(n * F.col("bad")), zero).alias("bad_tokens"),
        F.coalesce(F.sum(n - 1), zero).alias("duplicate_transactions"),
    )


def store_summary(tx: DataFrame) -> DataFrame:
    """Receipts, units, customers and basket size of every store, in one job."""
    return (
        tx.select("store_id", "customer_id", basket_units().alias("units"))
        .groupBy("store_id")
        .agg(
            F.count("*").alias("num_transacciones"),
            F.coalesce(F.sum("units"), F.lit(0).cast("bigint")).alias("total_unidades"),
            F.count_distinct("customer_id").alias("clientes_unicos"),
            F.avg("units").alias("avg_basket_size"),
        )
    )


def store_sizes(tx: DataFrame) -> DataFrame:
    """Number of receipts of every store, and sum and spread of their sizes, in one pass."""
    return (
        tx.select("store_id", basket_units().alias("units"))
        .groupBy("store_id")
        .agg(
            F.count("*").alias("num_transacciones"),
            F.coalesce(F.sum("units"), F.lit(0).cast("bigint")).alias("total_unidades"),
            F.avg("units").alias("avg_basket_size"),
            F.min("units").alias("min_basket_size"),
            F.max("units").alias("max_basket_size"),
        )
    )


def store_summary_of(sizes: DataFrame, customers: DataFrame) -> DataFrame:
    """``store_summary`` from ``store_sizes`` and a row per customer of each store."""
    # In a struct, NULL is equal to NULL.
    own = customers.groupBy(F.struct("store_id").alias("of")).agg(
        F.count("customer_id").alias("clientes_unicos")
    )
    return sizes.join(own, F.struct("store_id") == F.col("of")).select(
        "store_id", "num_transacciones", "total_unidades", "clientes_unicos", "avg_basket_size"
    )


def daily_sales_per_store(tx: DataFrame) -> DataFrame:
    """Receipts per store and day; ``per_day`` with another name."""
    return per_day(tx, by=("store_id",))


def write_per_store(df: DataFrame, path: str) -> None:
    """CSV with one folder per store, written by a single job."""
    writer = df.hint("rebalance", "store_id").write.mode("overwrite").partitionBy("store_id")
    writer.option("header", True).csv(path)


def sample_transactions(
    tx: DataFrame,
    max_records: int | None = None,
    fraction: float | None = None,
    seed: int | None = None,
    order_by: Sequence[str | Column] = (),
) -> DataFrame:
    """The first ``max_records`` receipts by ``order_by``, or a random ``fraction`` of them.

    A sample has to be repeatable: the one kind needs an order, the other a seed.
    """
    if fraction is not None:
        if seed is None:
            raise ValueError("a fraction needs a seed")
        tx = tx.sample(fraction=fraction, seed=seed)
    if max_records is not None:
        if not order_by:
            raise ValueError("max_records needs an order")
        tx = tx.orderBy(*order_by).limit(max_records)
    return tx


def in_hash_order(tx: DataFrame) -> list[Column]:
    """An order for samples that does not follow files or stores."""
    return [F.xxhash64(*tx.columns), *(F.col(c) for c in tx.columns)]
