"""Headline figures and rankings of the executive summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cestero.functions import basket_tokens, basket_units, day, top


def basic_metrics(tx: DataFrame) -> DataFrame:
    """Receipts and units sold, in one pass; a NULL basket adds no unit."""
    return tx.agg(
        F.count("*").alias("total_transactions"),
        F.coalesce(F.sum(basket_units()), F.lit(0).cast("bigint")).alias("total_sales_units"),
    )


def count_by(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def top_products(ex: DataFrame, n: int = 10) -> DataFrame:
    return top(count_by(ex, "product_id", "total_sold"), n, "total_sold", "product_id")


def top_customers(tx: DataFrame, n: int = 10) -> DataFrame:
    counted = count_by(tx, "customer_id", "total_purchases")
    return top(counted, n, "total_purchases", "customer_id")


def peak_days(tx: DataFrame, n: int = 10, date_column: str = "transaction_date") -> DataFrame:
    counted = count_by(tx.select(day(date_column).alias("date")), "date", "num_transactions")
    return top(counted, n, "num_transactions", "date")


def category_volumes(
    product_counts: DataFrame,
    product_categories: DataFrame,
    categories: DataFrame,
    measure: str = "total_sold",
) -> DataFrame:
    """Units per category, from units per product.

    A product in several categories counts in each of them; one without any
    falls to (NULL, NULL). Counts add up, so the joins see one row per product
    and then one row per category instead of one row per line sold, and equal
    rows of the other side come as one row with their number. Neither side is
    forced into a broadcast: Spark decides by their sizes.
    """
    bridge = _with_copies(product_categories.select("product_id", "category_id"))
    names = _with_copies(categories.select("category_id", "category_name"))
    per_category = (
        product_counts.join(bridge, "product_id", "left")
        .groupBy("category_id")
        .agg(F.sum(F.col(measure) * _copies()).alias("total_volume"))
    )
    return per_category.join(names, "category_id", "left").select(
        "category_id",
        "category_name",
        (F.col("total_volume") * _copies()).alias("total_volume"),
    )


def _with_copies(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias("copies"))


def _copies() -> Column:
    """Number of equal rows on the right of a left join, 1 without a match."""
    return F.coalesce("copies", F.lit(1))


def top_categories(
    ex: DataFrame, product_categories: DataFrame, categories: DataFrame, n: int = 10
) -> DataFrame:
    volumes = category_volumes(
        count_by(ex, "product_id", "total_sold"), product_categories, categories
    )
    return top(volumes, n, "total_volume", "category_id", "category_name")


def headline_counts(
    tx: DataFrame, id_type: str = "int", date_column: str = "transaction_date"
) -> DataFrame:
    """``kind, id, n``: receipts per customer and per day, and units per product.

    All that the summary counts, from one pass over the receipts: each one gives an
    entry for its customer, one for its day and one for each token, and entries
    are counted by one aggregation that combines before it shuffles. A day's id is
    its number; what has no id (NULL) is counted too.
    """

    def entry(kind: str, number: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), number.cast("bigint").alias("id"))

    receipt = F.array(
        entry("customer", F.col("customer_id")), entry("day", F.unix_date(day(date_column)))
    )
    units = F.transform(basket_tokens(), lambda token: entry("product", token.try_cast(id_type)))
    entries = F.concat(receipt, F.coalesce(units, F.slice(receipt, 1, 0)))
    return tx.select(F.inline(entries)).groupBy("kind", "id").agg(F.count("*").alias("n"))


def counts_of(
    counts: DataFrame, kind: str, name: str, measure: str, id_type: str = "bigint"
) -> DataFrame:
    """One kind of ``headline_counts`` (``customer``, ``day`` or ``product``) under names of its own."""
    number = F.date_from_unix_date("id") if kind == "day" else F.col("id").cast(id_type)
    return counts.where(F.col("kind") == kind).select(
        number.alias(name), F.col("n").alias(measure)
    )
