"""Receipts, and their form with one row per product."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cestero.functions import basket_tokens, basket_units, trimmed


def explode_transactions(
    tx: DataFrame, clean: bool = False, id_type: str = "int"
) -> DataFrame:
    """One row per product of each receipt, repeats kept.

    A NULL basket gives no row; a token that is no number gives a NULL id.
    """
    token = F.explode(basket_tokens(clean=clean))
    return tx.select("transaction_date", "store_id", "customer_id", token.alias("token")).select(
        "transaction_date",
        "store_id",
        "customer_id",
        F.col("token").try_cast(id_type).alias("product_id"),
    )


def for_stores(tx: DataFrame, store_ids: Iterable[int] | DataFrame | None) -> DataFrame:
    """Receipts of the given stores: ``None`` is all of them, ``[]`` is none.

    A long list is better given as a frame with a column ``store_id``.
    """
    if store_ids is None:
        return tx
    if isinstance(store_ids, DataFrame):
        return tx.join(store_ids.select("store_id").distinct(), "store_id", "left_semi").select(
            tx.columns
        )
    return tx.where(F.col("store_id").isin([int(s) for s in store_ids]))


def available_stores(tx: DataFrame) -> DataFrame:
    return tx.select("store_id").distinct().orderBy("store_id")


def require_stores(tx: DataFrame) -> DataFrame:
    """``available_stores``; it is an error if there is none."""
    stores = available_stores(tx)
    if stores.isEmpty():
        raise ValueError("there is no store")
    return stores


def baskets(tx: DataFrame) -> DataFrame:
    """Each receipt with its products as an array."""
    return tx.select(
        "customer_id", "transaction_date", "store_id", basket_tokens().alias("items")
    )


def basket_stats(tx: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of receipts and spread of the basket sizes, also per ``by``, in one pass."""
    sizes = tx.select(*by, basket_units().alias("basket_size"))
    return sizes.groupBy(*by).agg(
        F.count("*").alias("num_transacciones"),
        F.avg("basket_size").alias("avg_basket_size"),
        F.min("basket_size").alias("min_basket_size"),
        F.max("basket_size").alias("max_basket_size"),
    )


def multi_item(tx: DataFrame) -> DataFrame:
    """Receipts with two tokens or more: their trimmed text has a space."""
    return tx.where(trimmed().contains(" "))


def multi_item_count(tx: DataFrame) -> DataFrame:
    return tx.agg(F.count_if(trimmed().contains(" ")).alias("num_multi_item"))


def product_combinations(
    tx: DataFrame, normalise: bool = False, ordered: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """How often each exact basket of two products or more occurs.

    Order and repeats count as differences, so the trimmed text is the key: it
    hashes and travels cheaper than the array it stands for. ``normalise``
    compares baskets as sets instead.
    """
    if normalise:
        sets = tx.select(*by, F.array_sort(F.array_distinct(basket_tokens(clean=True))).alias("items"))
        text = F.array_join("items", " ").alias("text")
        combos = sets.where(F.size("items") >= 2).select(*by, text)
    else:
        combos = multi_item(tx).select(*by, trimmed().alias("text"))
    counted = combos.groupBy(*by, "text").agg(F.count("*").alias("frequency"))
    out = counted.select(*by, F.split("text", " ").alias("items"), "frequency")
    return out.orderBy(F.desc("frequency"), *by, "items") if ordered else out
