"""The four summaries: groups of operators over the same receipts."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cestero.functions import top
from cestero.operators import baskets, customers, mining, products, quality, summary, temporal
from cestero.sinks.mining import MiningParameters, fingerprint, load_mining, save_mining
from cestero.sinks.shared import stage_table

STORE = ("store_id",)


def executive_summary(
    tx: DataFrame,
    product_categories: DataFrame,
    categories: DataFrame,
    top_n: int = 10,
    exploded: DataFrame | None = None,
    product_counts: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Headline figures and rankings, lazily.

    Products and categories rank from the same units per product. These come
    from ``product_counts`` if the caller has stored them, else from
    ``exploded`` if given, else from the basket texts.
    """
    if product_counts is None:
        metrics = summary.basic_metrics(tx)
        product_counts = units_per_product(tx, _id_type(product_categories), exploded)
    else:
        metrics = _metrics_from_counts(tx, product_counts)
    volumes = summary.category_volumes(product_counts, product_categories, categories)
    return {
        "basic_metrics": metrics,
        "top_products": top(product_counts, top_n, "total_sold", "product_id"),
        "top_customers": summary.top_customers(tx, top_n),
        "peak_days": summary.peak_days(tx, top_n),
        "top_categories": top(volumes, top_n, "total_volume", "category_id", "category_name"),
    }


def executive_summary_of(
    counts: DataFrame,
    product_categories: DataFrame,
    categories: DataFrame,
    top_n: int = 10,
    id_type: str = "int",
) -> dict[str, DataFrame]:
    """``executive_summary`` from stored ``summary.headline_counts``: receipts are read once for all of it."""

    def of(kind: str, name: str, measure: str) -> DataFrame:
        return summary.counts_of(counts, kind, name, measure, id_type)

    units = of("product", "product_id", "total_sold")
    volumes = summary.category_volumes(units, product_categories, categories)
    n = F.col("n")

    def total(kind: str, name: str) -> Column:
        found = F.sum(F.when(F.col("kind") == kind, n))
        return F.coalesce(found, F.lit(0).cast("bigint")).alias(name)

    return {
        "basic_metrics": counts.agg(
            total("day", "total_transactions"), total("product", "total_sales_units")
        ),
        "top_products": top(units, top_n, "total_sold", "product_id"),
        "top_customers": top(
            of("customer", "customer_id", "total_purchases"), top_n, "total_purchases", "customer_id"
        ),
        "peak_days": top(of("day", "date", "num_transactions"), top_n, "num_transactions", "date"),
        "top_categories": top(volumes, top_n, "total_volume", "category_id", "category_name"),
    }


def units_per_product(
    tx: DataFrame, id_type: str = "int", exploded: DataFrame | None = None
) -> DataFrame:
    if exploded is None:
        exploded = baskets.explode_transactions(tx, id_type=id_type)
    return summary.count_by(exploded, "product_id", "total_sold")


def _id_type(product_categories: DataFrame) -> str:
    return product_categories.schema["product_id"].dataType.simpleString()


def _metrics_from_counts(tx: DataFrame, product_counts: DataFrame) -> DataFrame:
    """The headline figures without a second pass over the basket texts."""
    units = product_counts.agg(F.sum("total_sold")).scalar()
    return tx.agg(F.count("*").alias("total_transactions")).select(
        "total_transactions",
        F.coalesce(units, F.lit(0).cast("bigint")).alias("total_sales_units"),
    )


@dataclass(frozen=True)
class _Section:
    name: str
    key: str
    value: str
    ties: tuple[str, ...]


_RANKINGS = (
    _Section("top_products", "product_id", "total_sold", ("product_id",)),
    _Section("top_customers", "customer_id", "total_purchases", ("customer_id",)),
    _Section("peak_days", "date", "num_transactions", ("date",)),
    _Section("top_categories", "category_id", "total_volume", ("category_id", "category_name")),
)


def executive_summary_rows(
    tx: DataFrame,
    product_categories: DataFrame,
    categories: DataFrame,
    top_n: int = 10,
    exploded: DataFrame | None = None,
) -> DataFrame:
    """The executive summary in one frame: section, rank, key, value.

    One query over four counts, each of which reads only its own column; the
    totals come from the counts per day and per product that the rankings
    have made anyway.
    """
    product_counts = units_per_product(tx, _id_type(product_categories), exploded)
    frames = executive_summary(
        tx, product_categories, categories, top_n, product_counts=product_counts
    )
    days = temporal.per_day(tx)
    totals = [
        _total_row(days, "num_transacciones", 1, "total_transactions"),
        _total_row(product_counts, "total_sold", 2, "total_sales_units"),
    ]
    ranked = [_ranked(frames[s.name], s) for s in _RANKINGS]
    return reduce(DataFrame.unionByName, totals + ranked)


def one_scan_summary_rows(
    counts: DataFrame,
    product_categories: DataFrame,
    categories: DataFrame,
    top_n: int = 10,
    id_type: str = "int",
) -> DataFrame:
    """``executive_summary_rows`` from stored ``summary.headline_counts``."""
    frames = executive_summary_of(counts, product_categories, categories, top_n, id_type)
    metrics = frames["basic_metrics"]
    totals = [
        metrics.select(
            F.lit("basic_metrics").alias("section"),
            F.lit(rank).alias("rank"),
            F.lit(name).alias("key"),
            F.col(name).alias("value"),
        )
        for rank, name in enumerate(metrics.columns, 1)
    ]
    ranked = [_ranked(frames[s.name], s) for s in _RANKINGS]
    return reduce(DataFrame.unionByName, totals + ranked)


def _total_row(counts: DataFrame, measure: str, rank: int, key: str) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return counts.agg(F.coalesce(F.sum(measure), zero).alias("value")).select(
        F.lit("basic_metrics").alias("section"),
        F.lit(rank).alias("rank"),
        F.lit(key).alias("key"),
        "value",
    )


def _ranked(df: DataFrame, section: _Section) -> DataFrame:
    """Number the rows of a ranking; the window holds those rows only."""
    order = Window.orderBy(
        F.desc(section.value), *(F.asc_nulls_first(tie) for tie in section.ties)
    )
    return df.select(
        F.lit(section.name).alias("section"),
        F.row_number().over(order).alias("rank"),
        F.col(section.key).cast("string").alias("key"),
        F.col(section.value).alias("value"),
    )


def temporal_summary(tx: DataFrame, date_column: str = "transaction_date") -> dict[str, DataFrame]:
    return {
        "daily": temporal.daily_sales(tx, date_column),
        **over_time(temporal.per_day(tx, date_column)),
    }


def over_time(days: DataFrame, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """What is rolled up from ``temporal.per_day``; of each store with the days themselves."""
    found = {
        "weekly": temporal.weeks_of(days, by=by),
        "monthly": temporal.months_of(days, by),
        "day_of_week": temporal.weekdays_of(days, by),
        "trends": temporal.trend_of(days, by),
    }
    return _of_stores({"daily": days, **found}) if by else found


def _of_stores(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {f"{name}_per_store": frame for name, frame in frames.items()}


def customer_summary(tx: DataFrame) -> dict[str, DataFrame]:
    return {
        "frequency": customers.purchase_frequency(tx),
        "time_between": customers.time_between_purchases(tx),
        "rfm": customers.rfm_segmentation(tx),
    }


def per_customer(found: DataFrame, by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """``customer_summary`` from ``customers.profiles``, or what it is for each store."""
    frequencies = customers.frequency_in(found, by)
    frames = {
        "rfm": customers.rfm_of(frequencies, by=by),
        "time_between": customers.intervals_in(found, by),
        "frequency": frequencies,
    }
    return _of_stores(frames) if by else frames


def basket_frames(sizes: DataFrame, of_stores: DataFrame) -> dict[str, DataFrame]:
    """Frames per store from ``quality.store_sizes`` and ``customers.profiles``."""
    spread = ("avg_basket_size", "min_basket_size", "max_basket_size")
    return {
        "store_summary": quality.store_summary_of(sizes, of_stores),
        "basket_stats_per_store": sizes.select("store_id", "num_transacciones", *spread),
    }


def market_basket(
    baskets_or_tx: DataFrame,
    min_support: float = mining.MIN_SUPPORT,
    min_confidence: float = mining.MIN_CONFIDENCE,
    reuse_path: str | None = None,
    source: str | None = None,
    num_partitions: int | None = None,
    stage: Callable[[DataFrame], DataFrame] = stage_table,
    search: Callable[..., mining.MinedItemsets] = mining.mine_itemsets,
) -> dict[str, object]:
    """Frequent itemsets and rules of receipts, or of baskets with ``items``.

    ``search`` is FP-growth, or ``vertical.mine_itemsets``, which needs no item
    names on the driver and gives the same itemsets, but no model.

    With ``reuse_path`` the result of an earlier search is taken from there if it
    was made with the same parameters, the same ``source`` name, which has to be
    given, and of the same baskets; it is stored there otherwise. Reading the
    baskets once for their fingerprint is the price of not returning old results.
    """
    sets = baskets_or_tx
    if "items" not in sets.columns:
        sets = mining.mining_baskets(sets)
    if reuse_path:
        if not source:
            raise ValueError("reuse_path needs the name of the source")
        parameters = MiningParameters(
            source, fingerprint(sets), float(min_support), float(min_confidence)
        )
        stored = load_mining(baskets_or_tx.sparkSession, reuse_path, parameters)
        if stored:
            return {"frequent_itemsets": stored[0], "association_rules": stored[1], "model": None}
    mined = search(sets, min_support, min_confidence, num_partitions, stage)
    rules = mining.association_rules(mined.itemsets, mined.n_baskets, min_confidence)
    if reuse_path:
        save_mining(mined.itemsets, rules, reuse_path, parameters)
    return {
        "frequent_itemsets": mined.itemsets,
        "association_rules": rules,
        "model": mined.model,
    }


def product_summary(
    tx: DataFrame,
    exploded: DataFrame,
    run_market_basket: bool = True,
    min_support: float = mining.MIN_SUPPORT,
    min_confidence: float = mining.MIN_CONFIDENCE,
    mining_input: DataFrame | None = None,
    stage: Callable[[DataFrame], DataFrame] = stage_table,
    sales: DataFrame | None = None,
) -> dict[str, object]:
    """Product frames; a failing search for patterns is raised, not hidden.

    Patterns are sought in the baskets of ``tx``, or in ``mining_input``. ``sales`` are
    the units per store and product if they are stored; ``exploded`` is not read then.
    """
    searched = tx if mining_input is None else mining_input
    if sales is None:
        best, units = products.top_products_per_store(exploded), products.product_sales(exploded)
    else:
        best = products.best_of_stored(sales)
        units = sales.groupBy("product_id").agg(F.sum("num_ventas").alias("num_ventas"))
    return {
        "top_products": units,
        "store_products": best,
        "combinations": baskets.product_combinations(tx),
        "market_basket": (
            market_basket(searched, min_support, min_confidence, stage=stage)
            if run_market_basket
            else None
        ),
    }


def store_summaries(tx: DataFrame, best: DataFrame) -> dict[str, DataFrame]:
    """What the other summaries hold, for each store by itself; ``best`` are its best sellers."""
    return {
        "store_summary": quality.store_summary(tx),
        **over_time(temporal.per_day(tx, by=STORE), STORE),
        "frequency_per_store": customers.purchase_frequency(tx, by=STORE),
        "time_between_per_store": customers.time_between_purchases(tx, by=STORE),
        "rfm_per_store": customers.rfm_segmentation(tx, by=STORE),
        "basket_stats_per_store": baskets.basket_stats(tx, by=STORE),
        "combinations_per_store": baskets.product_combinations(tx, by=STORE),
        "products_per_store": best,
    }
