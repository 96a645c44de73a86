"""Batch jobs from delimited files to JSON reports.

    python -m cestero.plans.job --data-base-uri s3a://in --output-prefix s3a://out
    python -m cestero.plans.job --job analytics --min-support 0.02 ...
    python -m cestero.plans.job --job sample --max-records 1000 ...

The executive summary is the default. Arguments left out come from the
environment of a file source, if set there.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cestero.functions import basket_units
from cestero.operators.baskets import explode_transactions, product_combinations, require_stores
from cestero.operators.customers import all_profiles, profiles
from cestero.operators.mining import MIN_CONFIDENCE, MIN_SUPPORT
from cestero.operators.products import store_product_sales
from cestero.operators.quality import in_hash_order, sample_transactions, store_sizes
from cestero.operators.summary import headline_counts
from cestero.operators.temporal import all_days, daily_sales, per_day
from cestero.plans.summaries import (
    STORE,
    basket_frames,
    executive_summary_of,
    market_basket,
    over_time,
    per_customer,
    product_summary,
)
from cestero.sinks.observed import stage_observed
from cestero.sinks.reports import Reports
from cestero.sinks.shared import stage_table, staging
from cestero.sources import DelimitedSource
from cestero.sources.select import settings_from

# Rankings by the name in their report.
RANKINGS = {
    "products": "top_products",
    "customers": "top_customers",
    "peak_days": "peak_days",
    "categories": "top_categories",
}

#: Reports that are written at a time; each leaves most of a cluster idle at its end.
WRITERS = 6

# Fixed value: receipts in a sample.
SAMPLE_SIZE = 5000

# How runs are named in the metadata.
SUMMARY_RUN = ("01_executive_summary", "generate_executive_summary")
SAMPLE_RUN = ("02_sample_summary", "sample")
ANALYTICS_RUN = ("03_analytics", "analytics")


def parse_arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Executive summary of retail receipts.")
    parser.add_argument("--job", choices=["summary", "analytics", "sample"], default="summary")
    parser.add_argument("--min-support", type=float, default=MIN_SUPPORT, help="of itemsets")
    parser.add_argument("--min-confidence", type=float, default=MIN_CONFIDENCE, help="of rules")
    parser.add_argument("--max-records", type=int, default=SAMPLE_SIZE, help="of a sample")
    parser.add_argument("--data-base-uri", help="base path of the input files")
    parser.add_argument("--transactions-path", help="folder of the receipt files")
    parser.add_argument("--categories-path", help="file of the category names")
    parser.add_argument("--product-categories-path", help="file of products and categories")
    parser.add_argument("--output-prefix", required=True, help="base path of the reports")
    parser.add_argument("--separator", help="column separator of the input")
    parser.add_argument("--job-name", default="executive-summary", help="application name")
    parser.add_argument("--top-n", type=int, default=10, help="length of the rankings")
    parser.add_argument("--dag-id", default=SUMMARY_RUN[0], help="for the metadata")
    parser.add_argument("--task-id", default=SUMMARY_RUN[1], help="for the metadata")
    return parser.parse_args(argv)


def write_summary(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    totals: Mapping[str, int],
    base: str,
    top_n: int,
    dag_id: str,
    task_id: str,
) -> None:
    """Write each result once, the totals, and the metadata with them."""
    reports = Reports(base)
    reports.document(totals, "basic_metrics.json", spark)
    for name, frame in RANKINGS.items():
        reports.top_items(frames[frame], name, top_n)
    reports.run_metadata(spark, dag_id, task_id, {**totals, "status": "success"})


def run(
    source: DelimitedSource,
    output: str,
    top_n: int = 10,
    dag_id: str = SUMMARY_RUN[0],
    task_id: str = SUMMARY_RUN[1],
) -> None:
    """Receipts are read once, for counts per customer, day and product; the totals
    are taken on the way."""
    with staging(source.spark) as stage:

        def of(kind: str) -> Column:
            return F.sum(F.when(F.col("kind") == kind, F.col("n")))

        counts, totals = stage_observed(
            headline_counts(source.transactions(), source.id_type),
            stage,
            total_transactions=of("day"),
            total_sales_units=of("product"),
        )
        frames = executive_summary_of(
            counts, source.product_categories(), source.categories(), top_n, source.id_type
        )
        del frames["basic_metrics"]
        write_summary(source.spark, frames, totals, output, top_n, dag_id, task_id)


def run_sample(source: DelimitedSource, output: str, max_records: int = SAMPLE_SIZE) -> None:
    """Daily activity in some receipts only, to try an installation out.

    Which ones a hash of the whole receipt decides, so every run takes the same,
    from all stores.
    """
    with staging(source.spark) as stage:
        tx = source.transactions()
        # Stored, so that all reports are about the same receipts.
        sample, totals = stage_observed(
            sample_transactions(tx, max_records, order_by=in_hash_order(tx)),
            stage,
            total_transactions=F.count(F.lit(1)),
            total_sales_units=F.sum(basket_units()),
        )
        reports = Reports(output)
        reports.time_series(daily_sales(sample), "sample_summary", "date", "num_transacciones")
        info = {**totals, "max_records": max_records, "status": "success"}
        reports.run_metadata(source.spark, *SAMPLE_RUN, info)


def analytics_frames(
    tx: DataFrame,
    exploded: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    mining_input: DataFrame | None = None,
    stage: Callable[[DataFrame], DataFrame] = stage_table,
) -> Iterator[tuple[str, DataFrame]]:
    """All frames of the temporal, customer and product summaries and per store, by name.

    What several frames are made of is stored once: receipts per store and day, a row
    per customer of each store, the stores' basket sizes, units per store and product,
    and the best sellers of the stores. These tables and the search for patterns are
    made side by side, and a frame comes as soon as there is what it is made of.
    """
    searched = tx if mining_input is None else mining_input

    def product_frames() -> dict[str, DataFrame]:
        sales = stage(store_product_sales(exploded))
        found = product_summary(tx, exploded, run_market_basket=False, sales=sales)
        best = stage(found["store_products"])
        units = found["top_products"]
        return {"top_products": units, "store_products": best, "products_per_store": best}

    def pattern_frames() -> dict[str, DataFrame]:
        found = market_basket(searched, min_support, min_confidence, stage=stage)
        return {name: found[name] for name in ("frequent_itemsets", "association_rules")}

    def customer_frames() -> dict[str, DataFrame]:
        found = stage(profiles(tx, STORE))
        sizes = stage(store_sizes(tx))
        return {
            **per_customer(found, STORE),
            **per_customer(all_profiles(found)),
            **basket_frames(sizes, found),
        }

    def day_frames() -> dict[str, DataFrame]:
        days = stage(per_day(tx, by=STORE))
        return over_time(days, STORE) | over_time(all_days(days))

    def receipt_frames() -> dict[str, DataFrame]:
        return {
            "daily": daily_sales(tx),
            "combinations": product_combinations(tx),
            "combinations_per_store": product_combinations(tx, by=STORE),
        }

    # Those of most steps first.
    parts = (pattern_frames, customer_frames, product_frames, day_frames, receipt_frames)
    with ThreadPoolExecutor(len(parts)) as makers:
        for made in as_completed([makers.submit(part) for part in parts]):
            yield from made.result().items()


def run_analytics(
    source: DelimitedSource,
    output: str,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    mining_input: DataFrame | None = None,
) -> dict[str, StructType]:
    """Every frame as a series below ``analytics``; returns their names and schemas.

    The reports do not depend on each other, so a few are written at a time.
    """
    with staging(source.spark) as stage:
        # Parsed once; each frame reads the columns it needs.
        tx = stage(source.transactions())
        require_stores(tx)
        exploded = explode_transactions(tx, id_type=source.id_type)
        frames = analytics_frames(tx, exploded, min_support, min_confidence, mining_input, stage)
        reports = Reports(output)

        def write(name: str, frame: DataFrame) -> tuple[str, StructType]:
            reports.time_series(frame, name, frame.columns[0], frame.columns[-1])
            return name, frame.schema

        with ThreadPoolExecutor(WRITERS) as writers:
            started = [writers.submit(write, name, frame) for name, frame in frames]
            written = dict(sorted(report.result() for report in started))
        info = {"min_support": min_support, "min_confidence": min_confidence, "status": "success"}
        reports.run_metadata(source.spark, *ANALYTICS_RUN, info)
    return written


def main(argv: Sequence[str] | None = None) -> None:
    args = parse_arguments(argv)
    spark = (
        SparkSession.builder.appName(args.job_name)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    given = {
        "base": args.data_base_uri,
        "transactions_path": args.transactions_path,
        "categories_path": args.categories_path,
        "product_categories_path": args.product_categories_path,
        "sep": args.separator,
    }
    settings = settings_from({**os.environ, "DATA_SOURCE": "s3"})
    settings |= {name: value for name, value in given.items() if value}
    settings.pop("kind")
    source = DelimitedSource(spark, **settings)
    try:
        if args.job == "sample":
            run_sample(source, args.output_prefix, args.max_records)
        elif args.job == "analytics":
            run_analytics(source, args.output_prefix, args.min_support, args.min_confidence)
        else:
            run(source, args.output_prefix, args.top_n, args.dag_id, args.task_id)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
