"""One registered query per operator, over the generated tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cestero.catalog import tables
from cestero.operators import (
    baskets,
    customers,
    mining,
    products,
    quality,
    ranking,
    summary,
    temporal,
    vertical,
    visitors,
)
from cestero.plans import job, summaries
from cestero.sinks import mining as mining_files
from cestero.sinks.delimited import write_delimited
from cestero.sinks.reports import Reports, json_records
from cestero.sinks.shared import passing_folder, passing_table, stage_table
from cestero.sources import DelimitedSource, ingest
from cestero.sources.buckets import read_customer_days, write_customer_days
from cestero.sources.incremental import load_changes, read_loaded
from cestero.sources.ingest import read_ingested, read_quarantine

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The generated tables have 64-bit keys.
ID_TYPE = "bigint"

# A lift of 1.5 selects no rule on the generated baskets.
STRONG_LIFT = 1.02

SAMPLE_SIZE = 5000


def query(function: Query) -> Query:
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts without store and basket, for queries that need neither."""
    return tables.transactions(spark, sf_dir, store=False, products=False)


def receipts_with_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.transactions(spark, sf_dir, store=False)


def exploded(spark: SparkSession, sf_dir: str, store: bool = False) -> DataFrame:
    lines = tables.receipt_lines(spark, sf_dir, store=store)
    return baskets.explode_transactions(lines, id_type=ID_TYPE)


def joined(df: DataFrame, *arrays: str) -> DataFrame:
    return df.withColumns({c: F.array_join(c, ",") for c in arrays})


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources -----------------------------------------------------------------


@query
def available_stores(spark, sf_dir):
    return baskets.available_stores(tables.transactions(spark, sf_dir, products=False))


@query
def transactions_for_stores(spark, sf_dir):
    tx = baskets.for_stores(tables.transactions(spark, sf_dir), [1, 3, 5])
    return tx.select("transaction_id", "store_id", "customer_id", "products")


@query
def transactions(spark, sf_dir):
    return tables.transactions(spark, sf_dir)


@query
def explode_transactions(spark, sf_dir):
    return baskets.explode_transactions(tables.transactions(spark, sf_dir), id_type=ID_TYPE)


def _receipt_files(spark: SparkSession, sf_dir: str, base: str) -> DelimitedSource:
    tx = tables.transactions(spark, sf_dir)
    columns = ("transaction_date", "store_id", "customer_id", "products")
    write_delimited(tx.select(*columns), f"{base}/transactions")
    return DelimitedSource(spark, base, id_type=ID_TYPE)


def _reference_files(spark: SparkSession, sf_dir: str, base: str) -> DelimitedSource:
    bridge = tables.product_categories(spark, sf_dir)
    write_delimited(bridge, f"{base}/products/ProductCategory.csv", header=True)
    write_delimited(tables.categories(spark, sf_dir), f"{base}/products/Categories.csv")
    return DelimitedSource(spark, base, id_type=ID_TYPE)


def _files(spark: SparkSession, sf_dir: str) -> DelimitedSource:
    """The three inputs, written out as delimited files."""
    base = passing_folder(spark)
    with ThreadPoolExecutor(2) as writers:
        files = (_receipt_files, _reference_files)
        written = [writers.submit(write, spark, sf_dir, base) for write in files]
    return [w.result() for w in written][0]


@query
def csv_roundtrip(spark, sf_dir):
    return _receipt_files(spark, sf_dir, passing_folder(spark)).transactions()


@query
def reference_csv_roundtrip(spark, sf_dir):
    source = _reference_files(spark, sf_dir, passing_folder(spark))
    return source.product_categories().join(source.categories(), "category_id", "left")


@query
def ingest_roundtrip(spark, sf_dir):
    source = _files(spark, sf_dir)
    target = passing_folder(spark)
    ingest(spark, source.base, target, pattern="*.csv", id_type=ID_TYPE)
    return read_ingested(spark, target, ID_TYPE)


def _damaged_files(spark: SparkSession, sf_dir: str) -> str:
    """Receipts as files, and one line that does not fit for every tenth order, of five kinds."""
    base = passing_folder(spark)
    tx = tables.transactions(spark, sf_dir)
    columns = ("transaction_date", "store_id", "customer_id", "products")
    write_delimited(tx.select(*columns), f"{base}/transactions/whole")
    order, kind = F.col("transaction_id").cast("string"), F.floor(F.col("transaction_id") / 10) % 5
    lines = {
        0: ("1997-01-01", "store", order, "1 2"),
        1: ("1997-01-01", "3", "unknown", order),
        2: ("someday", "3", "4", order),
        3: ("1997-01-01", order),
        4: ("1997-01-01", "3", "4", "1 2", order),
    }
    cells = [
        F.when(kind == k, F.concat_ws("|", *(c if c is order else F.lit(c) for c in line)))
        for k, line in lines.items()
    ]
    bad = tables.transactions(spark, sf_dir, store=False, products=False)
    bad = bad.where(F.col("transaction_id") % 10 == 0).select(F.coalesce(*cells).alias("value"))
    bad.write.text(f"{base}/transactions/damaged")
    _reference_files(spark, sf_dir, base)
    return base


def _quarantined(spark: SparkSession, sf_dir: str) -> str:
    target = passing_folder(spark)
    base = _damaged_files(spark, sf_dir)
    ingest(spark, base, target, pattern="*/part-*", id_type=ID_TYPE, quarantine=True)
    return target


@query
def rejected_rows(spark, sf_dir):
    found = read_quarantine(spark, _quarantined(spark, sf_dir))
    return found.withColumn("folder", F.element_at(F.split("file", "/"), -2)).groupBy(
        "input", "reason", "folder"
    ).agg(F.count("*").alias("n"), F.count_distinct("line").alias("lines"))


@query
def accepted_rows(spark, sf_dir):
    """What a load with quarantine keeps of receipts with damaged lines among them."""
    return read_ingested(spark, _quarantined(spark, sf_dir), ID_TYPE)


@query
def incremental_load(spark, sf_dir):
    """Receipts in two files, of which the second is first half of itself; loaded three times.

    ``reloaded`` is what the last load, of unchanged files, took: nothing.
    """
    columns = ("transaction_date", "store_id", "customer_id", "products")
    tx = tables.transactions(spark, sf_dir)
    base, target = passing_folder(spark), passing_folder(spark)
    late = F.year("transaction_date") >= 1998

    def deliver(name: str, rows: DataFrame) -> None:
        write_delimited(rows.select(*columns), f"{base}/transactions/{name}")

    def load() -> int:
        settings = {"pattern": "*/*.csv", "id_type": ID_TYPE, "drop_missing": True}
        return load_changes(spark, base, target, **settings).files

    deliver("early", tx.where(F.coalesce(~late, F.lit(True))))
    deliver("late", tx.where(late & (F.col("transaction_id") % 2 == 0)))
    load()
    deliver("late", tx.where(late))
    load()
    return read_loaded(spark, target, ID_TYPE).withColumn("reloaded", F.lit(load()))


# --- executive summary -------------------------------------------------------


@query
def basic_metrics(spark, sf_dir):
    return summary.basic_metrics(receipts_with_baskets(spark, sf_dir))


@query
def top_products(spark, sf_dir):
    return summary.top_products(exploded(spark, sf_dir))


@query
def top_customers(spark, sf_dir):
    return summary.top_customers(receipts(spark, sf_dir))


@query
def peak_days(spark, sf_dir):
    return summary.peak_days(receipts(spark, sf_dir))


@query
def top_categories(spark, sf_dir):
    return summary.top_categories(
        exploded(spark, sf_dir),
        tables.product_categories(spark, sf_dir),
        tables.categories(spark, sf_dir),
    )


@query
def executive_summary(spark, sf_dir):
    return summaries.executive_summary_rows(
        receipts(spark, sf_dir),
        tables.product_categories(spark, sf_dir),
        tables.categories(spark, sf_dir),
        exploded=exploded(spark, sf_dir),
    )


@query
def executive_summary_one_scan(spark, sf_dir):
    counts = stage_table(summary.headline_counts(receipts_with_baskets(spark, sf_dir), ID_TYPE))
    return summaries.one_scan_summary_rows(
        counts,
        tables.product_categories(spark, sf_dir),
        tables.categories(spark, sf_dir),
        id_type=ID_TYPE,
    )


@query
def executive_summary_job(spark, sf_dir):
    """The batch job from delimited files to reports, read back as rows."""
    out = passing_folder(spark)
    job.run(_files(spark, sf_dir), out)
    metrics = spark.read.schema("total_transactions bigint, total_sales_units bigint").json(
        f"{out}/summary/basic_metrics.json"
    )
    rows = metrics.select(
        F.lit("basic_metrics").alias("section"),
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(i).alias("rank"), F.lit(c).alias("key"), F.col(c).alias("value")
                    )
                    for i, c in enumerate(metrics.columns, 1)
                )
            )
        ),
    )
    keys = {
        "products": ("product_id", "total_sold"),
        "customers": ("customer_id", "total_purchases"),
        "peak_days": ("date", "num_transactions"),
        "categories": ("category_id", "total_volume"),
    }
    for name, (key, value) in keys.items():
        document = spark.read.schema(f"data array<struct<{key}: string, {value}: bigint>>").json(
            f"{out}/summary/top_10_{name}.json"
        )
        ranked = document.select(F.posexplode("data").alias("at", "row")).select(
            F.lit(job.RANKINGS[name]).alias("section"),
            (F.col("at") + 1).alias("rank"),
            F.col("row")[key].alias("key"),
            F.col("row")[value].alias("value"),
        )
        rows = rows.unionByName(ranked)
    return rows


# --- customers ---------------------------------------------------------------


@query
def purchase_frequency(spark, sf_dir):
    return customers.purchase_frequency(receipts(spark, sf_dir))


@query
def purchase_frequency_stats(spark, sf_dir):
    return customers.purchase_frequency_stats(receipts(spark, sf_dir))


@query
def purchase_frequency_histogram(spark, sf_dir):
    return customers.purchase_frequency_histogram(receipts(spark, sf_dir))


@query
def purchase_gaps(spark, sf_dir):
    return customers.purchase_gaps(receipts(spark, sf_dir))


@query
def time_between_purchases(spark, sf_dir):
    return customers.time_between_purchases(receipts(spark, sf_dir))


@query
def time_between_stats(spark, sf_dir):
    return rounded(customers.time_between_stats(receipts(spark, sf_dir)), "promedio_general")


@query
def frequency_tiers(spark, sf_dir):
    return customers.frequency_tiers(receipts(spark, sf_dir))


@query
def rfm_segmentation(spark, sf_dir):
    return customers.rfm_segmentation(receipts(spark, sf_dir))


@query
def rfm_segmentation_inverted(spark, sf_dir):
    return customers.rfm_segmentation(
        receipts(spark, sf_dir), reference_date="2002-01-01", invert_frequency=True
    )


@query
def rfm_segment_profile(spark, sf_dir):
    rfm = customers.rfm_segmentation(receipts(spark, sf_dir))
    return rounded(customers.rfm_segment_profile(rfm), "avg_recency", "avg_frequency")


@query
def rfm_preview(spark, sf_dir):
    return customers.rfm_preview(customers.rfm_segmentation(receipts(spark, sf_dir)))


@query
def customer_summary(spark, sf_dir):
    return _contents(summaries.customer_summary(receipts(spark, sf_dir)))


def _contents(frames: dict[str, DataFrame]) -> DataFrame:
    """Every row of each frame of a summary, with all columns in one text."""

    def text(name: str, kind: str):
        if kind == "double":
            return F.round(name, 6).cast("decimal(20,6)").cast("string")
        if kind.startswith("array"):
            return F.array_join(name, ",")
        return F.col(name).cast("string")

    listed = [
        frame.select(
            F.lit(section).alias("section"),
            F.concat_ws("|", *(text(name, kind) for name, kind in frame.dtypes)).alias("row"),
        )
        for section, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, listed)


def _bucketed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase days of all receipts, loaded into a table bucketed by customer."""
    table, path = passing_table(spark)
    write_customer_days(receipts(spark, sf_dir), table, path, buckets=8)
    return read_customer_days(spark, table)


@query
def purchase_gaps_bucketed(spark, sf_dir):
    return customers.gaps_between(_bucketed_days(spark, sf_dir), spread_repeats=False)


@query
def time_between_purchases_bucketed(spark, sf_dir):
    return customers.intervals_of(_bucketed_days(spark, sf_dir))


@query
def purchase_frequency_bucketed(spark, sf_dir):
    return customers.frequency_of(_bucketed_days(spark, sf_dir))


@query
def rfm_segmentation_bucketed(spark, sf_dir):
    return customers.rfm_of(customers.frequency_of(_bucketed_days(spark, sf_dir)))


@query
def order_value_deciles(spark, sf_dir):
    """Deciles of a double that hardly two orders share."""
    orders = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    value = {"decile": ranking.float_ordinal(F.col("o_totalprice"))}
    return ranking.exact_ntiles(orders, value, "o_orderkey", tiles=10, wide=True)


# --- sales over time ---------------------------------------------------------


@query
def daily_sales(spark, sf_dir):
    return temporal.daily_sales(receipts(spark, sf_dir))


@query
def daily_sales_stats(spark, sf_dir):
    return temporal.daily_sales_stats(receipts(spark, sf_dir))


@query
def weekly_sales(spark, sf_dir):
    return temporal.weekly_sales(receipts(spark, sf_dir))


@query
def weekly_sales_iso(spark, sf_dir):
    return temporal.weekly_sales(receipts(spark, sf_dir), iso_year=True)


@query
def weekly_sales_stats(spark, sf_dir):
    return temporal.weekly_sales_stats(receipts(spark, sf_dir))


@query
def monthly_sales(spark, sf_dir):
    return temporal.monthly_sales(receipts(spark, sf_dir))


@query
def monthly_sales_stats(spark, sf_dir):
    return temporal.monthly_sales_stats(receipts(spark, sf_dir))


@query
def day_of_week_sales(spark, sf_dir):
    return temporal.day_of_week_sales(receipts(spark, sf_dir))


@query
def day_of_week_extremes(spark, sf_dir):
    return temporal.day_of_week_extremes(receipts(spark, sf_dir))


@query
def sales_trend(spark, sf_dir):
    return temporal.sales_trend(receipts(spark, sf_dir))


@query
def trend_change(spark, sf_dir):
    return rounded(temporal.trend_change(receipts(spark, sf_dir)), "trend_change")


@query
def temporal_summary(spark, sf_dir):
    return _contents(summaries.temporal_summary(receipts(spark, sf_dir)))


def _daily_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of bitmaps per store, day and bucket, written once."""
    tx = tables.transactions(spark, sf_dir, products=False)
    return stage_table(visitors.daily_customers(tx, by=("store_id",)))


@query
def daily_visitors(spark, sf_dir):
    return visitors.daily_visitors(_daily_customers(spark, sf_dir))


@query
def weekly_visitors(spark, sf_dir):
    return visitors.weekly_visitors(_daily_customers(spark, sf_dir))


@query
def monthly_visitors(spark, sf_dir):
    return visitors.monthly_visitors(_daily_customers(spark, sf_dir))


@query
def monthly_visitors_per_store(spark, sf_dir):
    return visitors.monthly_visitors(_daily_customers(spark, sf_dir), by=("store_id",))


@query
def visitors_per_store(spark, sf_dir):
    return visitors.customers_by(_daily_customers(spark, sf_dir), "store_id")


# --- products and baskets ----------------------------------------------------


@query
def product_sales(spark, sf_dir):
    return products.product_sales(exploded(spark, sf_dir))


@query
def product_sales_stats(spark, sf_dir):
    return products.product_sales_stats(exploded(spark, sf_dir))


@query
def top_products_per_store(spark, sf_dir):
    return products.top_products_per_store(exploded(spark, sf_dir, store=True))


@query
def baskets_(spark, sf_dir):
    return joined(baskets.baskets(tables.transactions(spark, sf_dir)), "items")


@query
def basket_stats(spark, sf_dir):
    return baskets.basket_stats(receipts_with_baskets(spark, sf_dir))


@query
def product_combinations(spark, sf_dir):
    return joined(baskets.product_combinations(receipts_with_baskets(spark, sf_dir)), "items")


@query
def product_combinations_normalised(spark, sf_dir):
    tx = receipts_with_baskets(spark, sf_dir)
    return joined(baskets.product_combinations(tx, normalise=True), "items")


@query
def multi_item_count(spark, sf_dir):
    return baskets.multi_item_count(receipts_with_baskets(spark, sf_dir))


@query
def product_summary(spark, sf_dir):
    tx, ex = receipts_with_baskets(spark, sf_dir), exploded(spark, sf_dir, store=True)
    types = tables.type_baskets(spark, sf_dir)
    frames = summaries.product_summary(tx, ex, mining_input=types)
    mined = frames.pop("market_basket")
    frames |= {name: mined[name] for name in ("frequent_itemsets", "association_rules")}
    return _contents(frames)


# --- per store ---------------------------------------------------------------

STORE = ("store_id",)


def receipts_of_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.transactions(spark, sf_dir, products=False)


@query
def weekly_sales_per_store(spark, sf_dir):
    return temporal.weekly_sales(receipts_of_stores(spark, sf_dir), by=STORE)


@query
def monthly_sales_per_store(spark, sf_dir):
    return temporal.monthly_sales(receipts_of_stores(spark, sf_dir), by=STORE)


@query
def day_of_week_sales_per_store(spark, sf_dir):
    return temporal.day_of_week_sales(receipts_of_stores(spark, sf_dir), by=STORE)


@query
def purchase_frequency_per_store(spark, sf_dir):
    return customers.purchase_frequency(receipts_of_stores(spark, sf_dir), by=STORE)


@query
def purchase_gaps_per_store(spark, sf_dir):
    return customers.purchase_gaps(receipts_of_stores(spark, sf_dir), by=STORE)


@query
def time_between_purchases_per_store(spark, sf_dir):
    return customers.time_between_purchases(receipts_of_stores(spark, sf_dir), by=STORE)


@query
def frequency_tiers_per_store(spark, sf_dir):
    return customers.frequency_tiers(receipts_of_stores(spark, sf_dir), by=STORE)


@query
def rfm_segmentation_per_store(spark, sf_dir):
    return customers.rfm_segmentation(receipts_of_stores(spark, sf_dir), by=STORE)


@query
def sales_trend_per_store(spark, sf_dir):
    return temporal.sales_trend(receipts_of_stores(spark, sf_dir), by=STORE)


@query
def sales_trend_per_product(spark, sf_dir):
    """Units per store, product and day."""
    return temporal.sales_trend(exploded(spark, sf_dir, store=True), by=("store_id", "product_id"))


@query
def trend_change_per_store(spark, sf_dir):
    return rounded(temporal.trend_change(receipts_of_stores(spark, sf_dir), by=STORE), "trend_change")


@query
def basket_stats_per_store(spark, sf_dir):
    stats = baskets.basket_stats(tables.transactions(spark, sf_dir), by=STORE)
    return rounded(stats, "avg_basket_size")


@query
def product_combinations_per_store(spark, sf_dir):
    tx = tables.transactions(spark, sf_dir)
    return joined(baskets.product_combinations(tx, by=STORE), "items")


@query
def analytics_job(spark, sf_dir):
    """The analytics job from delimited files to series, all of them read back."""
    out, source = passing_folder(spark), _files(spark, sf_dir)
    types = tables.type_baskets(spark, sf_dir)
    written = job.run_analytics(source, out, mining_input=types)
    read = {
        name: spark.read.schema(schema).json(f"{out}/analytics/{name}.json/data")
        for name, schema in written.items()
    }
    return _contents(read)


# --- mining ------------------------------------------------------------------


def _mined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    found = summaries.market_basket(tables.type_baskets(spark, sf_dir))
    return found["frequent_itemsets"], found["association_rules"]


def _flat_rules(rules: DataFrame) -> DataFrame:
    return rounded(joined(rules, "antecedent", "consequent"), "confidence", "lift", "support")


@query
def frequent_items(spark, sf_dir):
    return mining.frequent_items(tables.type_baskets(spark, sf_dir))


@query
def frequent_itemsets(spark, sf_dir):
    return joined(_mined(spark, sf_dir)[0], "items")


def _mined_by_bitmaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sets = tables.type_baskets(spark, sf_dir)
    found = summaries.market_basket(sets, search=vertical.mine_itemsets)
    return found["frequent_itemsets"], found["association_rules"]


@query
def frequent_itemsets_by_bitmaps(spark, sf_dir):
    return joined(_mined_by_bitmaps(spark, sf_dir)[0], "items")


@query
def association_rules_by_bitmaps(spark, sf_dir):
    return _flat_rules(_mined_by_bitmaps(spark, sf_dir)[1])


def _mined_per_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = tables.type_baskets(spark, sf_dir, store=True)
    return vertical.mine_itemsets_by(sets, STORE)[0]


@query
def frequent_itemsets_per_store(spark, sf_dir):
    return joined(_mined_per_store(spark, sf_dir), "items")


@query
def association_rules_per_store(spark, sf_dir):
    sets = _mined_per_store(spark, sf_dir)
    return _flat_rules(mining.association_rules(sets, F.col("n_baskets"), by=STORE))


@query
def top_itemsets(spark, sf_dir):
    return mining.top_itemsets(joined(_mined(spark, sf_dir)[0], "items"))


@query
def association_rules(spark, sf_dir):
    return _flat_rules(_mined(spark, sf_dir)[1])


@query
def top_rules(spark, sf_dir):
    rules = _flat_rules(_mined(spark, sf_dir)[1])
    return mining.top_rules(rules)


@query
def strong_rules(spark, sf_dir):
    rules = mining.strong_rules(_mined(spark, sf_dir)[1], STRONG_LIFT)
    return _flat_rules(rules)


@query
def mining_counts(spark, sf_dir):
    return mining.mining_counts(*_mined(spark, sf_dir), STRONG_LIFT)


@query
def rules_roundtrip(spark, sf_dir):
    """A search that is stored, then asked for again with equal parameters."""
    path = passing_folder(spark)
    sets = tables.type_baskets(spark, sf_dir)
    summaries.market_basket(sets, reuse_path=path, source=sf_dir)
    again = summaries.market_basket(sets, reuse_path=path, source=sf_dir)
    return _flat_rules(again["association_rules"])


@query
def itemsets_csv_roundtrip(spark, sf_dir):
    path = passing_folder(spark)
    mining_files.write_csv(_mined(spark, sf_dir)[0], path)
    return joined(mining_files.read_itemsets_csv(spark, path), "items")


@query
def rules_csv_roundtrip(spark, sf_dir):
    path = passing_folder(spark)
    mining_files.write_csv(_mined(spark, sf_dir)[1], path)
    return _flat_rules(mining_files.read_rules_csv(spark, path))


# --- reports, written and read back ------------------------------------------


@query
def json_records_roundtrip(spark, sf_dir):
    path = passing_folder(spark)
    frame = temporal.daily_sales(receipts(spark, sf_dir))
    json_records(frame).write.text(path)
    return spark.read.schema(frame.schema).json(path)


@query
def report_summary_metrics(spark, sf_dir):
    metrics = summary.basic_metrics(receipts_with_baskets(spark, sf_dir))
    path = Reports(passing_folder(spark)).summary_metrics(metrics)
    return spark.read.schema(metrics.schema).json(path)


@query
def report_top_items(spark, sf_dir):
    ranking = top_categories(spark, sf_dir)
    path = Reports(passing_folder(spark)).top_items(ranking, "categories", 10)
    row = ranking.schema.simpleString()
    document = spark.read.schema(f"type string, top_n int, data array<{row}>").json(path)
    return document.select(
        "type", "top_n", F.posexplode("data").alias("position", "row")
    ).select("type", "top_n", (F.col("position") + 1).alias("position"), "row.*")


@query
def report_time_series(spark, sf_dir):
    frame = temporal.daily_sales(receipts(spark, sf_dir))
    path = Reports(passing_folder(spark)).time_series(
        frame, "daily_sales", "date", "num_transacciones"
    )
    manifest = spark.read.schema("series_name string, value_column string").json(
        f"{path}/manifest"
    )
    return spark.read.schema(frame.schema).json(f"{path}/data").select(
        "*",
        manifest.select("series_name").scalar().alias("series_name"),
        manifest.select("value_column").scalar().alias("value_column"),
    )


@query
def report_distribution(spark, sf_dir):
    frame = customers.purchase_frequency_histogram(receipts(spark, sf_dir))
    path = Reports(passing_folder(spark)).distribution(frame, "purchase_frequency")
    return spark.read.schema(frame.schema).json(f"{path}/data")


@query
def report_matrix(spark, sf_dir):
    """Receipts per weekday and month as a matrix in long form."""
    cells = (
        temporal.per_day(receipts(spark, sf_dir))
        .groupBy(F.dayofweek("date").alias("row"), F.month("date").alias("col"))
        .agg(F.sum("num_transacciones").alias("value"))
    )
    path = Reports(passing_folder(spark)).matrix(cells)
    return spark.read.schema(cells.schema).json(f"{path}/data")


@query
def report_clusters(spark, sf_dir):
    """Purchase counts as clusters: every assignment with its profile, and the totals."""
    counts = customers.purchase_frequency(receipts(spark, sf_dir))
    assignments = counts.select("customer_id", F.col("num_compras").alias("cluster"))
    profiles = assignments.groupBy("cluster").agg(F.count("*").alias("num_clientes"))
    reports = Reports(passing_folder(spark))
    members, profile = reports.clusters(assignments, profiles, n_clusters=profiles.count())
    totals = spark.read.schema("n_clusters int, total_customers bigint").json(
        f"{members}/manifest"
    )
    shown = spark.read.schema(assignments.schema).json(f"{members}/data")
    described = spark.read.schema(profiles.schema).json(f"{profile}/data")
    return shown.join(described, "cluster").select(
        "*",
        totals.select("n_clusters").scalar().alias("n_clusters"),
        totals.select("total_customers").scalar().alias("total_customers"),
    )


@query
def report_recommendations(spark, sf_dir):
    rules = _mined(spark, sf_dir)[1]
    path = Reports(passing_folder(spark)).recommendations(rules)
    return _flat_rules(spark.read.schema(rules.schema).json(f"{path}/data"))


@query
def report_run_metadata(spark, sf_dir):
    metrics = summary.basic_metrics(receipts_with_baskets(spark, sf_dir))
    info = {c: metrics.select(c).scalar() for c in metrics.columns} | {"status": "success"}
    path = Reports(passing_folder(spark)).run_metadata(spark, "daily", "summary", info)
    return spark.read.schema(
        "dag_id string, task_id string, status string, "
        "total_transactions bigint, total_sales_units bigint"
    ).json(path)


# --- checks, stores and samples ----------------------------------------------


@query
def category_report(spark, sf_dir):
    return quality.category_report(
        tables.product_categories(spark, sf_dir), tables.categories(spark, sf_dir)
    )


@query
def unknown_categories(spark, sf_dir):
    return quality.unknown_categories(
        tables.product_categories(spark, sf_dir), tables.categories(spark, sf_dir)
    )


@query
def uncategorised_products(spark, sf_dir):
    counts = products.product_sales(exploded(spark, sf_dir))
    return quality.uncategorised_products(counts, tables.product_categories(spark, sf_dir))


@query
def transaction_quality(spark, sf_dir):
    return quality.transaction_quality(tables.transactions(spark, sf_dir), ID_TYPE)


@query
def store_summary(spark, sf_dir):
    return rounded(quality.store_summary(tables.transactions(spark, sf_dir)), "avg_basket_size")


@query
def daily_sales_per_store(spark, sf_dir):
    """Written as CSV with a folder per store, and read back."""
    daily = quality.daily_sales_per_store(tables.transactions(spark, sf_dir, products=False))
    path = passing_folder(spark)
    quality.write_per_store(daily, path)
    return spark.read.schema(daily.schema).option("header", True).csv(path)


@query
def sample_summary(spark, sf_dir):
    sample = quality.sample_transactions(
        receipts(spark, sf_dir), max_records=SAMPLE_SIZE, order_by=["transaction_id"]
    )
    return temporal.daily_sales(sample)
