"""Different customers from bitmaps against counting them."""

import pytest
from pyspark.sql import functions as F

from cestero.operators import visitors
from cestero.sinks.shared import stage_table
from plans import executed_plan


@pytest.fixture(scope="module")
def receipts_of_years(spark):
    """Ids of both signs and many sizes, a customer and a store with a third of all receipts, nulls."""
    ids = (
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 41 == 0, None)
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(1 << 34)) % (1 + F.col("id") % 997) * (F.col("id") % 5 - 2))
    )
    return spark.range(20_000, numPartitions=6).select(
        F.when(F.col("id") % 50 == 0, "never")
        .otherwise(F.date_add(F.lit("2023-12-20").cast("date"), (F.col("id") % 400).cast("int")).cast("string"))
        .alias("transaction_date"),
        F.when(F.col("id") % 7 < 3, 1).when(F.col("id") % 83 == 0, None).otherwise(F.col("id") % 9).alias("store_id"),
        ids.alias("customer_id"),
        F.lit(None).cast("string").alias("products"),
    )


@pytest.fixture(scope="module")
def daily(receipts_of_years):
    return stage_table(visitors.daily_customers(receipts_of_years, by=("store_id",)))


def counted(tx, *keys):
    dated = tx.withColumn("date", F.col("transaction_date").try_cast("date"))
    return dated.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("customer_id").alias("c"))


def same(got, want):
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_days_weeks_months_and_stores(receipts_of_years, daily):
    tx, store = receipts_of_years, ("store_id",)
    year, week, month = F.year("date"), F.weekofyear("date"), F.month("date")
    same(visitors.daily_visitors(daily), counted(tx, "date"))
    same(visitors.daily_visitors(daily, store), counted(tx, "store_id", "date"))
    same(visitors.weekly_visitors(daily), counted(tx, year, week))
    iso = F.extract(F.lit("YEAROFWEEK"), "date")
    same(visitors.weekly_visitors(daily, store, iso_year=True), counted(tx, "store_id", iso, week))
    same(visitors.monthly_visitors(daily), counted(tx, year, month))
    same(visitors.customers_by(daily, "store_id"), counted(tx, "store_id"))
    same(visitors.customers_by(daily), counted(tx))


def test_periods_read_the_table_and_not_the_receipts(daily):
    plan = "\n".join(executed_plan(visitors.monthly_visitors(daily)))
    assert plan.count("FileScan") == 1 and "clientes" in plan and "customer_id" not in plan


def test_a_new_day_adds_to_the_table(receipts_of_years):
    first = receipts_of_years.where("transaction_date < '2024-06-01'")
    rest = receipts_of_years.where("NOT transaction_date < '2024-06-01'")
    parts = visitors.daily_customers(first).unionByName(visitors.daily_customers(rest))
    same(visitors.monthly_visitors(parts), visitors.monthly_visitors(visitors.daily_customers(receipts_of_years)))


def test_no_receipts(receipts_of_years):
    assert visitors.monthly_visitors(visitors.daily_customers(receipts_of_years.limit(0))).isEmpty()
