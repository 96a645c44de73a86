"""The table of purchase days that is bucketed by customer."""

import uuid

import pytest
from pyspark.sql import functions as F

from cestero.operators import customers
from cestero.sinks.shared import passing_table
from cestero.sources import ingest
from cestero.sources.buckets import read_customer_days, write_customer_days
from plans import executed_plan


@pytest.fixture(scope="module")
def tx(spark):
    """A customer with a third of all receipts, one without a number, days without a date."""
    h = F.xxhash64("id")
    return spark.range(6000, numPartitions=5).select(
        F.when(F.col("id") % 97 == 0, "never")
        .otherwise(F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(h, F.lit(700)).cast("int")).cast("string"))
        .alias("transaction_date"),
        F.pmod(F.shiftright(h, 9), F.lit(4)).cast("int").alias("store_id"),
        F.when(F.col("id") % 3 == 0, 5)
        .when(F.col("id") % 89 == 0, None)
        .otherwise(F.pmod(F.shiftright(h, 20), F.lit(400)))
        .cast("int")
        .alias("customer_id"),
        F.lit("1 2").alias("products"),
    )


@pytest.fixture(scope="module")
def days(spark, tx):
    table, path = passing_table(spark)
    write_customer_days(tx, table, path, buckets=6)
    return read_customer_days(spark, table)


def same(got, want):
    assert got.columns == want.columns
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_rows_are_those_from_receipts(tx, days):
    same(customers.gaps_between(days, spread_repeats=False), customers.purchase_gaps(tx))
    same(customers.intervals_of(days), customers.time_between_purchases(tx))
    dated = tx.withColumn("transaction_date", F.col("transaction_date").try_cast("date"))
    same(customers.frequency_of(days), customers.purchase_frequency(dated))
    same(customers.rfm_of(customers.frequency_of(days)), customers.rfm_segmentation(tx))


@pytest.mark.parametrize(
    "of", [lambda d: customers.gaps_between(d, spread_repeats=False), customers.intervals_of, customers.frequency_of]
)
def test_nothing_is_shuffled(days, of):
    plan = executed_plan(of(days))
    assert not [line for line in plan if "Exchange" in line]
    assert any("FileScan" in line for line in plan)


def test_a_customer_of_many_receipts_has_a_row_a_day(tx, days):
    assert tx.where("customer_id = 5").count() > 1900
    assert days.where("customer_id = 5").count() <= 701


def test_a_load_fills_the_table(spark, tx, tmp_path):
    (tmp_path / "products").mkdir()
    (tmp_path / "products/Categories.csv").write_text("1|FRUTA\n")
    (tmp_path / "products/ProductCategory.csv").write_text("product|category\n1|1\n")
    tx.coalesce(2).write.option("sep", "|").csv(f"{tmp_path}/transactions")
    table = f"days_{uuid.uuid4().hex}"
    try:
        for _ in range(2):
            ingest(spark, str(tmp_path), f"{tmp_path}/tables", pattern="*.csv", customer_days=table, buckets=3)
        same(read_customer_days(spark, table), customers.purchase_days(tx))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
