"""The analytics job reads receipts a few times, and its frames are those of the operators."""

import pytest
from pyspark.sql import functions as F

from cestero.catalog import tables
from cestero.operators import products
from cestero.operators.baskets import explode_transactions
from cestero.plans import job, summaries
from cestero.sinks.shared import staging
from plans import executed_plan


@pytest.fixture(scope="module")
def tx(spark):
    """Customers of several stores, some on one day; receipts without store, customer, day or basket."""
    h = F.xxhash64("id")
    id_ = F.col("id")
    return spark.range(2000, numPartitions=4).select(
        F.when(id_ % 71 == 0, None)
        .otherwise(F.date_add(F.lit("2021-12-01").cast("date"), F.pmod(h, F.lit(400)).cast("int")))
        .alias("transaction_date"),
        F.when(id_ % 61 != 0, F.pmod(F.shiftright(h, 7), F.lit(5))).cast("int").alias("store_id"),
        F.when(id_ % 53 != 0, F.pmod(F.shiftright(h, 23), F.lit(90))).cast("int").alias("customer_id"),
        F.when(id_ % 47 != 0, F.concat_ws(" ", F.pmod(h, F.lit(7)), F.pmod(F.shiftright(h, 9), F.lit(30))))
        .alias("products"),
    )


def rows(frame):
    return sorted(map(str, frame.select(F.to_json(F.struct(*frame.columns))).collect()))


def test_shared_tables_give_what_the_operators_give(spark, tx):
    with staging(spark) as stage:
        stored = stage(tx)
        exploded = explode_transactions(stored)
        found = dict(job.analytics_frames(stored, exploded, 0.05, stage=stage))
        files = set(stored.inputFiles())
        reading = {name for name, frame in found.items() if files & set(frame.inputFiles())}
        # All but the patterns and the rankings of products scanned the receipts before.
        assert reading == {"daily", "combinations", "combinations_per_store"}

        want = summaries.temporal_summary(stored) | summaries.customer_summary(stored)
        want |= summaries.product_summary(stored, exploded, True, 0.05)
        mined = want.pop("market_basket")
        want |= {name: mined[name] for name in ("frequent_itemsets", "association_rules")}
        want |= summaries.store_summaries(stored, want["store_products"])
        assert set(found) == set(want)
        for name, frame in want.items():
            assert found[name].dtypes == frame.dtypes, name
            assert rows(found[name]) == rows(frame), name


@pytest.mark.parametrize("n", [1, 3, 10, 100])
def test_best_sellers_of_stored_sales(spark, n):
    """Many equal numbers, stores with fewer than n products, one without a number."""
    sales = spark.range(400).select(
        F.when(F.col("id") % 9 > 0, F.col("id") % 4).alias("store_id"),
        F.when(F.col("id") != 8, F.col("id")).alias("product_id"),
        (F.col("id") % 6 + 1).alias("num_ventas"),
    )
    sales = sales.union(spark.sql("SELECT 77L, 1L, 2L"))
    assert products.best_of_stored(sales, n).collect() == products.best_per_store(sales, n).collect()


@pytest.mark.parametrize("listed", [tables.basket_texts, tables.type_baskets])
def test_lines_are_listed_where_an_order_has_come_together(spark, sf_dir, listed):
    plan = executed_plan(listed(spark, sf_dir))
    first = next(i for i, line in enumerate(plan) if "partial_collect" in line)
    assert any("hashpartitioning(l_orderkey" in line for line in plan[first:])
