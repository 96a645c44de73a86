"""Figures for each store by itself are those of the store's receipts alone."""

import pytest
from pyspark.sql import functions as F

from cestero.operators import customers, temporal
from plans import executed_plan

STORE = ("store_id",)


@pytest.fixture(scope="module")
def tx(spark):
    """Customers who buy in several stores, and a store with most of the receipts; one of three days."""
    h = F.xxhash64("id")
    days = F.when(F.col("id") % 11 == 0, F.pmod(h, F.lit(3))).otherwise(F.pmod(h, F.lit(1500)))
    store = F.when(F.col("id") % 5 < 3, 1).when(F.col("id") % 11 == 0, 2).when(F.col("id") % 61 == 0, None)
    return spark.range(5000, numPartitions=4).select(
        F.when(F.col("id") % 71 == 0, "never")
        .otherwise(F.date_add(F.lit("2021-12-01").cast("date"), days.cast("int")).cast("string"))
        .alias("transaction_date"),
        store.otherwise(F.pmod(F.shiftright(h, 7), F.lit(6)) + 3).cast("int").alias("store_id"),
        F.pmod(F.shiftright(h, 23), F.lit(150)).cast("int").alias("customer_id"),
    ).cache()


def of_each_store(tx, operator):
    rows = []
    for (store,) in tx.select("store_id").distinct().collect():
        own = tx.where(F.col("store_id").eqNullSafe(F.lit(store)))
        rows += [(store, *row) for row in map(tuple, operator(own).collect())]
    return sorted(rows, key=str)


@pytest.mark.parametrize(
    "operator",
    [
        customers.purchase_gaps,
        customers.time_between_purchases,
        customers.frequency_tiers,
        customers.rfm_segmentation,
        temporal.sales_trend,
        temporal.trend_change,
    ],
    ids=lambda f: f.__name__,
)
def test_stores_by_themselves(tx, operator):
    got = operator(tx, by=STORE)
    assert got.columns[0] == "store_id"
    assert sorted(map(tuple, got.collect()), key=str) == of_each_store(tx, operator)


def test_rfm_of_a_fixed_day(tx):
    def operator(rows, **by):
        return customers.rfm_segmentation(rows, "2026-01-01", invert_frequency=True, **by)

    assert sorted(map(tuple, operator(tx, by=STORE).collect()), key=str) == of_each_store(tx, operator)


def test_a_moving_average_in_small_blocks(tx, monkeypatch):
    want = of_each_store(tx, temporal.sales_trend)
    for size in (7, 8, 50):
        monkeypatch.setattr(temporal, "_BLOCK", size)
        got = temporal.sales_trend(tx, by=STORE).collect()
        assert sorted(map(tuple, got), key=str) == want


def test_the_days_of_all_stores_are_numbered_in_order(tx):
    daily = temporal.per_day(tx)
    numbered = temporal.numbered_days(daily).collect()
    dates = [r.date for r in sorted(numbered, key=lambda r: r.number)]
    assert dates[0] is None and dates[1:] == sorted(dates[1:])
    assert [r.number for r in sorted(numbered, key=lambda r: r.number)] == list(range(len(dates)))
    assert {r.total for r in numbered} == {len(dates)}
    averages = temporal.moving_average(daily, ()).collect()
    assert sorted(averages, key=str) == sorted(temporal.sales_trend(tx).collect(), key=str)


def test_no_window_has_all_days_of_a_store(tx):
    plan = executed_plan(temporal.sales_trend(tx, by=STORE))
    windows = [line for line in plan if "Window [" in line]
    assert windows and all("year#" in line or "block#" in line for line in windows)
    assert not any("SinglePartition" in line for line in plan)
