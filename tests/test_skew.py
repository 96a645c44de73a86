"""One key with a third of all rows, and sums that must agree."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cestero.catalog import tables
from cestero.operators import baskets, customers, products, summary, temporal


@pytest.fixture(scope="module")
def skewed(spark):
    """Customer 1, store 1, product 1 and the first day hold a third each."""
    chance = random.Random(3)
    first = date(2024, 1, 1)

    def pick(hot, others):
        return hot if chance.random() < 0.34 else chance.choice(others)

    rows = []
    for _ in range(3000):
        day = first + timedelta(days=pick(0, range(1, 90)))
        items = [pick(1, range(2, 50)) for _ in range(chance.randint(1, 4))]
        text = None if chance.random() < 0.02 else " ".join(map(str, items))
        when = None if chance.random() < 0.02 else day
        rows.append((when, pick(1, range(2, 9)), pick(1, range(2, 400)), text))
    schema = "transaction_date date, store_id int, customer_id int, products string"
    return spark.createDataFrame(rows, schema).cache()


def test_gaps_equal_a_window_over_all_receipts(skewed, monkeypatch):
    monkeypatch.setattr(customers, "_REPEATS_PER_TASK_ROW", 7)
    by_day = Window.partitionBy("customer_id").orderBy("transaction_date")
    plain = (
        skewed.withColumn("prev_date", F.lag("transaction_date").over(by_day))
        .withColumn("days_between", F.date_diff("transaction_date", "prev_date"))
        .where("days_between IS NOT NULL")
        .select("customer_id", "prev_date", F.col("transaction_date").alias("date"), "days_between")
    )
    ours = customers.purchase_gaps(skewed)
    assert ours.exceptAll(plain).count() == 0
    assert plain.exceptAll(ours).count() == 0

    stats = plain.groupBy("customer_id").agg(
        F.avg("days_between").alias("promedio_dias_entre_compras"),
        F.min("days_between").alias("min_dias"),
        F.max("days_between").alias("max_dias"),
        F.count("*").alias("num_intervalos"),
    )
    between = customers.time_between_purchases(skewed).select(stats.columns)
    assert sorted(map(tuple, between.collect())) == sorted(map(tuple, stats.collect()))


def test_rfm_equals_windows_over_all_customers(skewed):
    rfm = customers.rfm_segmentation(skewed)
    recency = Window.orderBy(F.asc_nulls_first("recency"), "customer_id")
    frequency = Window.orderBy(F.desc("frequency"), "customer_id")
    wrong = rfm.where(
        "R_score IS NULL OR F_score IS NULL OR RFM_segment IS NULL"
    ).count()
    compared = rfm.select(
        "R_score", "F_score",
        (5 - F.ntile(4).over(recency)).alias("r"),
        F.ntile(4).over(frequency).alias("f"),
    )
    assert wrong == 0
    assert compared.where("R_score <> r OR F_score <> f").count() == 0


def test_top_products_per_store(skewed):
    ex = baskets.explode_transactions(skewed)
    counts = {}
    for r in ex.collect():
        key = (r.store_id, r.product_id)
        counts[key] = counts.get(key, 0) + 1
    expected = set()
    for store in {s for s, _ in counts}:
        best = sorted(((-n, p) for (s, p), n in counts.items() if s == store))[:5]
        expected |= {(store, p, -n, i) for i, (n, p) in enumerate(best, 1)}
    assert {tuple(r) for r in products.top_products_per_store(ex, 5).collect()} == expected


def test_sums_over_time_are_all_receipts(spark, skewed):
    total, units = summary.basic_metrics(skewed).first()
    assert total == 3000
    for frame in (
        temporal.daily_sales,
        temporal.weekly_sales,
        temporal.monthly_sales,
        temporal.day_of_week_sales,
        temporal.sales_trend,
    ):
        assert frame(skewed).agg(F.sum("num_transacciones")).first()[0] == total
    ex = baskets.explode_transactions(skewed)
    assert products.product_sales(ex).agg(F.sum("num_ventas")).first()[0] == units


def test_leaving_tables_out_changes_no_receipt(spark, sf_dir):
    whole = tables.transactions(spark, sf_dir)
    columns = ["transaction_id", "transaction_date", "customer_id"]
    lean = tables.transactions(spark, sf_dir, store=False, products=False)
    assert sorted(whole.select(columns).collect()) == sorted(lean.select(columns).collect())


def test_receipts_in_pieces_explode_to_the_same_rows(spark, sf_dir):
    whole = baskets.explode_transactions(tables.transactions(spark, sf_dir), id_type="bigint")
    pieces = baskets.explode_transactions(tables.receipt_lines(spark, sf_dir), id_type="bigint")
    assert whole.exceptAll(pieces).count() == 0
    assert pieces.exceptAll(whole).count() == 0
