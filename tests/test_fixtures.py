"""Planted inputs for the cases the generated tables lack."""

from datetime import date

import pytest

from cestero.operators import baskets, customers, products, quality, summary, temporal
from cestero.plans import summaries


def values(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture
def dirty(receipts):
    return receipts(
        [
            ("2024-12-30", 1, 10, "1 2 3"),
            ("2024-12-31", 1, 10, " 1  2 "),
            ("2025-01-01", 2, 11, ""),
            ("2025-01-02", 2, 12, None),
            ("bad", 1, 13, "1 1"),
        ]
    )


def test_dirty_baskets(dirty):
    assert values(summary.basic_metrics(dirty)) == [(5, 9)]
    exploded = baskets.explode_transactions(dirty)
    assert exploded.count() == 9
    assert exploded.where("product_id IS NULL").count() == 2
    assert baskets.explode_transactions(dirty, clean=True).count() == 7
    assert exploded.columns == ["transaction_date", "store_id", "customer_id", "product_id"]


def test_basket_sizes_leave_out_null_baskets(dirty):
    assert values(baskets.basket_stats(dirty)) == [(5, 9 / 4, 1, 3)]
    assert values(baskets.multi_item_count(dirty)) == [(3,)]


def test_wide_ids_need_the_wide_type(receipts):
    tx = receipts([("2024-01-01", 1, 1, "7 30000000000 x")])
    narrow = [r.product_id for r in baskets.explode_transactions(tx).collect()]
    wide = [r.product_id for r in baskets.explode_transactions(tx, id_type="bigint").collect()]
    assert narrow == [7, None, None]
    assert wide == [7, 30000000000, None]


def test_weeks_at_the_turn_of_the_year(dirty):
    found = {(r.year, r.week): r.num_transacciones for r in temporal.weekly_sales(dirty).collect()}
    assert found == {(2024, 1): 2, (2025, 1): 2, (None, None): 1}
    iso = temporal.weekly_sales(dirty, iso_year=True).collect()
    assert {(r.year, r.week): r.num_transacciones for r in iso} == {
        (2025, 1): 4,
        (None, None): 1,
    }


def test_category_fan_out(spark):
    ex = spark.createDataFrame(
        [(1,), (1,), (2,), (3,)], "product_id int"
    )
    bridge = spark.createDataFrame([(1, 1), (1, 2), (3, 99)], "product_id int, category_id int")
    names = spark.createDataFrame([(1, "A"), (2, "B")], "category_id int, category_name string")
    expected = {(1, "A", 2), (2, "B", 2), (99, None, 1), (None, None, 1)}
    assert set(values(summary.top_categories(ex, bridge, names))) == expected


def test_repeated_reference_rows_count_as_often(spark):
    ex = spark.createDataFrame([(1,), (1,), (2,)], "product_id int")
    bridge = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "product_id int, category_id int")
    names = spark.createDataFrame(
        [(1, "A"), (1, "A"), (1, "B")], "category_id int, category_name string"
    )
    plain = ex.join(bridge, "product_id", "left").join(names, "category_id", "left")
    expected = plain.groupBy("category_id", "category_name").count()
    assert set(values(summary.top_categories(ex, bridge, names))) == set(values(expected))


def test_gaps(receipts):
    days = ["2024-01-01", "2024-01-01", "2024-01-08", "2024-01-23"]
    tx = receipts([(d, 1, 10, "1") for d in days] + [("2024-01-05", 1, 11, "1")])
    gaps = sorted(r.days_between for r in customers.purchase_gaps(tx).collect())
    assert gaps == [0, 7, 15]
    [row] = customers.time_between_purchases(tx).collect()
    assert (row.customer_id, row.min_dias, row.max_dias, row.num_intervalos) == (10, 0, 15, 3)
    assert row.promedio_dias_entre_compras == 22 / 3
    assert values(customers.frequency_tiers(tx)) == [("Frecuente (8-15 días)", 1)]


@pytest.mark.parametrize(
    ("days", "label"),
    [
        (7, "Muy Frecuente (≤7 días)"),
        (15, "Frecuente (8-15 días)"),
        (30, "Regular (16-30 días)"),
        (60, "Ocasional (31-60 días)"),
        (61, "Esporádico (>60 días)"),
    ],
)
def test_tiers_include_their_limit(spark, receipts, days, label):
    later = date.fromordinal(date(2024, 1, 1).toordinal() + days).isoformat()
    tx = receipts([("2024-01-01", 1, 1, "1"), (later, 1, 1, "1")])
    assert values(customers.frequency_tiers(tx)) == [(label, 1)]


@pytest.fixture
def four_customers(receipts):
    rows = []
    for customer, (last, count) in enumerate([(4, 4), (3, 3), (2, 2), (1, 1)], 1):
        rows += [(f"2024-01-0{last}", 1, customer, "1")] * count
    return receipts(rows)


def test_rfm_segments(four_customers):
    rfm = {r.customer_id: r for r in customers.rfm_segmentation(four_customers).collect()}
    assert [(rfm[c].recency, rfm[c].frequency) for c in (1, 2, 3, 4)] == [
        (1, 4), (2, 3), (3, 2), (4, 1),
    ]
    assert [(rfm[c].R_score, rfm[c].F_score, rfm[c].RFM_segment) for c in (1, 2, 3, 4)] == [
        (4, 1, "Promising"),
        (3, 2, "Potential Loyalists"),
        (2, 3, "Regular"),
        (1, 4, "At Risk"),
    ]


def test_rfm_with_frequency_inverted(four_customers):
    rfm = customers.rfm_segmentation(four_customers, invert_frequency=True).collect()
    assert {r.customer_id: r.RFM_segment for r in rfm} == {
        1: "Champions", 2: "Loyal Customers", 3: "Lost", 4: "Lost",
    }


def test_rfm_reference_date(four_customers):
    rfm = customers.rfm_segmentation(four_customers, reference_date="2024-02-01").collect()
    assert {r.customer_id: r.recency for r in rfm} == {1: 28, 2: 29, 3: 30, 4: 31}


@pytest.fixture
def growing(receipts):
    days = [f"2024-01-{d:02d}" for d in range(1, 22)]
    counts = [10] * 14 + [20] * 7
    return receipts([(d, 1, 1, "1") for d, n in zip(days, counts) for _ in range(n)])


def test_trend(growing):
    assert values(temporal.trend_change(growing)) == [(10.0, 20.0, 100.0, "CRECIENTE")]
    trend = {r.date.day: r.moving_avg_7d for r in temporal.sales_trend(growing).collect()}
    assert trend[14] == 10
    assert trend[15] == pytest.approx(80 / 7)


def test_moving_average_counts_rows_and_not_days(receipts):
    tx = receipts(
        [("2024-01-01", 1, 1, "1")] * 1
        + [("2024-01-02", 1, 1, "1")] * 2
        + [("2024-01-10", 1, 1, "1")] * 6
    )
    assert [r.moving_avg_7d for r in temporal.sales_trend(tx).collect()] == [1, 1.5, 3]


def test_weekday_extremes_take_the_first_of_equals(receipts):
    # A Monday and a Sunday with two each, a Saturday and a Tuesday with one.
    days = ["2024-01-01"] * 2 + ["2024-01-07"] * 2 + ["2024-01-06", "2024-01-02"]
    tx = receipts([(d, 1, 1, "1") for d in days])
    assert values(temporal.day_of_week_extremes(tx)) == [("Sunday", 2, "Tuesday", 1)]


def test_combinations_keep_order_unless_normalised(receipts):
    tx = receipts([("2024-01-01", 1, 1, b) for b in ["1 2", "2 1", "1 2", "1 2 1", "3", None]])
    exact = {tuple(r["items"]): r.frequency for r in baskets.product_combinations(tx).collect()}
    assert exact == {("1", "2"): 2, ("2", "1"): 1, ("1", "2", "1"): 1}
    sets = baskets.product_combinations(tx, normalise=True).collect()
    assert {tuple(r["items"]): r.frequency for r in sets} == {("1", "2"): 4}


def test_stores(dirty, spark):
    chosen = spark.createDataFrame([(2,), (2,), (7,)], "store_id int")
    found = baskets.for_stores(dirty, chosen)
    assert (found.count(), found.columns) == (2, dirty.columns)
    assert values(baskets.available_stores(dirty)) == [(1,), (2,)]
    assert baskets.for_stores(dirty, None).count() == 5
    assert baskets.for_stores(dirty, []).count() == 0
    assert baskets.for_stores(dirty, ["2"]).count() == 2


def test_quality(receipts):
    tx = receipts(
        [
            ("2024-01-01", 1, 1, "1 2"),
            ("2024-01-01", 1, 1, "1 2"),
            ("2024-01-01", 1, 1, "x  2"),
            ("2024-01-01", 1, 1, "x  2"),
            (None, None, 2, ""),
            ("2024-01-02", 1, None, None),
        ]
    )
    [row] = quality.transaction_quality(tx).collect()
    assert row.asDict() == {
        "total_transactions": 6,
        "null_transaction_date": 1,
        "null_store_id": 1,
        "null_customer_id": 1,
        "null_products": 1,
        "empty_products": 1,
        "double_space_products": 2,
        "bad_tokens": 2,
        "duplicate_transactions": 2,
    }


def test_presentation_order(receipts):
    tx = receipts([("2024-01-01", 1, c, "5 5 6") for c in (3, 2, 2)])
    assert [r[0] for r in customers.purchase_frequency(tx, ordered=True).collect()] == [2, 3]
    exploded = baskets.explode_transactions(tx)
    assert values(products.product_sales(exploded, ordered=True)) == [(5, 6), (6, 3)]


def test_empty_input(receipts, spark):
    tx = receipts([])
    ex = baskets.explode_transactions(tx)
    bridge = spark.createDataFrame([], "product_id int, category_id int")
    names = spark.createDataFrame([], "category_id int, category_name string")
    assert values(summary.basic_metrics(tx)) == [(0, 0)]
    frames = summaries.executive_summary(tx, bridge, names)
    frames |= summaries.temporal_summary(tx) | summaries.customer_summary(tx)
    frames |= summaries.product_summary(tx, ex, run_market_basket=False)
    frames.pop("market_basket")
    frames.pop("basic_metrics")
    assert {name: df.count() for name, df in frames.items()} == dict.fromkeys(frames, 0)
    assert values(temporal.trend_change(tx)) == [(None, None, None, None)]
    assert customers.purchase_gaps(tx).count() == 0
    assert customers.frequency_tiers(tx).count() == 0
    assert values(quality.transaction_quality(tx)) == [(0,) * 9]


def test_dirty_receipts_are_counted_as_they_are(receipts):
    tx = receipts(
        [
            ("2024-01-01", 1, 10, "1 x 2"),
            ("2024-01-01", 1, 10, "1 x 2"),
            (None, None, 11, " 1  2 "),
            ("2024-01-02", 2, None, ""),
            ("2024-01-02", 2, 12, None),
        ]
    )
    [row] = quality.transaction_quality(tx).collect()
    assert row.asDict() == {
        "total_transactions": 5,
        "null_transaction_date": 1,
        "null_store_id": 1,
        "null_customer_id": 1,
        "null_products": 1,
        "empty_products": 1,
        "double_space_products": 1,
        "bad_tokens": 2,
        "duplicate_transactions": 1,
    }


def test_samples_have_to_be_repeatable(receipts):
    tx = receipts([(f"2024-01-{d:02}", d % 3, d, "1") for d in range(1, 29)])
    with pytest.raises(ValueError, match="order"):
        quality.sample_transactions(tx, max_records=3)
    with pytest.raises(ValueError, match="seed"):
        quality.sample_transactions(tx, fraction=0.5)
    order = quality.in_hash_order(tx)
    first = quality.sample_transactions(tx, 5, order_by=order).collect()
    again = quality.sample_transactions(tx.repartition(7), 5, order_by=order).collect()
    assert first == again and len({r.store_id for r in first}) > 1


def test_no_store_is_an_error(receipts):
    with pytest.raises(ValueError, match="no store"):
        baskets.require_stores(receipts([]))
