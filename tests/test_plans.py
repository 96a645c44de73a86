"""Plans that have to hold at any size of input."""

import pytest

from cestero.catalog.queries import QUERIES
from cestero.operators.quality import transaction_quality
from plans import executed_plan


def lines_with(plan, text):
    return [line for line in plan if text in line]


@pytest.mark.parametrize("name", ["top_products", "top_customers", "peak_days", "top_categories"])
def test_rankings_keep_n_rows_per_task(spark, sf_dir, name):
    plan = executed_plan(QUERIES[name](spark, sf_dir))
    assert lines_with(plan, "TakeOrderedAndProject")
    assert not lines_with(plan, "rangepartitioning")


def test_rankings_per_store_are_cut_before_the_shuffle(spark, sf_dir):
    plan = executed_plan(QUERIES["top_products_per_store"](spark, sf_dir))
    limits = lines_with(plan, "WindowGroupLimit")
    assert any("Partial" in line for line in limits) and any("Final" in line for line in limits)


def test_executive_summary_reads_each_column_once(spark, sf_dir):
    plan = executed_plan(QUERIES["executive_summary"](spark, sf_dir))
    scans = lines_with(plan, "FileScan")
    # Order dates, customers, and orders with lines for the products; then the
    # products twice, for the bridge and for the names.
    assert len(scans) == 6
    assert len(lines_with(plan, "ReusedExchange")) == 3


def test_categories_are_joined_to_products_and_not_to_lines(spark, sf_dir):
    plan = executed_plan(QUERIES["top_categories"](spark, sf_dir))
    join = next(i for i, line in enumerate(plan) if "product_id" in line and "Join" in line)
    assert "HashAggregate(keys=[product_id" in plan[join + 1]


@pytest.mark.parametrize("name", ["weekly_sales", "monthly_sales", "day_of_week_sales"])
def test_receipts_are_counted_per_day_first(spark, sf_dir, name):
    plan = executed_plan(QUERIES[name](spark, sf_dir))
    counts = [line for line in plan if "partial_count(1)" in line]
    assert len(counts) == 1 and "keys=[date" in counts[0]


@pytest.mark.parametrize("name", ["time_between_purchases", "purchase_gaps"])
def test_windows_see_days_and_not_receipts(spark, sf_dir, name):
    plan = executed_plan(QUERIES[name](spark, sf_dir))
    window = next(i for i, line in enumerate(plan) if "Window [lag" in line)
    below = plan[window:]
    assert any("HashAggregate(keys=[customer_id" in line for line in below)


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("top_customers", "ReadSchema: struct<o_custkey:bigint>"),
        ("peak_days", "ReadSchema: struct<o_orderdate:timestamp_ntz>"),
        ("rfm_segmentation", "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>"),
    ],
)
def test_scans_read_only_what_is_used(spark, sf_dir, name, columns):
    [scan] = lines_with(executed_plan(QUERIES[name](spark, sf_dir)), "FileScan")
    assert columns in scan


def test_store_filter_reaches_the_scan(spark, sf_dir):
    plan = executed_plan(QUERIES["transactions_for_stores"](spark, sf_dir))
    assert any("In(c_nationkey, [1,3,5])" in line for line in lines_with(plan, "PushedFilters"))


def test_no_query_uses_python_or_a_cartesian_product(spark, sf_dir):
    for name in ("executive_summary", "rfm_segmentation", "product_combinations", "store_summary"):
        plan = "\n".join(executed_plan(QUERIES[name](spark, sf_dir)))
        for bad in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval"):
            assert bad not in plan


def test_gaps_read_the_receipts_once(spark, sf_dir):
    plan = executed_plan(QUERIES["purchase_gaps"](spark, sf_dir))
    assert len(lines_with(plan, "FileScan")) == 1


def test_summaries_compute_windows_and_cuts(spark, sf_dir):
    temporal = "\n".join(executed_plan(QUERIES["temporal_summary"](spark, sf_dir)))
    assert "Window" in temporal and "moving_avg_7d" in temporal
    customers = "\n".join(executed_plan(QUERIES["customer_summary"](spark, sf_dir)))
    assert "Window" in customers and "cuts" in customers


def test_no_basket_text_is_shuffled(spark, receipts):
    tx = receipts([("2024-01-01", 1, 2, "3 4"), ("2024-01-01", 1, 2, "3 4")])
    for line in lines_with(executed_plan(transaction_quality(tx)), "Exchange"):
        assert "products" not in line.split("sha2")[0] or "hashpartitioning" in line
    [row] = transaction_quality(tx).collect()
    assert (row.total_transactions, row.duplicate_transactions) == (2, 1)
