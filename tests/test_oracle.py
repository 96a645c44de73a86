"""Every registered query against its SQL twin."""

import duckdb
import pytest

import __spark_entry__ as entry_points
import compare
from cestero.catalog.queries import QUERIES as CATALOG

QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(CATALOG) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_gives_the_rows_of_its_twin(spark, sf_dir, con, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


# Queries whose plans depend on how rows spread over keys.
SENSITIVE = [
    "basket_stats_per_store",
    "day_of_week_sales_per_store",
    "monthly_sales_per_store",
    "purchase_frequency_per_store",
    "weekly_sales_per_store",
    "basic_metrics",
    "daily_sales",
    "executive_summary",
    "explode_transactions",
    "frequency_tiers",
    "frequent_itemsets",
    "product_combinations",
    "purchase_gaps",
    "rfm_segmentation",
    "store_summary",
    "time_between_purchases",
    "top_categories",
    "top_products_per_store",
    "transaction_quality",
]


@pytest.fixture(scope="module")
def skewed_dir(sf_dir, tmp_path_factory):
    """The tables with a third of the rows on one customer, day, product, order."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    replaced = {
        "orders": """
            if(o_orderkey % 3 = 0, 7, o_custkey) AS o_custkey,
            if(o_orderkey % 5 < 2, TIMESTAMP '1996-02-29', o_orderdate) AS o_orderdate""",
        "lineitem": """
            if(hash(l_orderkey, l_linenumber) % 3 = 0, 11, l_partkey) AS l_partkey,
            if(hash(l_orderkey, l_suppkey, 1) % 3 = 0, 5, l_orderkey) AS l_orderkey""",
    }
    con = duckdb.connect()
    for name in compare.TABLES:
        columns = f"* REPLACE ({replaced[name]})" if name in replaced else "*"
        con.execute(
            f"COPY (SELECT {columns} FROM '{sf_dir}/{name}.parquet') "
            f"TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
    return folder


@pytest.mark.parametrize("name", SENSITIVE)
def test_query_on_skewed_tables(spark, skewed_dir, name):
    con = compare.connect(skewed_dir)
    assert compare.differences(QUERIES[name](spark, skewed_dir), con, ORACLE[name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["section", "rank", "key", "value"]
