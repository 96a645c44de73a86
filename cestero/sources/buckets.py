"""Purchases per customer and day as a table bucketed by customer.

What looks at one customer's days in order (gaps, frequency, RFM) otherwise
shuffles the receipts by customer each time. Here that is done once, when the
table is written: a bucket holds all days of its customers, sorted, and later
reads start from there. A row is a customer's day with the number of receipts,
so that a customer with most of the receipts has one row per calendar day in
its bucket and not all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cestero.operators.customers import purchase_days

#: Buckets of the table; about as many as tasks that read it at a time.
BUCKETS = 200


def write_customer_days(
    tx: DataFrame,
    table: str,
    path: str,
    buckets: int = BUCKETS,
    date_column: str = "transaction_date",
) -> None:
    """Replace ``table``, whose files lie at ``path``, by the purchase days of ``tx``.

    Each bucket is written by one task into one file.
    """
    (
        purchase_days(tx, date_column)
        .repartition(buckets, "customer_id")
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, "customer_id")
        .sortBy("customer_id", "date")
        .saveAsTable(table)
    )


def read_customer_days(spark: SparkSession, table: str) -> DataFrame:
    """``customer_id, date, n``, for ``customers.gaps_between`` and its like."""
    return spark.table(table)
