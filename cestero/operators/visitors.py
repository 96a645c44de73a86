"""Exact numbers of different customers for any period, from one table of bitmaps.

The table has, for each day (and each ``by``, such as the store) and each bucket of
32,768 customer ids, the number of receipts and a bitmap of the customers. Bitmaps
of several days united by bucket give the customers of the period, each once, so
that weeks, months or stores need no second look at the receipts; a new day only
adds rows. Sums of the days' own numbers would count customers twice.

A bucket holds 32,768 customers at most, whatever a day or a customer has in
receipts. Receipts without a customer count as receipts only; unreadable dates
share the NULL day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cestero.functions import day


def daily_customers(
    tx: DataFrame, by: Sequence[str] = (), date_column: str = "transaction_date"
) -> DataFrame:
    """``*by, date, bucket, num_transacciones, clientes``: a row per day and bucket.

    Receipts are first counted per day and customer, which combines before it
    shuffles. Bitmaps are made where all customers of a bucket have come
    together, and never travel with a few bits set.
    """
    counted = (
        tx.select(*by, day(date_column).alias("date"), "customer_id")
        .groupBy(*by, "date", "customer_id")
        .agg(F.count("*").alias("n"))
        .withColumn("bucket", F.bitmap_bucket_number("customer_id"))
        .repartition(*by, "date", "bucket")
    )
    return counted.groupBy(*by, "date", "bucket").agg(
        F.sum("n").alias("num_transacciones"),
        F.bitmap_construct_agg(F.bitmap_bit_position("customer_id")).alias("clientes"),
    )


def customers_by(daily: DataFrame, *keys: Column | str) -> DataFrame:
    """Receipts and different customers for each of ``keys`` of a table of ``daily_customers``."""
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    names = daily.select(*named).columns
    of_bucket = daily.groupBy(*named, "bucket").agg(
        F.sum("num_transacciones").alias("num_transacciones"),
        F.bitmap_or_agg("clientes").alias("clientes"),
    )
    return of_bucket.groupBy(*(F.col(f"`{n}`") for n in names)).agg(
        F.sum("num_transacciones").alias("num_transacciones"),
        F.sum(F.when(F.col("bucket").isNotNull(), F.bitmap_count("clientes")).otherwise(0))
        .cast("bigint")
        .alias("clientes_unicos"),
    )


def daily_visitors(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return customers_by(daily, *by, "date").orderBy(*by, "date")


def weekly_visitors(daily: DataFrame, by: Sequence[str] = (), iso_year: bool = False) -> DataFrame:
    """Per week; the key is the one of ``temporal.weekly_sales``."""
    year = F.extract(F.lit("YEAROFWEEK"), "date") if iso_year else F.year("date")
    week = F.weekofyear("date").alias("week")
    return customers_by(daily, *by, year.alias("year"), week).orderBy(*by, "year", "week")


def monthly_visitors(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    month = (F.year("date").alias("year"), F.month("date").alias("month"))
    return customers_by(daily, *by, *month).orderBy(*by, "year", "month")
