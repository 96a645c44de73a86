"""Sales over time.

Weeks, months, weekdays and the trend are rolled up from counts per day: the
date arithmetic and name formatting then run once per calendar day and not once
per receipt, and what follows the first shuffle is as small as the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cestero.functions import day, spread, trend_label

#: Rows of one group in a block of a moving average.
_BLOCK = 512


def per_day(
    tx: DataFrame, date_column: str = "transaction_date", by: Sequence[str] = ()
) -> DataFrame:
    """Receipts per calendar day, and per ``by``; unreadable dates share the NULL day.

    ``by`` are columns that this and what is rolled up from it keep apart, such
    as the store: counts combine before they shuffle, however large a store is.
    """
    return (
        tx.select(*by, day(date_column).alias("date"))
        .groupBy(*by, "date")
        .agg(F.count("*").alias("num_transacciones"))
    )


def all_days(daily: DataFrame) -> DataFrame:
    """``per_day`` of all receipts from that of each store, say."""
    return daily.groupBy("date").agg(_total())


def _total():
    return F.sum("num_transacciones").alias("num_transacciones")


def daily_sales(tx: DataFrame, date_column: str = "transaction_date") -> DataFrame:
    """Receipts and exact number of different customers per day.

    Spark first reduces to (day, customer) and shuffles on both, so a day with
    a large part of all receipts is still spread over the cluster.
    """
    return (
        tx.select(day(date_column).alias("date"), "customer_id")
        .groupBy("date")
        .agg(
            F.count("*").alias("num_transacciones"),
            F.count_distinct("customer_id").alias("clientes_unicos"),
        )
        .orderBy("date")
    )


def daily_sales_stats(tx: DataFrame, date_column: str = "transaction_date") -> DataFrame:
    return spread(
        per_day(tx, date_column),
        "num_transacciones",
        avg="promedio_diario",
        min="min_diario",
        max="max_diario",
    )


def weekly_sales(
    tx: DataFrame,
    date_column: str = "transaction_date",
    iso_year: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Receipts per week, with the first and last day sold in it.

    The key is the calendar year with the ISO week number, so the last days of
    December can share week 1 with the January before; ``iso_year`` takes the
    year the ISO week belongs to.
    """
    return weeks_of(per_day(tx, date_column, by), iso_year, by)


def weeks_of(daily: DataFrame, iso_year: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """``weekly_sales`` from ``per_day``."""
    year = F.extract(F.lit("YEAROFWEEK"), "date") if iso_year else F.year("date")
    return (
        daily.groupBy(*by, year.alias("year"), F.weekofyear("date").alias("week"))
        .agg(_total(), F.min("date").alias("inicio_semana"), F.max("date").alias("fin_semana"))
        .orderBy(*by, "year", "week")
    )


def weekly_sales_stats(tx: DataFrame, date_column: str = "transaction_date") -> DataFrame:
    return spread(
        weekly_sales(tx, date_column),
        "num_transacciones",
        avg="promedio_semanal",
        min="min_semanal",
        max="max_semanal",
    )


def monthly_sales(
    tx: DataFrame, date_column: str = "transaction_date", by: Sequence[str] = ()
) -> DataFrame:
    return months_of(per_day(tx, date_column, by), by)


def months_of(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``monthly_sales`` from ``per_day``."""
    return (
        daily.groupBy(
            *by,
            F.year("date").alias("year"),
            F.month("date").alias("month"),
            F.date_format("date", "MMMM").alias("month_name"),
        )
        .agg(_total())
        .orderBy(*by, "year", "month")
    )


def monthly_sales_stats(tx: DataFrame, date_column: str = "transaction_date") -> DataFrame:
    return spread(
        monthly_sales(tx, date_column),
        "num_transacciones",
        avg="promedio_mensual",
        min="min_mensual",
        max="max_mensual",
    )


def day_of_week_sales(
    tx: DataFrame, date_column: str = "transaction_date", by: Sequence[str] = ()
) -> DataFrame:
    """Receipts per weekday, 1 for Sunday to 7 for Saturday."""
    return weekdays_of(per_day(tx, date_column, by), by)


def weekdays_of(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``day_of_week_sales`` from ``per_day``."""
    return (
        daily.groupBy(
            *by,
            F.dayofweek("date").alias("day_of_week"),
            F.date_format("date", "EEEE").alias("day_name"),
        )
        .agg(_total())
        .orderBy(*by, "day_of_week")
    )


def day_of_week_extremes(tx: DataFrame, date_column: str = "transaction_date") -> DataFrame:
    """Busiest and quietest weekday; among equals the first of the week."""
    position = F.coalesce("day_of_week", F.lit(0))
    n = F.col("num_transacciones")
    return day_of_week_sales(tx, date_column).agg(
        F.max_by("day_name", F.struct(n, -position)).alias("max_day"),
        F.max(n).alias("max_transacciones"),
        F.min_by("day_name", F.struct(n, position)).alias("min_day"),
        F.min(n).alias("min_transacciones"),
    )


def numbered_days(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``daily`` with each row's ``number`` from 0 on, per ``by`` in the order of days, and
    the ``total`` of them; the NULL day comes first.

    Rows are ranked within a calendar year. What earlier years have is added from
    one list of years per ``by``, so that no task sorts more than a year of one.
    """
    year = F.coalesce(F.year("date"), F.lit(-(2**31))).alias("year")
    keys = F.struct(*by, "year") if by else F.struct("year")
    in_year = Window.partitionBy(*by, "year").orderBy("date")
    ranked = daily.select("*", year).withColumn("rank", F.row_number().over(in_year) - 1)
    sizes = ranked.groupBy(*by, "year").agg(F.count("*").alias("n"))
    listed = sizes.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("year", "n"))).alias("years"))

    def sum_of(years):
        return F.aggregate(years, F.lit(0).cast("bigint"), lambda found, y: found + y["n"])

    starts = listed.select(
        *by, "years", sum_of(F.col("years")).alias("total"), F.posexplode("years").alias("at", "y")
    ).select(
        *by,
        F.col("y.year").alias("year"),
        sum_of(F.slice("years", F.lit(1), F.col("at"))).alias("start"),
        "total",
    )
    starts = starts.select(keys.alias("of"), "start", "total")
    # In a struct, NULL is equal to NULL.
    return ranked.join(starts, keys == F.col("of")).select(
        *daily.columns, (F.col("start") + F.col("rank")).alias("number"), "total"
    )


def moving_average(
    daily: DataFrame, by: Sequence[str], rows: int = 7, measure: str = "num_transacciones"
) -> DataFrame:
    """Mean of ``measure`` over each day and the rows before it, ``rows`` in all, per ``by``.

    Numbered rows are cut into blocks, and a block's last rows are handed to the
    next one, where they are counted in and then left out. A block is a task's
    largest sort, however many rows a group has.
    """
    block = F.expr(f"number div {_BLOCK}")
    handed = F.col("number") % _BLOCK > _BLOCK - rows
    blocks = F.explode(F.when(handed, F.array(block, block + 1)).otherwise(F.array(block)))
    window = Window.partitionBy(*by, "block").orderBy("number").rowsBetween(1 - rows, 0)
    return (
        numbered_days(daily, by)
        .select("*", blocks.alias("block"))
        .withColumn(f"moving_avg_{rows}d", F.avg(measure).over(window))
        .where(F.col("block") == block)
        .select(*daily.columns, f"moving_avg_{rows}d")
    )


def sales_trend(
    tx: DataFrame, date_column: str = "transaction_date", by: Sequence[str] = ()
) -> DataFrame:
    """Receipts per day with the mean of the day and the six rows before it.

    Without ``by`` the window has one partition; it holds one row per calendar day.
    With it, the result comes unsorted.
    """
    return trend_of(per_day(tx, date_column, by), by)


def trend_of(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``sales_trend`` from ``per_day``."""
    if by:
        return moving_average(daily, by)
    last_seven = Window.orderBy("date").rowsBetween(-6, Window.currentRow)
    return daily.withColumn(
        "moving_avg_7d", F.avg("num_transacciones").over(last_seven)
    ).orderBy("date")


def trend_change(
    tx: DataFrame, date_column: str = "transaction_date", by: Sequence[str] = ()
) -> DataFrame:
    """Mean of the first and of the last seven days sold, and their change, per ``by``."""
    n = F.col("num_transacciones")
    daily = per_day(tx, date_column, by)
    if by:
        numbered = numbered_days(daily, by)
        first, last = F.col("number") < 7, F.col("number") >= F.col("total") - 7
    else:
        # One row per calendar day, and one task for them.
        ends = {"start": F.asc_nulls_first("date"), "end": F.desc_nulls_last("date")}
        ranks = {f"from_{k}": F.row_number().over(Window.orderBy(o)) for k, o in ends.items()}
        numbered = daily.select(n, *(rank.alias(name) for name, rank in ranks.items()))
        first, last = F.col("from_start") <= 7, F.col("from_end") <= 7
    weeks = numbered.groupBy(*by).agg(
        F.avg(F.when(first, n)).alias("first_week_avg"),
        F.avg(F.when(last, n)).alias("last_week_avg"),
    )
    first, last = F.col("first_week_avg"), F.col("last_week_avg")
    return weeks.withColumn("trend_change", (last - first) / first * 100).withColumn(
        "trend", trend_label(F.col("trend_change"))
    )
