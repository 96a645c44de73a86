"""Purchase frequency, time between purchases and RFM segments per customer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cestero.functions import day, interval_tier, rfm_segment, spread
from cestero.operators.ranking import exact_ntiles

# Most rows written by one task for repeats on the same day.
_REPEATS_PER_TASK_ROW = 100_000


def purchase_frequency(
    tx: DataFrame, ordered: bool = False, by: Sequence[str] = ()
) -> DataFrame:
    """Number of purchases and first and last day of every customer, and of every ``by``."""
    out = tx.groupBy(*by, "customer_id").agg(
        F.count("*").alias("num_compras"),
        F.min("transaction_date").alias("primera_compra"),
        F.max("transaction_date").alias("ultima_compra"),
    )
    return out.orderBy(F.desc("num_compras"), *by, "customer_id") if ordered else out


def _purchase_counts(tx: DataFrame) -> DataFrame:
    return tx.groupBy("customer_id").agg(F.count("*").alias("num_compras"))


def purchase_frequency_stats(tx: DataFrame) -> DataFrame:
    return spread(
        _purchase_counts(tx),
        "num_compras",
        avg="promedio_compras",
        min="min_compras",
        max="max_compras",
    )


def purchase_frequency_histogram(tx: DataFrame) -> DataFrame:
    return (
        _purchase_counts(tx)
        .groupBy("num_compras")
        .agg(F.count("*").alias("num_clientes"))
        .orderBy("num_compras")
    )


def purchase_days(
    tx: DataFrame, date_column: str = "transaction_date", by: Sequence[str] = ()
) -> DataFrame:
    """``*by, customer_id, date, n``: a customer's receipts on each day.

    However many receipts a customer has, that is one row per calendar day;
    unreadable dates share the NULL day. Stored by customer (``sources.buckets``),
    it serves what is below without another shuffle.
    """
    return (
        tx.select(*by, "customer_id", day(date_column).alias("date"))
        .groupBy(*by, "customer_id", "date")
        .agg(F.count("*").alias("n"))
    )


def _with_previous(days: DataFrame, by: Sequence[str]) -> DataFrame:
    """Days on which a customer bought, and the day before that."""
    by_date = Window.partitionBy(*by, "customer_id").orderBy("date")
    return days.where(F.col("date").isNotNull()).withColumn("prev_date", F.lag("date").over(by_date))


def gaps_between(days: DataFrame, by: Sequence[str] = (), spread_repeats: bool = True) -> DataFrame:
    """``purchase_gaps`` from ``purchase_days``.

    ``spread_repeats`` deals the repeats of one day to several tasks, in blocks;
    without it they are written where they are found and nothing is shuffled.
    """
    seen = _with_previous(days, by)
    # Naming n keeps the count in this branch too, so both read one exchange.
    between = seen.where("prev_date IS NOT NULL AND n > 0").select(
        *by,
        "customer_id",
        "prev_date",
        "date",
        F.date_diff("date", "prev_date").alias("days_between"),
    )
    size = _REPEATS_PER_TASK_ROW
    blocks = (
        seen.where("n > 1")
        .select(*by, "customer_id", "date", (F.col("n") - 1).alias("repeats"))
        .select("*", F.expr(f"explode(sequence(0, (repeats - 1) div {size}))").alias("block"))
        .withColumn("m", F.expr(f"least({size}, repeats - block * {size})"))
    )
    if spread_repeats:
        partitions = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = blocks.repartition(partitions, *by, "customer_id", "date", "block")
    same_day = blocks.select(
        *by,
        "customer_id",
        F.col("date").alias("prev_date"),
        "date",
        F.explode(F.array_repeat(F.lit(0), F.col("m").cast("int"))).alias("days_between"),
    )
    return between.unionByName(same_day)


def purchase_gaps(
    tx: DataFrame, date_column: str = "transaction_date", by: Sequence[str] = ()
) -> DataFrame:
    """One row per purchase after a customer's first (per ``by``), with the days waited.

    Purchases on one day are 0 days apart. Those rows are written out from
    their number, which a day of very many receipts spreads over several tasks.
    """
    return gaps_between(purchase_days(tx, date_column, by), by)


def intervals_of(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``time_between_purchases`` from ``purchase_days``."""
    gap = F.date_diff("date", "prev_date")
    return (
        _with_previous(days, by)
        .groupBy(*by, "customer_id")
        .agg(
            (F.sum("n") - 1).alias("num_intervalos"),
            F.date_diff(F.max("date"), F.min("date")).alias("total_days"),
            F.min(gap).alias("min_gap"),
            F.max(gap).alias("max_gap"),
            F.max("n").alias("most_per_day"),
        )
        .where("num_intervalos > 0")
        .select(
            *by,
            "customer_id",
            (F.col("total_days") / F.col("num_intervalos")).alias("promedio_dias_entre_compras"),
            F.when(F.col("most_per_day") > 1, 0).otherwise(F.col("min_gap")).alias("min_dias"),
            F.coalesce("max_gap", F.lit(0)).alias("max_dias"),
            "num_intervalos",
        )
    )


def time_between_purchases(
    tx: DataFrame,
    date_column: str = "transaction_date",
    ordered: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean, least and greatest gap of every customer with two purchases or more.

    The gaps of a customer add up to the days from first to last purchase, so
    the mean needs no row per gap.
    """
    out = intervals_of(purchase_days(tx, date_column, by), by)
    return out.orderBy("promedio_dias_entre_compras", *by, "customer_id") if ordered else out


def time_between_stats(tx: DataFrame, date_column: str = "transaction_date") -> DataFrame:
    """Spread of the customers' mean gaps; every customer weighs the same."""
    return spread(
        time_between_purchases(tx, date_column),
        "promedio_dias_entre_compras",
        avg="promedio_general",
        min="min_promedio",
        max="max_promedio",
    )


def frequency_tiers(
    tx: DataFrame, date_column: str = "transaction_date", by: Sequence[str] = ()
) -> DataFrame:
    """Customers per tier of their mean gap, and per ``by``."""
    tier = interval_tier(F.col("promedio_dias_entre_compras"))
    return (
        time_between_purchases(tx, date_column, by=by)
        .groupBy(*by, tier.alias("categoria_frecuencia"))
        .agg(F.count("*").alias("num_clientes"))
        .orderBy(*by, F.desc("num_clientes"), "categoria_frecuencia")
    )


def frequency_of(days: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``purchase_frequency`` from ``purchase_days``."""
    return days.groupBy(*by, "customer_id").agg(
        F.sum("n").alias("num_compras"),
        F.min("date").alias("primera_compra"),
        F.max("date").alias("ultima_compra"),
    )


def profiles(
    tx: DataFrame, by: Sequence[str], date_column: str = "transaction_date"
) -> DataFrame:
    """One row per customer and ``by`` with what the frames per customer are made of.

    ``num_compras, primera_compra, ultima_compra``; of receipts with a readable date
    their number ``dated`` and the ``most_per_day``; least and greatest gap within
    ``by`` (``min_gap, max_gap``) and wherever the customer bought (``min_any,
    max_any``). Receipts are read and brought together once, by customer; they
    arrive as one row per day and ``by``.
    """
    days = purchase_days(tx, date_column, by).repartition("customer_id")
    dated = F.when(F.col("date").isNotNull(), F.col("n"))
    found = {"gap": [*by, "customer_id"], "any": ["customer_id"]}
    for name, of in found.items():
        before = F.lag("date").over(Window.partitionBy(*of).orderBy("date"))
        days = days.withColumn(name, F.date_diff("date", before))
    return days.groupBy(*by, "customer_id").agg(
        F.sum("n").alias("num_compras"),
        F.min("date").alias("primera_compra"),
        F.max("date").alias("ultima_compra"),
        F.sum(dated).alias("dated"),
        F.max(dated).alias("most_per_day"),
        *(F.min(name).alias(f"min_{name}") for name in found),
        *(F.max(name).alias(f"max_{name}") for name in found),
    )


def all_profiles(own: DataFrame) -> DataFrame:
    """``profiles`` of the customers' receipts wherever they bought, from those of each store, say."""
    return own.groupBy("customer_id").agg(
        *(F.sum(c).alias(c) for c in ("num_compras", "dated")),
        F.min("primera_compra").alias("primera_compra"),
        F.max("ultima_compra").alias("ultima_compra"),
        F.max("most_per_day").alias("most_per_day"),
        F.min("min_any").alias("min_gap"),
        F.max("max_any").alias("max_gap"),
    )


def frequency_in(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``purchase_frequency`` from ``profiles``."""
    return found.select(*by, "customer_id", "num_compras", "primera_compra", "ultima_compra")


def intervals_in(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``time_between_purchases`` from ``profiles``."""
    between = F.col("dated") - 1
    return found.where(between > 0).select(
        *by,
        "customer_id",
        (F.date_diff("ultima_compra", "primera_compra") / between).alias(
            "promedio_dias_entre_compras"
        ),
        F.when(F.col("most_per_day") > 1, 0).otherwise(F.col("min_gap")).alias("min_dias"),
        F.coalesce("max_gap", F.lit(0)).alias("max_dias"),
        between.alias("num_intervalos"),
    )


def rfm_of(
    frequencies: DataFrame,
    reference_date: str | date | None = None,
    invert_frequency: bool = False,
    by: Sequence[str] = (),
) -> DataFrame:
    """``rfm_segmentation`` from ``frequency_of`` days."""
    customers = (
        frequencies.select(
            *by,
            "customer_id",
            F.col("num_compras").alias("frequency"),
            F.col("ultima_compra").alias("last"),
        )
        # The steps below all read this exchange, with one row per customer,
        # and not the larger one under the aggregate. Its key takes in every
        # column, or pruning would make a different exchange for each step.
        .repartition(*by, "customer_id", "frequency", "last")
    )
    # The order of recency is that of the last day, reversed.
    order = {"by_recency": -F.unix_date("last"), "by_frequency": -F.col("frequency")}
    scored = exact_ntiles(customers, order, "customer_id", groups=by)
    if reference_date is not None:
        until = F.lit(str(reference_date)).cast("date")
    elif by:
        last = customers.groupBy(F.struct(*by).alias("of")).agg(
            F.date_add(F.max("last"), 1).alias("until")
        )
        scored = scored.join(last, F.struct(*by) == F.col("of"))
        until = F.col("until")
    else:
        until = customers.agg(F.date_add(F.max("last"), 1)).scalar()
    by_frequency = F.col("by_frequency")
    scored = scored.select(
        *by,
        "customer_id",
        "frequency",
        F.date_diff(until, "last").alias("recency"),
        (5 - F.col("by_recency")).alias("R_score"),
        (5 - by_frequency if invert_frequency else by_frequency).alias("F_score"),
    )
    return scored.withColumn("RFM_segment", rfm_segment(F.col("R_score"), F.col("F_score")))


def rfm_segmentation(
    tx: DataFrame,
    reference_date: str | date | None = None,
    invert_frequency: bool = False,
    date_column: str = "transaction_date",
    by: Sequence[str] = (),
) -> DataFrame:
    """Recency and frequency quartiles of the customers, and their segment.

    ``R_score`` is 4 for the most recent quarter. ``F_score`` is 1 for the most
    frequent one, as in the reports this reproduces; ``invert_frequency`` makes
    that 4, which the segment names suggest. Ties go by customer id. Without a
    ``reference_date`` recency counts up to the day after the last purchase. With
    ``by`` all of this holds for each store, say, by itself.
    """
    dated = tx.select(*by, "customer_id", day(date_column).alias("transaction_date"))
    return rfm_of(purchase_frequency(dated, by=by), reference_date, invert_frequency, by)


def rfm_segment_profile(rfm: DataFrame) -> DataFrame:
    return (
        rfm.groupBy("RFM_segment")
        .agg(
            F.count("*").alias("num_clientes"),
            F.avg("recency").alias("avg_recency"),
            F.avg("frequency").alias("avg_frequency"),
        )
        .orderBy(F.desc("num_clientes"), "RFM_segment")
    )


def rfm_preview(rfm: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` customers with the greatest scores."""
    return rfm.orderBy(F.desc("R_score"), F.desc("F_score"), "customer_id").limit(n)
