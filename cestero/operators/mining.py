"""Frequent itemsets and association rules between products.

The search itself is Spark's parallel FP-growth. Rules are joined from the
itemsets, so that they can be made again with another confidence, or from
stored itemsets, without a new search.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cestero.functions import distinct_tokens
from cestero.sinks.shared import stage_table

# Default parameters of the search and of a strong rule.
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.3
STRONG_LIFT = 1.5
STRONG_CONFIDENCE = 0.5


def mining_baskets(tx: DataFrame) -> DataFrame:
    """The set of products of each receipt; receipts without a basket stay out."""
    return tx.where(F.col("products").isNotNull()).select(distinct_tokens().alias("items"))


def frequent_items(baskets: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Items in at least ``min_support`` of the baskets, and one NULL row.

    Each basket adds one NULL to its items, so the count of the NULL item is
    the number of baskets and comes from the same pass. As supports add up to
    the mean basket size, at most that size / ``min_support`` rows are left.
    """
    item = F.explode(F.array_append("items", F.lit(None).cast("string")))
    counts = (
        baskets.where(F.col("items").isNotNull())
        .select(item.alias("item"))
        .groupBy("item")
        .agg(F.count("*").alias("freq"))
    )
    total = F.max_by("freq", F.col("item").isNull().cast("int"))
    n_baskets = counts.agg(total).scalar()
    return counts.where(
        F.col("item").isNull() | (F.col("freq") >= F.ceil(F.lit(float(min_support)) * n_baskets))
    )


@dataclass(frozen=True)
class MinedItemsets:
    """Result of a search: stored itemsets, number of baskets, Spark's model if it made one."""

    itemsets: DataFrame
    n_baskets: int
    model: FPGrowthModel | None


def mine_itemsets(
    baskets: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    num_partitions: int | None = None,
    stage: Callable[[DataFrame], DataFrame] = stage_table,
) -> MinedItemsets:
    """Search the frequent itemsets of ``baskets`` (column ``items``).

    This runs jobs. FP-growth itself counts the items and leaves out what is too
    rare; it keeps the frequent names on the driver (see ``frequent_items`` for
    their bound), the plan has none. ``stage`` writes the result, as the block
    ``staging`` yields it, for instance; without one it stays until the process
    ends.
    """
    spark = baskets.sparkSession
    slim = (
        baskets.where(F.col("items").isNotNull())
        .select("items")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    n_baskets = slim.count()
    search = FPGrowth(
        itemsCol="items",
        minSupport=min_support,
        minConfidence=min_confidence,
        # By default there would be as many as input splits, and that squared
        # in blocks to shuffle.
        numPartitions=num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    try:
        model = search.fit(slim)
        # The model searches anew at each use, hence the table.
        itemsets = model.freqItemsets.select(F.sort_array("items").alias("items"), "freq")
        return MinedItemsets(stage(itemsets), n_baskets, model)
    finally:
        slim.unpersist()


def association_rules(
    itemsets: DataFrame,
    n_baskets: int | Column,
    min_confidence: float = MIN_CONFIDENCE,
    by: Sequence[str] = (),
) -> DataFrame:
    """Rules with a single consequent, from frequent itemsets.

    Taking one item out of an itemset leaves the antecedent, which is frequent
    too, so both sides of a rule are found among the itemsets. With ``by`` these
    are of each store, say, and ``n_baskets`` is a column of theirs.
    """
    # In a struct, NULL is equal to NULL.
    own = [F.struct(*by).alias("of")] if by else []
    of = ["of"] if by else []
    n = n_baskets if isinstance(n_baskets, Column) else F.lit(n_baskets)
    candidates = (
        itemsets.where(F.size("items") > 1)
        .select(*own, "items", F.col("freq").alias("both"), n.alias("n"), F.explode("items").alias("item"))
        .select(
            *of,
            F.sort_array(F.array_except("items", F.array("item"))).alias("antecedent"),
            F.array("item").alias("consequent"),
            "both",
            "n",
        )
    )
    left = itemsets.select(
        *own, F.sort_array("items").alias("antecedent"), F.col("freq").alias("freq_antecedent")
    )
    right = itemsets.where(F.size("items") == 1).select(
        *own, F.col("items").alias("consequent"), F.col("freq").alias("freq_consequent")
    )
    confidence = F.col("both") / F.col("freq_antecedent")
    return (
        candidates.join(left, [*of, "antecedent"])
        .where(confidence >= min_confidence)
        .join(right, [*of, "consequent"])
        .select(
            *(F.col("of")[c].alias(c) for c in by),
            "antecedent",
            "consequent",
            confidence.alias("confidence"),
            (confidence / (F.col("freq_consequent") / F.col("n"))).alias("lift"),
            (F.col("both") / F.col("n")).alias("support"),
        )
    )


def top_itemsets(itemsets: DataFrame, n: int = 20) -> DataFrame:
    return itemsets.orderBy(F.desc("freq"), "items").limit(n)


def top_rules(rules: DataFrame, n: int = 20) -> DataFrame:
    return rules.orderBy(F.desc("lift"), F.desc("confidence"), "antecedent", "consequent").limit(n)


def strong_rules(
    rules: DataFrame, min_lift: float = STRONG_LIFT, min_confidence: float = STRONG_CONFIDENCE
) -> DataFrame:
    return rules.where((F.col("lift") > min_lift) & (F.col("confidence") > min_confidence))


def mining_counts(
    itemsets: DataFrame,
    rules: DataFrame,
    min_lift: float = STRONG_LIFT,
    min_confidence: float = STRONG_CONFIDENCE,
) -> DataFrame:
    """One row with the number of itemsets, rules and strong rules."""
    strong = (F.col("lift") > min_lift) & (F.col("confidence") > min_confidence)
    found = itemsets.select(F.lit(0).alias("rule"), F.lit(0).alias("strong")).unionByName(
        rules.select(F.lit(1).alias("rule"), strong.cast("int").alias("strong"))
    )
    return found.agg(
        F.count_if(F.col("rule") == 0).alias("num_itemsets"),
        F.count_if(F.col("rule") == 1).alias("num_rules"),
        F.count_if(F.col("strong") == 1).alias("num_strong_rules"),
    )
