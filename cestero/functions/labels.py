"""Value-to-label rules of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Purchase-interval tiers as (greatest average in days, label),
# then the label of everything above.
INTERVAL_TIERS = [
    (7, "Muy Frecuente (≤7 días)"),
    (15, "Frecuente (8-15 días)"),
    (30, "Regular (16-30 días)"),
    (60, "Ocasional (31-60 días)"),
]
INTERVAL_TIER_ABOVE = "Esporádico (>60 días)"

# Segment by recency score (rows 4 to 1) and frequency score
# (columns 4 to 1).
RFM_SEGMENTS = {
    4: ["Champions", "Loyal Customers", "Promising", "Promising"],
    3: ["Loyal Customers", "Loyal Customers", "Potential Loyalists", "Potential Loyalists"],
    2: ["At Risk", "Regular", "Lost", "Lost"],
    1: ["At Risk", "Regular", "Lost", "Lost"],
}

# Change in percent beyond which a trend counts as such.
TREND_THRESHOLD = 5
TREND_UP, TREND_DOWN, TREND_FLAT = "CRECIENTE", "DECRECIENTE", "ESTABLE"


def interval_tier(average_days: Column) -> Column:
    """Tier of a customer by the average number of days between purchases."""
    matches = [F.when(average_days <= limit, name) for limit, name in INTERVAL_TIERS]
    return F.coalesce(*matches, F.lit(INTERVAL_TIER_ABOVE))


def rfm_segment(recency_score: Column, frequency_score: Column) -> Column:
    """Segment of a customer, looked up in a table of 4 by 4 labels."""
    labels = [name for score in (4, 3, 2, 1) for name in RFM_SEGMENTS[score]]
    position = (4 - recency_score) * 4 + (4 - frequency_score)
    return F.get(F.array(*(F.lit(name) for name in labels)), position)


def trend_label(change: Column) -> Column:
    return (
        F.when(change > TREND_THRESHOLD, TREND_UP)
        .when(change < -TREND_THRESHOLD, TREND_DOWN)
        .when(change.isNotNull(), TREND_FLAT)
    )
