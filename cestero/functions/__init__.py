"""Column expressions shared by the operators."""

from cestero.functions.baskets import basket_tokens, basket_units, distinct_tokens, trimmed
from cestero.functions.columns import day, spread, top
from cestero.functions.labels import interval_tier, rfm_segment, trend_label

__all__ = [
    "basket_tokens",
    "basket_units",
    "day",
    "distinct_tokens",
    "interval_tier",
    "rfm_segment",
    "spread",
    "top",
    "trend_label",
    "trimmed",
]
