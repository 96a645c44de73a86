"""Expressions over the basket text, a space-separated list of product ids.

The text is trimmed of outer spaces and cut at every single space, so
``" 1  2 "`` has three tokens (one of them empty), ``""`` has one empty token
and a NULL basket has none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(products: str = "products") -> Column:
    return F.trim(F.col(products))


def basket_tokens(products: str = "products", clean: bool = False) -> Column:
    """Tokens of a basket in their order; ``clean`` leaves out empty ones."""
    tokens = F.split(trimmed(products), " ")
    return F.array_remove(tokens, "") if clean else tokens


def distinct_tokens(products: str = "products") -> Column:
    """The set of products in a basket, as pattern mining needs it."""
    return F.array_distinct(basket_tokens(products, clean=True))


def basket_units(products: str = "products", clean: bool = False) -> Column:
    """Number of tokens; NULL for a NULL basket in every SQL mode.

    One more than the spaces inside, which are found by length and without
    cutting the text up.
    """
    if clean:
        return F.array_size(basket_tokens(products, clean=True))
    text = trimmed(products)
    without_spaces = F.replace(text, F.lit(" "), F.lit(""))
    return F.octet_length(text) - F.octet_length(without_spaces) + 1
