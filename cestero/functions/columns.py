"""Small frame and column helpers used by all operator modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day(column: str = "transaction_date") -> Column:
    """Calendar day of a date, timestamp or text column; bad text is NULL."""
    return F.col(column).try_cast("date")


def spread(df: DataFrame, column: str, **names: str) -> DataFrame:
    """One row with the mean, least and greatest value of ``column``.

    ``names`` gives the output columns, e.g. ``avg="promedio"``.
    """
    measures = {"avg": F.avg, "min": F.min, "max": F.max}
    return df.agg(*(measures[kind](column).alias(name) for kind, name in names.items()))


def top(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """The ``n`` rows with the greatest ``measure``; ``ties`` make it unique.

    Spark keeps n rows per task and merges those, without a full sort.
    """
    return df.orderBy(F.desc(measure), *(F.asc_nulls_first(t) for t in ties)).limit(n)
