"""Row numbers without a global sort or a single task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cestero.sinks.shared import stage_table

# Bits of a row's place within its task, in what monotonically_increasing_id gives.
_PLACE = 33


def numbered(
    rows: DataFrame,
    into: str = "number",
    by: str | None = None,
    stage: Callable[[DataFrame], DataFrame] = stage_table,
) -> DataFrame:
    """``rows``, stored by ``stage``, with a number from 0 on without a gap, per ``by`` if given.

    Rows are numbered as they lie: a row's number is its place in its task plus
    the rows of all tasks before. Only the latter are added up, one row per task
    (and ``by``, whose rows are neighbours in a task). Storing the places first
    keeps both steps to the same ones. ``by`` must not be NULL; a struct is not.
    """
    together = rows.sortWithinPartitions(by) if by else rows
    placed = stage(together.withColumn(into, F.monotonically_increasing_id()))
    of = [by] if by else []
    task = F.shiftright(into, _PLACE).alias("task")
    earlier = Window.partitionBy(*of).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy(*of, task).agg(F.min(into).alias("first"), F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    shifts = runs.select(*of, "task", (before - F.col("first")).alias("shift"))
    if not by:
        shifts = F.broadcast(shifts)  # a row per task
    return (
        placed.withColumn("task", task)
        .join(shifts, [*of, "task"])
        .withColumn(into, F.col(into) + F.col("shift"))
        .select(*rows.columns, into)
    )
