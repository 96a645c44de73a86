"""Figures that come with a write, without a job of their own."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation


def stage_observed(
    df: DataFrame, stage: Callable[[DataFrame], DataFrame], **figures: Column
) -> tuple[DataFrame, dict[str, int]]:
    """``df`` as ``stage`` has stored it, and sums or counts over all rows of it.

    ``figures`` are aggregates by name; they are taken while the rows pass on
    their way to the table. One without rows is 0.
    """
    seen = Observation(f"observed {uuid.uuid4().hex}")
    stored = stage(df.observe(seen, *(f.alias(name) for name, f in figures.items())))
    # What Spark knows to be empty is not run, and so has nothing to report.
    found = seen.get or {}
    return stored, {name: found.get(name) or 0 for name in figures}
