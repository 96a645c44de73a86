"""Delimited text in the format the file source reads."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cestero.sources.delimited import SEPARATOR


def write_delimited(
    df: DataFrame, path: str, header: bool = False, sep: str = SEPARATOR
) -> None:
    """Replace ``path``; spaces at the ends of a basket text are kept."""
    writer = df.write.mode("overwrite").option("sep", sep).option("header", header)
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer.options(**keep).csv(path)
