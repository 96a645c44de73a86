"""Reading delimited files with rejected rows kept apart instead of filled with NULL.

A row is rejected if it has more or fewer cells than columns, if a cell does not
fit its column's type, or if a date is none. What is rejected keeps its line as
it was, the file it came from, and the reason: the first column whose cell does
not fit, or ``columns`` for a wrong number of cells.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cestero.functions import day
from cestero.sources.delimited import SEPARATOR, DelimitedSource

#: The reason of a row with a wrong number of cells.
CELLS = "columns"

_LINE, _REJECTED = "_corrupt_record", "rejected"


def read_flagged(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = False,
    sep: str = SEPARATOR,
    dates: tuple[str, ...] = (),
) -> DataFrame:
    """The columns of ``schema`` and ``rejected`` (reason, line, file), NULL for a good row.

    Values are those of ``read_delimited``; texts in ``dates`` become dates. All
    of it happens where a line is read.
    """
    read = (
        spark.read.schema(T.StructType([*schema, T.StructField(_LINE, T.StringType())]))
        .option("sep", sep)
        .option("header", header)
        .option("columnNameOfCorruptRecord", _LINE)
        # With cells left out unread, their number would go unnoticed.
        .option("columnPruning", False)
        .csv(path)
    )
    texts = ", ".join(f"`{c.name}` string" for c in schema)
    cells = F.from_csv(_LINE, texts, {"sep": sep})
    unfit = [
        F.when(F.col(c.name).isNull() & cells[c.name].isNotNull(), c.name)
        for c in schema
        if c.dataType != T.StringType()
    ]
    bad_line = F.when(F.col(_LINE).isNotNull(), F.coalesce(*unfit, F.lit(CELLS)))
    bad_date = [F.when(F.col(c).isNotNull() & day(c).isNull(), c) for c in dates]
    reason = F.coalesce(bad_line, *bad_date)
    line = F.coalesce(_LINE, F.to_csv(F.struct(*schema.names), {"sep": sep}))
    rejected = F.struct(
        reason.alias("reason"), line.alias("line"), F.col("_metadata.file_path").alias("file")
    )
    flagged = read.withColumn(_REJECTED, F.when(reason.isNotNull(), rejected))
    return flagged.withColumns({c: day(c) for c in dates}).drop(_LINE)


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(_REJECTED).isNull()).drop(_REJECTED)


def rejected(flagged: DataFrame) -> DataFrame:
    """``reason, line, file`` of what is not accepted."""
    return flagged.where(F.col(_REJECTED).isNotNull()).select(f"{_REJECTED}.*")


def is_rejected() -> Column:
    return F.col(_REJECTED).isNotNull()


@dataclass(frozen=True)
class Checked:
    """The three inputs of a file source, each row with what is wrong with it."""

    source: DelimitedSource

    def _flagged(self, name: str, dates: tuple[str, ...] = ()) -> DataFrame:
        path, schema, header = self.source.layout(name)
        return read_flagged(self.source.spark, path, schema, header, self.source.sep, dates)

    def transactions(self) -> DataFrame:
        return self._flagged("transactions", ("transaction_date",))

    def categories(self) -> DataFrame:
        return self._flagged("categories")

    def product_categories(self) -> DataFrame:
        return self._flagged("product_categories")
