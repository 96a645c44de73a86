"""Delimited text files on any file system Spark can reach."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cestero import schemas
from cestero.functions import day
from cestero.operators.baskets import available_stores, for_stores

# Where the three inputs lie below a base path, and the separator.
TRANSACTIONS = "transactions"
CATEGORIES = "products/Categories.csv"
PRODUCT_CATEGORIES = "products/ProductCategory.csv"
SEPARATOR = "|"


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = False,
    sep: str = SEPARATOR,
) -> DataFrame:
    """Read text files with a fixed schema; a cell that does not fit is NULL."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


@dataclass(frozen=True)
class DelimitedSource:
    """The three inputs below ``base``, each of which can lie elsewhere."""

    spark: SparkSession
    base: str | None = None
    transactions_path: str | None = None
    categories_path: str | None = None
    product_categories_path: str | None = None
    sep: str = SEPARATOR
    pattern: str = "*.csv"
    id_type: str = "int"

    def _path(self, given: str | None, default: str) -> str:
        if given:
            return given.rstrip("/")
        if not self.base:
            raise ValueError(f"give a base path, or a path in place of <base>/{default}")
        return f"{self.base.rstrip('/')}/{default}"

    def layout(self, name: str) -> tuple[str, T.StructType, bool]:
        """Path, schema and header of one of the three inputs."""
        if name == "transactions":
            folder = self._path(self.transactions_path, TRANSACTIONS)
            return f"{folder}/{self.pattern}", schemas.transactions_schema(self.id_type), False
        if name == "categories":
            return self._path(self.categories_path, CATEGORIES), schemas.categories_schema(), False
        path = self._path(self.product_categories_path, PRODUCT_CATEGORIES)
        return path, schemas.product_categories_schema(self.id_type), True

    def _read(self, name: str) -> DataFrame:
        return read_delimited(self.spark, *self.layout(name), sep=self.sep)

    def transactions(self, store_ids: Iterable[int] | None = None) -> DataFrame:
        """Receipts, by default of all stores, with the date as a date."""
        return for_stores(self._read("transactions").withColumn("transaction_date", day()), store_ids)

    def categories(self) -> DataFrame:
        return self._read("categories")

    def product_categories(self) -> DataFrame:
        return self._read("product_categories")

    def stores(self) -> DataFrame:
        return available_stores(self.transactions())
