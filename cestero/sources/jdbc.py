"""The same three inputs as tables of a database."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cestero.functions import day
from cestero.operators.baskets import available_stores, for_stores

# Default connection and table names.
DRIVER = "org.postgresql.Driver"
HOST, PORT, DATABASE = "postgres", "5432", "sales"
FETCH_SIZE = 10_000


@dataclass(frozen=True)
class Slices:
    """How to read one table over several connections at once.

    The bounds only place the cuts; rows outside of them are read too.
    """

    column: str
    lower: str | int
    upper: str | int
    partitions: int


@dataclass(frozen=True)
class JdbcSource:
    spark: SparkSession
    host: str = HOST
    port: str = PORT
    database: str = DATABASE
    user: str = ""
    password: str = ""
    driver: str = DRIVER
    slices: Mapping[str, Slices] = field(default_factory=dict)
    fetch_size: int = FETCH_SIZE
    id_type: str = "int"
    # How receipts are cut if ``slices`` does not say so: by the range of a column
    # that the database is asked for, or that is given, in so many parts.
    partition_column: str = "transaction_date"
    partitions: str | int = 0
    lower: str = ""
    upper: str = ""

    def __post_init__(self) -> None:
        if not self.user or not self.password:
            raise ValueError("a database needs user and password")

    def options(self, table: str, cut: Slices | None = None) -> dict[str, str]:
        """Reader options of a table, with its slices if it has any."""
        found = {
            "url": f"jdbc:postgresql://{self.host}:{self.port}/{self.database}",
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "fetchsize": str(self.fetch_size),
        }
        cut = cut or self.slices.get(table)
        if cut:
            found |= {
                "partitionColumn": cut.column,
                "lowerBound": str(cut.lower),
                "upperBound": str(cut.upper),
                "numPartitions": str(cut.partitions),
            }
        return found

    def _read(self, table: str, cut: Slices | None = None) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options(table, cut)).load()

    def bounds_query(self, table: str) -> str:
        c = self.partition_column
        return f"(SELECT min({c}) AS low, max({c}) AS high FROM {table}) AS bounds"

    def cut_of(self, table: str) -> Slices | None:
        """How a large table is read in parallel; None if it is known to be empty.

        One connection would put the whole table into one task, so it is an error
        if nothing says how many there should be.
        """
        if table in self.slices:
            return self.slices[table]
        if int(self.partitions) < 1:
            raise ValueError(f"give slices of {table!r}, or the number of partitions")
        low, high = self.lower, self.upper
        if not (low and high):
            row = self._read(self.bounds_query(table)).first()
            if row is None or row["low"] is None:
                return None
            low, high = row["low"], row["high"]
        return Slices(self.partition_column, str(low), str(high), int(self.partitions))

    def transactions(self, store_ids: Iterable[int] | None = None) -> DataFrame:
        """Receipts; Spark hands the store filter on to the database."""
        receipts = self._read("transactions", self.cut_of("transactions"))
        return for_stores(receipts, store_ids).select(
            day().alias("transaction_date"),
            F.col("store_id").try_cast("int").alias("store_id"),
            F.col("customer_id").try_cast(self.id_type).alias("customer_id"),
            "products",
        )

    def categories(self) -> DataFrame:
        return self._read("categories").withColumn(
            "category_id", F.col("category_id").try_cast("int")
        )

    def product_categories(self) -> DataFrame:
        return self._read("product_categories").select(
            F.col("product_id").try_cast(self.id_type).alias("product_id"),
            F.col("category_id").try_cast("int").alias("category_id"),
        )

    def stores(self) -> DataFrame:
        """Different stores, found by the database instead of read row by row."""
        distinct = self._read("(SELECT DISTINCT store_id FROM transactions) AS stores")
        return available_stores(distinct)
