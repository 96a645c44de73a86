"""Bulk load: delimited files once into columnar tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cestero.sinks.shared import path_exists, remove_folder
from cestero.sources import checked
from cestero.sources.buckets import BUCKETS, write_customer_days
from cestero.sources.delimited import DelimitedSource

# Fixed value: the receipt files that a load takes, one per store.
RECEIPT_FILES = "*_Tran.csv"

TABLES = ("transactions", "product_categories", "categories")


def write_transactions(tx: DataFrame, path: str) -> None:
    """Replace the table at ``path``, laid out by store.

    The rebalance hint has Spark split the rows of a store far above the
    average over several tasks and files, and pack small stores together.
    """
    tx.hint("rebalance", "store_id").write.mode("overwrite").partitionBy("store_id").parquet(path)


def _write(name: str, rows: DataFrame, path: str) -> None:
    if name == "transactions":
        write_transactions(rows, path)
    else:
        rows.write.mode("overwrite").parquet(path)


def _without_rejected(name: str, flagged: DataFrame, path: str, quarantine: str) -> int:
    """Write accepted rows, and rejected ones if the same pass has seen any; their number."""
    spark = flagged.sparkSession
    seen = Observation(f"rejected {name} {uuid.uuid4().hex}")
    count = F.count_if(checked.is_rejected()).alias("rejected")
    _write(name, checked.accepted(flagged.observe(seen, count)), path)
    found = (seen.get or {}).get("rejected", 0)
    if found:
        checked.rejected(flagged).write.mode("overwrite").parquet(quarantine)
    elif path_exists(spark, quarantine):
        remove_folder(spark, quarantine)
    return found


def ingest(
    spark: SparkSession,
    data_dir: str,
    target: str,
    sep: str = "|",
    pattern: str = RECEIPT_FILES,
    id_type: str = "int",
    quarantine: bool = False,
    customer_days: str | None = None,
    buckets: int = BUCKETS,
) -> dict[str, str]:
    """Load the three inputs below ``data_dir`` in place of what ``target`` has.

    Returns the path of each table. With ``quarantine`` rows that do not fit their
    columns stay out of the tables and go to one beside each (``read_quarantine``);
    the files are read once more only if there are any. ``customer_days`` names a
    table of the catalog to fill with the purchase days, bucketed by customer.
    """
    source = DelimitedSource(spark, data_dir, sep=sep, pattern=pattern, id_type=id_type)
    paths = {name: f"{target.rstrip('/')}/{name}" for name in TABLES}
    for name, path in paths.items():
        if quarantine:
            flagged = getattr(checked.Checked(source), name)()
            _without_rejected(name, flagged, path, f"{target.rstrip('/')}/quarantine/{name}")
        else:
            _write(name, getattr(source, name)(), path)
    if customer_days:
        tx = read_ingested(spark, target, id_type)
        paths["customer_days"] = f"{target.rstrip('/')}/customer_days"
        write_customer_days(tx, customer_days, paths["customer_days"], buckets)
    return paths


def read_quarantine(spark: SparkSession, target: str) -> DataFrame:
    """``input, reason, line, file`` of all rows that the last load rejected."""
    columns = "reason string, line string, file string"
    found = spark.createDataFrame([], f"input string, {columns}")
    for name in TABLES:
        path = f"{target.rstrip('/')}/quarantine/{name}"
        if path_exists(spark, path):
            rows = spark.read.schema(columns).parquet(path)
            found = found.unionByName(rows.withColumn("input", F.lit(name)))
    return found


def read_ingested(spark: SparkSession, target: str, id_type: str = "int") -> DataFrame:
    """Receipts of an earlier load, maybe none; a filter on the store skips the others."""
    schema = f"transaction_date date, store_id int, customer_id {id_type}, products string"
    return spark.read.schema(schema).parquet(f"{target.rstrip('/')}/transactions")
