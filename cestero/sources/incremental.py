"""Loading receipt files as they come: what is new or has changed, and nothing else.

The table is laid out by a unit, the store or the day. A manifest beside it tells
which version of each file is loaded (length and time of its last change) and
which units its rows fell into. A load reads only files that the manifest does
not know in their present version, and replaces the units that they, or their
earlier versions, have rows in; rows that other files brought into these units
are kept. All other units stay untouched, files and all.

The manifest is written last: after a failure the next load takes the same files
again and replaces the same units, so that it ends in the same table. A load
without changes writes nothing. One load at a time is expected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cestero import schemas
from cestero.functions import day
from cestero.sinks.shared import path_exists, remove_folder, staging
from cestero.sources.delimited import SEPARATOR, TRANSACTIONS, read_delimited
from cestero.sources.ingest import RECEIPT_FILES

UNITS = ("store_id", "transaction_date")

_MANIFEST = "file string, size bigint, changed timestamp, unit string, rows bigint, load bigint"

#: Size in the manifest of a file whose rows went with it.
_GONE = -1

# Fixed value: the folder of rows whose partition column is NULL.
_NULL_UNIT = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Load:
    """What a load did: files read or gone, and units replaced (NULL as None)."""

    files: int
    units: tuple[str | None, ...]


def _columns(id_type: str) -> str:
    return (
        f"transaction_date date, store_id int, customer_id {id_type}, products string, "
        "source_file string"
    )


def _listed(spark: SparkSession, files: str) -> DataFrame:
    """``path, file, size, changed`` of the source files; their content is not read."""
    return spark.read.format("binaryFile").load(files).select(
        "path",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed"),
    )


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """The version of each file that is loaded: a row per unit, or one without rows."""
    path = f"{target.rstrip('/')}/manifest"
    if not path_exists(spark, path):
        return spark.createDataFrame([], _MANIFEST)
    every = spark.read.schema(_MANIFEST).parquet(path)
    latest = every.groupBy("file").agg(F.max("load").alias("load"))
    return every.join(latest, ["file", "load"]).select(*every.columns)


def _among(column: Column, values: list[str | None]) -> Column:
    """A filter that Spark can prune folders by, NULL included."""
    found = column.cast("string").isin([v for v in values if v is not None])
    return F.coalesce(found, F.lit(False)) if None not in values else column.isNull() | found


def load_changes(
    spark: SparkSession,
    data_dir: str,
    target: str,
    sep: str = SEPARATOR,
    pattern: str = RECEIPT_FILES,
    id_type: str = "int",
    unit: str = "store_id",
    drop_missing: bool = False,
) -> Load:
    """Bring the receipts below ``target`` up to date with the files in ``data_dir``.

    A file that is no longer there, or empty, keeps its rows, unless ``drop_missing``
    says that they go too. The driver gets the names of changed files and of units to
    replace; listing files and committing folders takes it those anyway.
    """
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit!r}; expected one of {UNITS}")
    target = target.rstrip("/")
    table = f"{target}/transactions"
    with staging(spark) as stage:
        listed = stage(_listed(spark, f"{data_dir.rstrip('/')}/{TRANSACTIONS}/{pattern}"))
        known = stage(manifest(spark, target))
        version = ["file", "size", "changed"]
        changed = listed.join(known.select(version).distinct(), version, "left_anti")
        gone = known.where(F.col("size") != _GONE).select("file").distinct()
        gone = gone.join(listed, "file", "left_anti")
        files = {r.file: r.path for r in changed.collect()}
        missing = [r.file for r in gone.collect()] if drop_missing else []
        if not files and not missing:
            return Load(0, ())

        rows = spark.createDataFrame([], _columns(id_type))
        if files:
            schema = schemas.transactions_schema(id_type)
            read = read_delimited(spark, list(files.values()), schema, sep=sep)
            rows = read.withColumn("source_file", F.col("_metadata.file_path"))
        fresh = stage(rows.withColumn("transaction_date", day()))
        replaced = stage(spark.createDataFrame([(f,) for f in [*files, *missing]], "file string"))
        as_text = F.col(unit).cast("string").alias("unit")
        counts = stage(
            fresh.groupBy(F.col("source_file").alias("file"), as_text).agg(
                F.count("*").alias("rows")
            )
        )
        before = known.where("rows > 0").join(replaced, "file", "left_semi").select("unit")
        units = [r.unit for r in counts.select("unit").union(before).distinct().collect()]

        kept = spark.createDataFrame([], _columns(id_type))
        if path_exists(spark, table):
            present = spark.read.schema(_columns(id_type)).parquet(table)
            others = present.where(_among(F.col(unit), units)).join(
                replaced.withColumnRenamed("file", "source_file"), "source_file", "left_anti"
            )
            # These rows lie in the folders that are about to be replaced.
            kept = stage(others.select(*present.columns))
        content = kept.unionByName(fresh)
        filled = {r.unit for r in content.select(as_text).distinct().collect()}
        if filled:
            (
                content.hint("rebalance", unit)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(unit)
                .parquet(table)
            )
        for empty in set(units) - filled:
            remove_folder(spark, f"{table}/{unit}={_NULL_UNIT if empty is None else empty}")

        number = known.agg(F.coalesce(F.max("load"), F.lit(0)) + 1).first()[0]
        loaded = changed.select(version).join(counts, "file", "left")
        without = spark.createDataFrame(
            [(f,) for f in missing], "file string"
        ).selectExpr("file", f"CAST({_GONE} AS BIGINT) AS size", "CAST(NULL AS TIMESTAMP) AS changed")
        entry = loaded.unionByName(without, allowMissingColumns=True).select(
            *version, "unit", F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(number).alias("load")
        )
        entry.write.mode("append").parquet(f"{target}/manifest")
    return Load(len(files) + len(missing), tuple(sorted(units, key=lambda u: (u is not None, u))))


def read_loaded(
    spark: SparkSession, target: str, id_type: str = "int", files: bool = False
) -> DataFrame:
    """Receipts loaded so far; ``files`` tells which file each comes from."""
    loaded = spark.read.schema(_columns(id_type)).parquet(f"{target.rstrip('/')}/transactions")
    return loaded if files else loaded.drop("source_file")
