"""Choice of a source by name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from cestero.sources.delimited import DelimitedSource
from cestero.sources.jdbc import JdbcSource

# Names of the two kinds of source.
KINDS = {"postgres": JdbcSource, "s3": DelimitedSource}

# Environment variables that set up a source, by their setting.
ENVIRONMENT = {
    "postgres": {
        "host": "POSTGRES_HOST",
        "port": "POSTGRES_PORT",
        "database": "POSTGRES_DB",
        "user": "POSTGRES_USER",
        "password": "POSTGRES_PASSWORD",
        "partition_column": "POSTGRES_PARTITION_COLUMN",
        "partitions": "POSTGRES_PARTITIONS",
        "lower": "POSTGRES_PARTITION_LOWER",
        "upper": "POSTGRES_PARTITION_UPPER",
    },
    "s3": {
        "base": "S3_DATA_BASE_URI",
        "transactions_path": "S3_TRANSACTIONS_PATH",
        "categories_path": "S3_CATEGORIES_PATH",
        "product_categories_path": "S3_PRODUCT_CATEGORIES_PATH",
        "sep": "S3_FILE_SEPARATOR",
    },
}


def settings_from(environment: Mapping[str, str]) -> dict[str, str]:
    """Arguments of ``open_source`` as far as the environment gives them."""
    kind = environment.get("DATA_SOURCE", "postgres")
    names = ENVIRONMENT.get(kind.lower(), {})
    found = {key: environment[name] for key, name in names.items() if name in environment}
    return {"kind": kind, **found}


def open_source(spark: SparkSession, kind: str = "postgres", **settings):
    """Source of the given kind: ``postgres`` reads tables, ``s3`` reads files.

    Files may lie on any Hadoop file system (``s3a://``, ``hdfs://``, ``file:``).
    """
    make = KINDS.get(kind.lower())
    if make is None:
        raise ValueError(f"unknown source {kind!r}; expected one of {sorted(KINDS)}")
    if make is DelimitedSource and not settings.get("base"):
        raise ValueError("a file source needs a base path")
    return make(spark, **settings)
