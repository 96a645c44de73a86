"""Explicit schemas of the input files; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def transactions_schema(id_type: str = "int") -> T.StructType:
    """Receipts as they lie in the files: the date is still text."""
    return T.StructType.fromDDL(
        f"transaction_date string, store_id int, customer_id {id_type}, products string"
    )


def product_categories_schema(id_type: str = "int") -> T.StructType:
    return T.StructType.fromDDL(f"product_id {id_type}, category_id int")


def categories_schema() -> T.StructType:
    return T.StructType.fromDDL("category_id int, category_name string")
