"""JSON reports for dashboards.

Two shapes: an *envelope* is one JSON document around a bounded list of rows; a
*series* is any number of rows as JSON lines with a one-line manifest beside
them. Spark writes folders, so ``top_10_products.json`` is a folder with one
part file.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Folders below the report base.
SUMMARY, ANALYTICS, ADVANCED, METADATA = "summary", "analytics", "advanced", "metadata"


def now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _columns(attrs: Mapping) -> list[Column]:
    """Attributes as columns; a value can be one already, e.g. a scalar query."""
    return [
        (v if isinstance(v, Column) else F.lit(v)).alias(name) for name, v in attrs.items()
    ]


def _json(*columns: Column | str, keep_nulls: bool = True) -> Column:
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    return F.to_json(F.struct(*columns), options).alias("value")


def json_records(df: DataFrame, limit: int | None = None, keep_nulls: bool = False) -> DataFrame:
    """Rows as JSON texts; NULL fields are left out unless ``keep_nulls``."""
    rows = df if limit is None else df.limit(limit)
    return rows.select(_json(*df.columns, keep_nulls=keep_nulls))


def write_document(spark: SparkSession, path: str, attrs: Mapping) -> None:
    """One JSON document from single values."""
    one = spark.range(1, numPartitions=1).select(_json(*_columns(attrs)))
    one.write.mode("overwrite").text(path)


def envelope(df: DataFrame, n: int, attrs: Mapping) -> DataFrame:
    """One JSON document with the first ``n`` rows of ``df``, in their order.

    A limit gives one partition; numbering its rows keeps their order through
    the aggregation.
    """
    row = F.struct(F.monotonically_increasing_id().alias("at"), F.struct(*df.columns).alias("row"))
    data = F.sort_array(F.collect_list("numbered"))["row"].alias("data")
    closing = _columns({"generated_at": attrs.get("generated_at", now())})
    opening = _columns({k: v for k, v in attrs.items() if k != "generated_at"})
    return (
        df.limit(n)
        .select(row.alias("numbered"))
        .agg(data)
        .select(_json(*opening, "data", *closing))
    )


def write_envelope(df: DataFrame, path: str, n: int, attrs: Mapping) -> None:
    envelope(df, n, attrs).write.mode("overwrite").text(path)


def write_series(df: DataFrame, path: str, attrs: Mapping) -> None:
    """All rows of ``df`` under ``data``, the attributes under ``manifest``."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    writer.json(f"{path}/data")
    write_document(
        df.sparkSession, f"{path}/manifest", {**attrs, "generated_at": now()}
    )


class Reports:
    """All report kinds below one base path; each method returns where it wrote."""

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def _at(self, *parts: str) -> str:
        return "/".join((self.base, *parts))

    def summary_metrics(self, metrics: DataFrame, filename: str = "metrics.json") -> str:
        """A one-row frame of figures as one document."""
        path = self._at(SUMMARY, filename)
        json_records(metrics, keep_nulls=True).coalesce(1).write.mode("overwrite").text(path)
        return path

    def document(self, attrs: Mapping, filename: str, spark: SparkSession) -> str:
        """Single values, known already, as one document."""
        path = self._at(SUMMARY, filename)
        write_document(spark, path, attrs)
        return path

    def top_items(self, df: DataFrame, item_type: str, top_n: int = 10) -> str:
        path = self._at(SUMMARY, f"top_{top_n}_{item_type}.json")
        write_envelope(df, path, top_n, {"type": item_type, "top_n": top_n})
        return path

    def time_series(
        self, df: DataFrame, name: str, date_column: str = "date", value_column: str = "count"
    ) -> str:
        """The two columns are labels for the reader and are not looked up."""
        path = self._at(ANALYTICS, f"{name}.json")
        labels = {"series_name": name, "date_column": date_column, "value_column": value_column}
        write_series(df, path, labels)
        return path

    def distribution(self, df: DataFrame, name: str) -> str:
        path = self._at(ANALYTICS, f"{name}_distribution.json")
        write_series(df, path, {"distribution_name": name})
        return path

    def matrix(self, cells: DataFrame, name: str = "correlation_matrix") -> str:
        """A matrix in long form, one row per cell: row, column, value."""
        path = self._at(ANALYTICS, f"{name}.json")
        write_series(cells, path, {"matrix_name": name})
        return path

    def clusters(self, assignments: DataFrame, profiles: DataFrame, n_clusters: int) -> list[str]:
        """All assignments, with their number in the manifest, and the profiles."""
        folder = self._at(ADVANCED, "clustering")
        members, summary = f"{folder}/customer_clusters.json", f"{folder}/cluster_summary.json"
        total = assignments.agg(F.count("*")).scalar()
        write_series(assignments, members, {"n_clusters": n_clusters, "total_customers": total})
        write_series(profiles, summary, {"n_clusters": n_clusters})
        return [members, summary]

    def recommendations(self, df: DataFrame, kind: str = "product_associations") -> str:
        path = self._at(ADVANCED, "recommendations", f"{kind}.json")
        write_series(df, path, {"recommendation_type": kind})
        return path

    def run_metadata(
        self, spark: SparkSession, dag_id: str, task_id: str, info: Mapping
    ) -> str:
        """What ran and when; keys of ``info`` take the place of standard ones."""
        path = self._at(METADATA, f"{dag_id}_{task_id}.json")
        standard = {"dag_id": dag_id, "task_id": task_id, "execution_timestamp": now()}
        write_document(spark, path, {**standard, **info})
        return path
