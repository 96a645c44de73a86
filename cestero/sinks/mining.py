"""Itemsets and rules on storage, as flat CSV or to be used again."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = ","


@dataclass(frozen=True)
class MiningParameters:
    """What a stored search was made with: its input, by a name and a fingerprint, and how."""

    source: str
    fingerprint: str
    min_support: float
    min_confidence: float

    def folder(self, path: str) -> str:
        """Own folder of these parameters, so that no other search writes there."""
        digest = hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()
        return f"{path.rstrip('/')}/{digest[:20]}"


def fingerprint(baskets: DataFrame) -> str:
    """Number of baskets and a sum of their hashes, whatever their order, in one pass."""
    each = F.xxhash64(F.sort_array("items")).cast("decimal(38,0)")
    row = baskets.agg(F.count("*"), F.coalesce(F.sum(each), F.lit(0))).first()
    return f"{row[0]}:{row[1]}"


def flat(df: DataFrame) -> DataFrame:
    """Array columns joined by commas, as CSV can hold them.

    A comma within an item is written as ``%2C``, a percent sign as ``%25``.
    """

    def joined(column: str) -> Column:
        items = F.transform(
            column, lambda i: F.replace(F.replace(i, F.lit("%"), F.lit("%25")), F.lit(","), F.lit("%2C"))
        )
        return F.array_join(items, SEPARATOR).alias(column)

    arrays = {name for name, kind in df.dtypes if kind.startswith("array")}
    return df.select(*(joined(c) if c in arrays else F.col(c) for c in df.columns))


def _items(column: str) -> Column:
    """The items that ``flat`` has joined."""
    return F.transform(
        F.split(column, SEPARATOR),
        lambda i: F.replace(F.replace(i, F.lit("%2C"), F.lit(",")), F.lit("%25"), F.lit("%")),
    )


# Items keep outer spaces, quotes and backslashes.
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str) -> None:
    flat(df).write.mode("overwrite").options(**_CSV).csv(path)


def read_itemsets_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema("items string, freq bigint").options(**_CSV).csv(path)
    return raw.withColumn("items", _items("items"))


def read_rules_csv(spark: SparkSession, path: str) -> DataFrame:
    fields = "antecedent string, consequent string, confidence double, lift double, support double"
    raw = spark.read.schema(fields).options(**_CSV).csv(path)
    return raw.withColumns({c: _items(c) for c in ("antecedent", "consequent")})


def save_mining(
    itemsets: DataFrame, rules: DataFrame, path: str, parameters: MiningParameters
) -> None:
    """Store both frames as Parquet; the parameters last, as a sign of completion."""
    spark = itemsets.sparkSession
    path = parameters.folder(path)
    itemsets.write.mode("overwrite").parquet(f"{path}/itemsets")
    rules.write.mode("overwrite").parquet(f"{path}/rules")
    used = [F.lit(v).alias(k) for k, v in asdict(parameters).items()]
    row = spark.range(1, numPartitions=1).select(*used)
    row.write.mode("overwrite").parquet(f"{path}/parameters")


def load_mining(
    spark: SparkSession, path: str, parameters: MiningParameters
) -> tuple[DataFrame, DataFrame] | None:
    """Stored itemsets and rules, if they were made with just these parameters."""
    path = parameters.folder(path)
    try:
        fields = "source string, fingerprint string, min_support double, min_confidence double"
        stored = spark.read.schema(fields)
        used = stored.parquet(f"{path}/parameters").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if used is None or used.asDict() != asdict(parameters):
        return None
    return spark.read.parquet(f"{path}/itemsets"), spark.read.parquet(f"{path}/rules")
