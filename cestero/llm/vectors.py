"""What the two vector searches share: valid rows, cells, and the last ranking."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESULT = "query_id long, query_key long, vec_id long, score {}"


def usable(embeddings: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of rows with an id whose vector has finite components only."""
    bad = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    return embeddings.where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad
    ).select("vec_id", "embedding")


def cells(
    vectors: DataFrame, queries: DataFrame, share: Column, shares: int, group: int
) -> tuple[DataFrame, DataFrame]:
    """Both tables, keyed by ``share`` of the vectors and ``party`` of the queries.

    A stated query set against all rows, in blocks: a cell holds one share of the
    vectors and at most about ``group`` queries. Queries alike in id and vector
    are one query.
    """
    queries = queries.withColumn("query_key", F.xxhash64("embedding")).dropDuplicates(
        ["vec_id", "query_key"]
    )
    parties = max(1, -(-queries.count() // group))
    party = F.pmod(F.xxhash64("vec_id", "query_key"), F.lit(parties)).cast("int")
    left = vectors.withColumn("share", share).withColumn(
        "party", F.explode(F.sequence(F.lit(0), F.lit(parties - 1)))
    )
    right = queries.withColumn("party", party).withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
    )
    return left, right


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each query: ``query_id, rank, vec_id, score``."""
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def matrix(column: pd.Series, width: int = 0) -> np.ndarray:
    """Rows of doubles; shorter vectors are filled up with zeros."""
    lengths = {len(v) for v in column}
    width = max(lengths | {width})
    if lengths == {width} and width:
        return np.stack(column.to_list()).astype(np.float64)
    out = np.zeros((len(column), width))
    for row, v in zip(out, column):
        row[: len(v)] = v
    return out


def best(query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Index of the best ``k`` rows of each query, queries in order."""
    order = np.lexsort((vec_id, -score, query))
    q = query[order]
    new = np.ones(len(q), bool)
    new[1:] = q[1:] != q[:-1]
    start = np.flatnonzero(new)
    rank = np.arange(len(q)) - start[np.cumsum(new) - 1] if len(q) else start
    return order[rank < k]
