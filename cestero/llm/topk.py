"""Exact top-k inner products by block-at-a-time pruning.

Vectors are cut into blocks of consecutive ids; a block keeps the largest and the
smallest value of each term (component). The sum over a query's terms of
the product with that maximum, or minimum where the query is negative, bounds
every score in the block. A query takes the blocks of a share in the order of
their bounds, scores them through their forward index, and stops at the first
bound below its k-th score so far.

Components become floor(1024 x). Scores are exact: in doubles while no sum can
pass 2 ** 53, otherwise in 64-bit integers; where these might not hold a score, it
is an error. Without rows the result is empty. Vectors of
different lengths are compared as if filled up with zeros. Rows without an id and
vectors with a null or non-finite component take no part; rows of one id are
never each other's candidates; repeated candidates are all ranked.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cestero.llm.vectors import RESULT, best, cells, matrix, ranked, usable

SCALE = 1024
#: Vectors of a share and of a block, queries of a cell.
SHARE, BLOCK, GROUP = 1 << 14, 256, 1024
_LEAST = np.iinfo(np.int64).min


def whole_terms(vectors: np.ndarray) -> np.ndarray:
    whole = np.floor(vectors * SCALE)
    if np.abs(whole).max(initial=0) >= 2.0**63:
        raise OverflowError("a component does not fit 64 bits")
    return whole.astype(np.int64)


def share_of(vec_id: Column, spread: Column, limits: list[float]) -> Column:
    """Number of a row's share: how many of the sorted ``limits`` its id has reached.

    Where two limits are one id, its rows go where ``spread`` says. One look-up a
    row, however many shares there are.
    """
    cuts = np.array(limits)
    crowded = np.unique(cuts[1:][cuts[1:] == cuts[:-1]])

    @F.pandas_udf("int")
    def found(ids: pd.Series, spreads: pd.Series) -> pd.Series:
        share = np.searchsorted(cuts, ids.to_numpy(), side="right")
        return pd.Series(np.where(np.isin(ids.to_numpy(), crowded), spreads.to_numpy(), share).astype(np.int32))

    return found(vec_id, spread)


def _longest(terms: np.ndarray) -> float:
    return float(np.sqrt((terms.astype(float) ** 2).sum(axis=1)).max(initial=0)) * (1 + 1e-9)


def search_share(ids: np.ndarray, terms: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """``query, score, vec_id`` of each query's best ``k`` in a share, and how many blocks were scored."""
    order = np.argsort(ids, kind="stable")
    ids, terms = ids[order], terms[order]
    starts = np.arange(0, len(ids), BLOCK)
    high = np.maximum.reduceat(terms, starts).astype(float)
    low = np.minimum.reduceat(terms, starts).astype(float)
    # No score is above the product of the lengths.
    top = _longest(terms) * _longest(queries)
    if top >= 2.0**63:
        raise OverflowError("a score may not fit 64 bits")
    top = float(np.abs(terms).max(initial=0)) * float(np.abs(queries).max(initial=0)) * terms.shape[1]
    kind = np.float64 if top < 2.0**53 else np.int64
    terms, queries = terms.astype(kind), queries.astype(kind)
    q = queries.astype(float)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    if kind is np.int64:  # the bound itself is rounded
        bounds += np.abs(bounds) * 1e-12
    by_bound = np.argsort(-bounds, axis=1, kind="stable")
    kth = np.full(len(queries), -np.inf)
    found = tuple(np.zeros(0, np.int64) for _ in range(3))
    scored = 0
    for step in range(len(starts)):
        block = by_bound[:, step]
        due = np.flatnonzero(bounds[np.arange(len(queries)), block] >= kth)
        if not len(due):
            break
        scored += len(due)
        due = due[np.argsort(block[due], kind="stable")]
        edges = np.flatnonzero(np.diff(block[due])) + 1
        hits = [found]
        for part in np.split(due, edges):
            b = starts[block[part[0]]]
            own = ids[b : b + BLOCK]
            score = (queries[part] @ terms[b : b + BLOCK].T).astype(np.int64)
            i, j = np.nonzero((score >= kth[part, None]) & (own != query_ids[part, None]))
            hits.append((part[i], score[i, j], own[j]))
        found = tuple(np.concatenate(x) for x in zip(*hits))
        kept = best(*found, k)
        found = tuple(x[kept] for x in found)
        counts = np.bincount(found[0], minlength=len(queries))
        last = np.cumsum(counts) - 1
        full = counts >= k
        kth[full] = found[1][last[full]]
    return *found, scored


def top_k(embeddings: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each row of ``queries`` against all of ``embeddings``."""
    vectors = usable(embeddings)
    rows = vectors.count()
    shares = max(1, -(-rows // SHARE))
    # Shares are ranges of ids; equal ids, however many, spread over the shares by their vectors.
    places = [i / shares for i in range(1, shares)]
    share = F.lit(0)
    if places:
        limits = vectors.approxQuantile("vec_id", places, min(1e-3, 0.1 / shares))
        spread = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shares)).cast("int")
        share = share_of(F.col("vec_id"), spread, limits)
    left, right = cells(vectors, usable(queries), share, shares, GROUP)

    def search(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(asked):
            return pd.DataFrame({c: [] for c in ("query_id", "query_key", "vec_id", "score")})
        width = max(map(len, [*candidates["embedding"], *asked["embedding"]]))
        q, score, vec_id, _ = search_share(
            candidates["vec_id"].to_numpy(),
            whole_terms(matrix(candidates["embedding"], width)),
            asked["vec_id"].to_numpy(),
            whole_terms(matrix(asked["embedding"], width)),
            k,
        )
        return pd.DataFrame(
            {
                "query_id": asked["vec_id"].to_numpy()[q],
                "query_key": asked["query_key"].to_numpy()[q],
                "vec_id": vec_id,
                "score": score,
            }
        )

    key = ["share", "party"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(search, RESULT.format("long"))
    return ranked(found, k)
