"""Approximate nearest neighbours by a forest of hash prefixes.

Every tree gives a vector a string of ``BITS`` bits, the sides of as many random
hyperplanes, and keeps the strings of a share of the vectors in a sorted array. The
vectors that share a prefix of any length with a query are one stretch of the
array. A query descends to its longest prefix in each tree and ascends in all
trees together, a bit at a time, tree after tree, until it has met ``MET`` of the
share; those are compared by their exact inner product.

So that a near hash means a large inner product also where lengths differ, a
vector gets one component more, which brings all to the same length, and a
query a zero. Scores are inner products of the vectors as they are, in doubles.

Every row is indexed and no bucket is cut off. Rows without an id, and vectors
that are zero or have a null or non-finite component, take no part; rows of one
id are never each other's candidates; shorter vectors are filled up with zeros.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cestero.llm.vectors import RESULT, best, cells, matrix, ranked, usable

TREES, BITS = 48, 24
#: Share of the vectors that a query compares with. Vectors without any clusters
#: in 64 dimensions need this much for a recall over 0.9.
MET = 0.5
#: Vectors of a share, and queries of a cell.
SHARE, GROUP = 1 << 16, 4096
#: Rows met at least, so that a small share loses nothing.
FEW = 1536


def _strings(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """One integer of BITS bits for each tree and vector."""
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
    out = np.empty((TREES, len(vectors)), np.int64)
    for k in range(TREES):
        sides = vectors @ planes[:, k * BITS : (k + 1) * BITS] > 0
        out[k] = sides @ weights
    return out


class Forest:
    """Sorted strings, and where their vectors are, for each tree."""

    def __init__(self, vectors: np.ndarray):
        squares = (vectors**2).sum(axis=1)
        rest = np.sqrt(np.maximum(squares.max() - squares, 0))
        self.planes = np.random.default_rng(11).standard_normal((vectors.shape[1] + 1, TREES * BITS))
        self.planes = self.planes.astype(np.float32)
        strings = _strings(np.column_stack((vectors, rest)).astype(np.float32), self.planes)
        self.order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(strings, self.order, axis=1)
        self.rows = len(vectors)

    def met(self, queries: np.ndarray, wanted: int):
        """For each query, the rows it meets: at least ``wanted``, or all there are."""
        padded = np.column_stack((queries, np.zeros(len(queries)))).astype(np.float32)
        strings = _strings(padded, self.planes)
        low = np.empty((BITS + 1, TREES, len(queries)), np.int32)
        high = np.empty_like(low)
        for depth in range(BITS + 1):
            cut = BITS - depth
            first = strings >> cut << cut
            for k in range(TREES):
                low[depth, k] = np.searchsorted(self.sorted[k], first[k])
                high[depth, k] = np.searchsorted(self.sorted[k], first[k] + (1 << cut))
        sizes = (high - low).sum(axis=1)
        for q in range(len(queries)):
            # Shallower than this the trees have enough rows between them, repeats included.
            depth = max(int(np.count_nonzero(sizes[:, q] >= wanted)) - 1, 0)
            seen = np.zeros(self.rows, bool)
            if depth < BITS:
                for k in range(TREES):  # what the descent met below
                    seen[self.order[k, low[depth + 1, k, q] : high[depth + 1, k, q]]] = True
            count = np.count_nonzero(seen)
            while count < wanted and depth >= 0:
                for k in range(TREES):
                    seen[self.order[k, low[depth, k, q] : high[depth, k, q]]] = True
                    if k % 4 == 3:
                        count = np.count_nonzero(seen)
                        if count >= wanted:
                            break
                depth -= 1
            yield np.flatnonzero(seen)


def _reduced(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in float32 and their lengths, by a power of two that leaves no component over 1."""
    scaled = np.ldexp(rows, -np.frexp(np.abs(rows).max(initial=0.0))[1])
    return scaled.astype(np.float32), np.sqrt((scaled**2).sum(axis=1))


def contenders(rough: np.ndarray, lengths: np.ndarray, width: int, k: int) -> np.ndarray:
    """Index of all rows that can be among the best ``k``, or tie with one that is.

    A float32 score of ``width`` products is off by less than ``margin``, which grows
    with the product of both ``lengths``. Rows go whose score is certainly under
    that of ``k`` others.
    """
    margin = (width + 8) * 2.0**-23 * lengths + width * 2.0**-120
    low = rough - margin
    return np.flatnonzero(rough + margin >= np.partition(low, len(low) - k)[len(low) - k])


def search_share(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, met: float):
    """``query, score, vec_id`` of each query's nearest ``k`` among the rows it meets."""
    forest = Forest(vectors)
    wanted = min(len(ids), max(int(met * len(ids)), min(FEW, len(ids)), k + 1))
    single, lengths = _reduced(vectors)
    out = []
    for q, rows in enumerate(forest.met(queries, wanted)):
        rows = rows[ids[rows] != query_ids[q]]
        if len(rows) > 4 * k:
            asked, length = _reduced(queries[q : q + 1])
            rows = rows[contenders(single[rows] @ asked[0], lengths[rows] * length, vectors.shape[1], k)]
        score = (vectors[rows] * queries[q]).sum(axis=1)
        kept = best(np.zeros(len(rows), np.int64), score, ids[rows], k)
        out.append((np.full(len(kept), q), score[kept], ids[rows[kept]]))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 20, met: float = MET) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each row of ``queries`` against all of ``embeddings``."""

    def not_zero(rows: DataFrame) -> DataFrame:
        return rows.where(F.exists("embedding", lambda x: x != 0))

    vectors = not_zero(usable(embeddings))
    shares = max(1, -(-vectors.count() // SHARE))
    share = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shares)).cast("int")
    left, right = cells(vectors, not_zero(usable(queries)), share, shares, GROUP)

    def search(candidates: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(asked):
            return pd.DataFrame({c: [] for c in ("query_id", "query_key", "vec_id", "score")})
        width = max(map(len, [*candidates["embedding"], *asked["embedding"]]))
        q, score, vec_id = search_share(
            candidates["vec_id"].to_numpy(),
            matrix(candidates["embedding"], width),
            asked["vec_id"].to_numpy(),
            matrix(asked["embedding"], width),
            k,
            met,
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
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(search, RESULT.format("double"))
    return ranked(found, k)
