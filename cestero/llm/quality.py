"""Quality by histogram gradient-boosted trees over statistics of documents.

The statistics look at bytes, words, lines and their repetition. Trees are
grown level by level over binned statistics with Newton steps on the log loss,
and flattened into five arrays, which a batch of documents walks through
together, one level per step.

A null text counts as the empty one, which gets statistics of zero and a score
like any other; a text of any length is read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cestero.llm.text import Memo, kept_by, labelled_texts, mixed, slices, word_hash

#: Texts to learn from, at most; their statistics are what the driver gets.
SAMPLE = 20_000
THRESHOLD = 0.7
BINS, DEPTH, TREES, RATE = 64, 5, 120, 0.1
#: Smallest sum of second derivatives in a leaf, and the L2 penalty of its value.
LEAF, PENALTY = 4.0, 1.0

_BYTES = np.arange(256)
_IS = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "high": _BYTES >= 128,
    "line": _BYTES == 10,
    "space": np.isin(_BYTES, [9, 11, 12, 13, 32]),
    "stop": np.isin(_BYTES, list(b".,;:?")),
    "loud": _BYTES == 33,
    "quote": np.isin(_BYTES, list(b"\"'()-")),
    "symbol": np.isin(_BYTES, list(b"#$%&*+/<=>@[\\]^_`{|}~")),
}
_KINDS = np.array(list(_IS.values()), float).T

STATISTICS = (
    *(f"share_{kind}" for kind in _IS),
    "log_bytes",
    "log_words",
    "mean_length",
    "deviation_of_length",
    "share_long",
    "share_capitals",
    "share_odd_ending",
    "share_no_letter",
    "different_words",
    "different_pairs",
    "most_frequent_word",
    "same_as_last",
    "same_as_last_but_one",
    "log_lines",
    "different_lines",
    "words_a_line",
)


def _traits(chunk: str) -> tuple[int, int]:
    """Hash of a word; its length, above three bits of flags."""
    bare = chunk.rstrip(".,;:?!\"')")
    odd = bool(bare) and not bare[-1].isalnum()
    letters = any(c.isalpha() for c in chunk)
    flags = (len(chunk) > 1 and chunk.isupper()) | odd << 1 | (not letters) << 2
    return word_hash(chunk), len(chunk) << 3 | flags


def statistics(text: str, memo: Memo) -> np.ndarray:
    """One row of ``STATISTICS``."""
    kinds, found = np.zeros(256, np.int64), []
    for piece in slices(text):
        raw = np.frombuffer(piece.encode("utf-8", "surrogatepass"), np.uint8)
        kinds += np.bincount(raw, minlength=256)
        found += [memo[w] for w in piece.split()]
    out = np.zeros(len(STATISTICS))
    size, n = int(kinds.sum()), len(found)
    if not size:
        return out
    base = len(_IS)
    out[:base] = kinds @ _KINDS / size
    out[base] = np.log1p(size)
    lines = text.split("\n") if kinds[10] else [text]
    out[base + 13] = np.log1p(len(lines))
    out[base + 14] = len(set(lines)) / len(lines)
    out[base + 15] = n / len(lines)
    if n:
        words = np.array([w for w, _ in found], np.uint64)
        trait = np.array([t for _, t in found], np.int64)
        length = trait >> 3
        counts = np.unique(words, return_counts=True)[1]
        out[base + 1 : base + 9] = (
            np.log1p(n),
            length.mean(),
            length.std(),
            (length > 20).mean(),
            (trait & 1).mean(),
            (trait >> 1 & 1).mean(),
            (trait >> 2 & 1).mean(),
            len(counts) / n,
        )
        pairs = mixed(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
        out[base + 9] = len(np.unique(pairs)) / max(n - 1, 1)
        out[base + 10] = counts.max() / n
        out[base + 11] = (words[1:] == words[:-1]).sum() / n
        out[base + 12] = (words[2:] == words[:-2]).sum() / n
    return out


@dataclass(frozen=True)
class QualityModel:
    """All trees in five arrays; a leaf is its own child."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        node = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            low = x[row, self.feature[node]] <= self.cut[node]
            node = np.where(low, self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -35, 35)))


def _cuts(column: np.ndarray) -> np.ndarray:
    """At most BINS - 1 cuts between values, at the quantiles."""
    values = np.unique(column)
    if len(values) > BINS:
        values = np.unique(np.quantile(column, np.linspace(0, 1, BINS), method="lower"))
    return (values[1:] + values[:-1]) / 2


def fit_trees(x: np.ndarray, y: np.ndarray) -> QualityModel:
    """Boosted trees; without both classes, the share of ones alone."""
    rows, width = x.shape
    share = np.clip(y.mean() if rows else 0.5, 0.01, 0.99)
    start = float(np.log(share / (1 - share)))
    cuts = [_cuts(x[:, f]) for f in range(width)] if rows else []
    binned = [np.searchsorted(cuts[f], x[:, f], side="left") for f in range(len(cuts))]
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def leaf() -> int:
        k = len(feature)
        feature.append(0), cut.append(0.0), left.append(k), right.append(k), value.append(0.0)
        return k

    margin = np.full(rows, start)
    for _ in range(TREES if rows and 0 < y.mean() < 1 else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        level = [leaf()]
        roots.append(level[0])
        place = np.zeros(rows, np.int64)  # index into level; the last is: settled
        at = np.full(rows, level[0])
        for depth in range(DEPTH + 1):
            m = len(level)
            sums_g = np.bincount(place, g, m + 1)[:m]
            sums_h = np.bincount(place, h, m + 1)[:m]
            for k, node in enumerate(level):
                value[node] = RATE * sums_g[k] / (sums_h[k] + PENALTY)
            if depth == DEPTH:
                break
            best = [(1e-3, -1, 0)] * m
            whole = sums_g**2 / (sums_h + PENALTY)
            for f in range(width):
                if not len(cuts[f]):
                    continue
                cell, shape = place * BINS + binned[f], (m + 1, BINS)
                low_g = np.bincount(cell, g, shape[0] * BINS).reshape(shape)[:m].cumsum(1)
                low_h = np.bincount(cell, h, shape[0] * BINS).reshape(shape)[:m].cumsum(1)
                high_g, high_h = sums_g[:, None] - low_g, sums_h[:, None] - low_h
                gain = low_g**2 / (low_h + PENALTY) + high_g**2 / (high_h + PENALTY)
                gain -= whole[:, None]
                gain[(low_h < LEAF) | (high_h < LEAF)] = 0
                top = gain[:, : len(cuts[f])].argmax(axis=1)
                for k in range(m):
                    if gain[k, top[k]] > best[k][0]:
                        best[k] = (gain[k, top[k]], f, int(top[k]))
            following, settled = [], np.full(rows, True)
            target = np.zeros(rows, np.int64)
            for k, (_, f, b) in enumerate(best):
                if f < 0:
                    continue
                node, (low, high) = level[k], (leaf(), leaf())
                feature[node], cut[node] = f, float(cuts[f][b])
                left[node], right[node] = low, high
                inside = place == k
                goes_low = inside & (binned[f] <= b)
                goes_high = inside & ~goes_low
                at[goes_low], at[goes_high] = low, high
                target[goes_low], target[goes_high] = len(following), len(following) + 1
                settled[inside] = False
                following += [low, high]
            place = np.where(settled, len(following), target)
            level = following
            if not level:
                break
        margin += np.asarray(value)[at]
    if not roots:
        roots.append(leaf())
    return QualityModel(
        np.array(feature, np.int32),
        np.array(cut),
        np.array(left, np.int32),
        np.array(right, np.int32),
        np.array(value),
        np.array(roots, np.int32),
        start,
    )


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Learn ``labels.quality``; statistics are made on the executors."""
    texts = labelled_texts(documents, labels, "quality", sample)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by("quality")
        memo = Memo(_traits)
        for batch in batches:
            x = [statistics(t, memo).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": x, "label": batch["label"]})

    got = texts.mapInPandas(measured, "doc_id long, x binary, label int").toPandas()
    got = got.sort_values(["doc_id", "label", "x"])
    x = np.array([np.frombuffer(v) for v in got["x"]]).reshape(len(got), len(STATISTICS))
    return fit_trees(x, got["label"].to_numpy(float))


def quality(text: Column, model: QualityModel) -> Column:
    """Probability that a text is of quality 1, as a column of doubles without nulls."""

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept_by("quality")
        memo = Memo(_traits)
        for batch in batches:
            scores = [
                model.score(np.array([statistics(t, memo) for t in batch.iloc[k : k + 1000]]))
                for k in range(0, len(batch), 1000)
            ]
            yield pd.Series(np.concatenate(scores) if scores else np.zeros(0))

    return score(F.coalesce(text, F.lit("")))
