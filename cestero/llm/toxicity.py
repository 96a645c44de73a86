"""Toxicity by FTRL-proximal logistic regression over hashed words and pairs.

A text's features are the sets of its words, of its neighbouring pairs
(bigrams) and of its pairs with one or two words between (skip-grams), each
hashed to one of ``2 ** BITS`` coordinates. FTRL-proximal learns a rate per
coordinate and drives the weights of all uninformative ones to exactly zero
(L1), so a model is a short list of coordinates and weights whatever the
corpus is.

A null or empty text has no feature and scores the intercept; repeated words
count once; a text of any length is scored whole. Repeated rows and rows without
an id are scored like all others; learning takes labelled rows with an id only,
a repeated one each time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cestero.llm.text import Memo, kept_by, labelled_texts, mixed, word_hash, word_hashes

BITS = 20
#: Texts to learn from, at most, and features of them in all, which are 4 bytes each.
SAMPLE, FEATURES = 10_000, 1 << 26
THRESHOLD = 0.3

# One odd multiplier for each distance between the two words of a pair.
_PAIRS = {
    1: np.uint64(0x9E3779B97F4A7C15),
    2: np.uint64(0xC2B2AE3D27D4EB4F),
    3: np.uint64(0x165667B19E3779F9),
}


def coordinates(words: np.ndarray) -> np.ndarray:
    """Of all features of a text, repeats included."""
    parts = [words >> np.uint64(64 - BITS)]
    for gap, factor in _PAIRS.items():
        if len(words) > gap:
            pair = mixed(words[:-gap] * factor + words[gap:])
            parts.append(pair >> np.uint64(64 - BITS))
    return np.concatenate(parts).astype(np.int32)


@dataclass(frozen=True)
class ToxicityModel:
    """Sparse weights: sorted coordinates, their weights, and the intercept."""

    index: np.ndarray
    weight: np.ndarray
    intercept: float

    def table(self) -> np.ndarray:
        dense = np.zeros(1 << BITS, np.float32)
        dense[self.index] = self.weight
        return dense


class Examples:
    """Features of texts one after the other in one array, with where each text begins."""

    def __init__(self, flat: np.ndarray, start: np.ndarray, labels: np.ndarray):
        self.flat, self.start, self.labels = flat, start, labels

    def __len__(self) -> int:
        return len(self.labels)

    def __getitem__(self, k: int) -> tuple[np.ndarray, float]:
        return self.flat[self.start[k] : self.start[k + 1]], self.labels[k]


def fit_ftrl(
    rows: Sequence[tuple[np.ndarray, int]],
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 2.5,
    l2: float = 0.0,
    epochs: int = 4,
) -> ToxicityModel:
    """Follow the regularised leader, one text after the other.

    Without rows, or without both classes, the intercept alone is learnt.
    """
    size = (1 << BITS) + 1  # the last one is the intercept, free of L1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - l1, 0)
        if i[-1] == size - 1:
            shrunk[-1] = zi[-1]
        return -shrunk / ((beta + np.sqrt(n[i])) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            found, label = rows[k]
            i = np.append(found, size - 1)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - label
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    every = weights(np.arange(size))
    index = np.flatnonzero(every[:-1])
    return ToxicityModel(
        index.astype(np.int32), every[index].astype(np.float32), float(every[-1])
    )


def within(sizes: Iterable[int], most: int) -> int:
    """How many of ``sizes``, from the first on, add up to ``most`` or less."""
    count = 0
    for size in sizes:
        most -= size
        if most < 0:
            break
        count += 1
    return count


def fit(
    documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = FEATURES
) -> ToxicityModel:
    """Learn ``labels.toxic``; features are made and learnt from on the executors.

    At most ``sample`` texts, in the order of a hash of the id, and of these the
    first whose features are ``most`` at most. One task learns from them, and the
    driver gets the weights that are not zero.
    """
    texts = labelled_texts(documents, labels, "toxic", sample)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept_by("toxicity")
        memo = Memo(word_hash)
        for batch in batches:
            for k in range(0, len(batch), 64):
                part = batch.iloc[k : k + 64]
                found = [np.unique(coordinates(word_hashes(t, memo))).tobytes() for t in part["text"]]
                yield pd.DataFrame(
                    {"doc_id": part["doc_id"], "features": found, "label": part["label"]}
                )

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_by("toxicity")
        flat, sizes, labels_, room = [np.zeros(0, np.int32)], [], [], most
        for batch in filter(len, batches):
            column = batch.column("features")
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset :][: len(column) + 1] // 4
            own = np.diff(ends)
            count = within(own.tolist(), room)
            values = np.frombuffer(column.buffers()[2] or b"", np.int32)
            flat.append(values[ends[0] : ends[count]].copy())
            sizes.append(own[:count])
            labels_.append(batch.column("label").to_numpy()[:count])
            room -= len(flat[-1])
            if count < len(own):
                break
        start = np.cumsum(np.concatenate(([0], *sizes)))
        examples = Examples(np.concatenate(flat), start, np.concatenate([[], *labels_]))
        model = fit_ftrl(examples)
        yield pa.RecordBatch.from_pydict(
            {
                "index": pa.array([model.index], pa.list_(pa.int32())),
                "weight": pa.array([model.weight], pa.list_(pa.float32())),
                "intercept": pa.array([model.intercept]),
            }
        )

    made = texts.mapInPandas(features, "doc_id long, features binary, label int")
    in_order = made.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "label", "features")
    got = in_order.mapInArrow(learnt, "index array<int>, weight array<float>, intercept double").first()
    if got is None:  # no row to learn from
        return fit_ftrl([])
    return ToxicityModel(
        np.array(got["index"], np.int32), np.array(got["weight"], np.float32), got["intercept"]
    )


def toxicity(text: Column, model: ToxicityModel) -> Column:
    """Probability that a text is toxic, as a column of doubles without nulls."""

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept_by("toxicity")
        memo, weight = Memo(word_hash), model.table()
        for batch in batches:
            sums = np.full(len(batch), model.intercept)
            for k, value in enumerate(batch):
                i = coordinates(word_hashes(value, memo))
                i = np.unique(i[weight[i] != 0])
                sums[k] += weight[i].sum(dtype=np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -35, 35))))

    return score(F.coalesce(text, F.lit("")))
