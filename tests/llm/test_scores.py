"""Quality and toxicity: held-out accuracy, odd rows, and what a model may see."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cestero.llm import quality, queries, toxicity
from cestero.llm.text import Memo, held_out, table


@pytest.mark.parametrize(
    "name, label, least", [("op1_quality", "quality", 0.95), ("op2_toxicity", "toxic", 0.85)]
)
def test_held_out_accuracy_and_contract(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    got = queries.QUERIES[name](spark, folder).toPandas()
    assert list(got.columns[:4]) == ["doc_id", "held_out", "score", "predicted"]
    assert len(got) == table(spark, folder, "documents").count()
    assert got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    labels = table(spark, folder, "labels").toPandas()
    rows = got[got.held_out].merge(labels, "left", on="doc_id").dropna(subset=[label])
    assert (rows.predicted == rows[label]).mean() >= least


@pytest.fixture(scope="module")
def labels(odd):
    return odd.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))


@pytest.mark.parametrize("module, score", [(quality, quality.quality), (toxicity, toxicity.toxicity)])
def test_odd_rows_get_a_score_each(odd, nothing, labels, module, score):
    """One class only, then no labels at all: the share of ones is all there is to learn."""
    for known in (labels, labels.limit(0)):
        model = module.fit(odd, known)
        scores = [r.s for r in odd.select(score(F.col("text"), model).alias("s")).collect()]
        assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert nothing.select(score(F.col("text"), model).alias("s")).count() == 0


def test_a_model_learns_from_no_held_out_row(spark, odd):
    ids = [r.doc_id for r in odd.where(held_out(F.col("doc_id"))).select("doc_id").distinct().collect()]
    assert ids and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in ids)
    known = odd.where(held_out(F.col("doc_id"))).select("doc_id", F.lit(1).alias("toxic"))
    assert not len(toxicity.fit(odd, known).index)


def test_flat_trees_walk_as_they_grew():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(3000, 6))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] < -0.5)).astype(float)
    model = quality.fit_trees(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95


def test_ftrl_keeps_few_weights():
    rnd = np.random.default_rng(1)
    rows = []
    for k in range(600):
        features = np.unique(rnd.integers(100, 50_000, 80))
        rows.append((np.append([7], features) if k % 6 == 0 else features, int(k % 6 == 0)))
    model = toxicity.fit_ftrl(rows)
    assert model.table()[7] > 1 and len(model.index) < 100


def test_ftrl_against_a_loop_over_dictionaries():
    rnd = np.random.default_rng(3)
    rows = [(np.unique(rnd.integers(0, 300, 30)), int(rnd.random() < 0.4)) for _ in range(150)]
    z, n, last, l1 = defaultdict(float), defaultdict(float), 1 << toxicity.BITS, 0.5

    def weight(i):
        if i != last and abs(z[i]) <= l1:
            return 0.0
        shrunk = z[i] if i == last else math.copysign(abs(z[i]) - l1, z[i])
        return -shrunk / (1.0 + math.sqrt(n[i]))

    order = np.random.default_rng(7)
    for _ in range(3):
        for k in order.permutation(len(rows)):
            features = [*rows[k][0].tolist(), last]
            w = {i: weight(i) for i in features}
            g = 1 / (1 + math.exp(-sum(w.values()))) - rows[k][1]
            for i in features:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) * w[i]
                n[i] += g * g
    model = toxicity.fit_ftrl(rows, l1=l1, epochs=3)
    want = {i: weight(i) for i in range(300) if weight(i)}
    assert want and dict(zip(model.index.tolist(), model.weight.tolist())) == pytest.approx(want, rel=1e-5)
    assert model.intercept == pytest.approx(weight(last))


def test_features_to_learn_from_are_bounded(odd):
    assert toxicity.within([3, 4, 5], 7) == 2 and toxicity.within([8], 7) == 0
    known = odd.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    every = toxicity.fit(odd, known)
    assert np.array_equal(toxicity.fit(odd, known, most=1 << 24).weight, every.weight)
    assert not len(toxicity.fit(odd, known, most=0).index)


def test_statistics_of_slices_are_those_of_the_whole(monkeypatch):
    text = "Some words, and MORE words!\n" * 200
    whole = quality.statistics(text, Memo(quality._traits))
    monkeypatch.setattr(quality, "slices", lambda t: (t[k : k + 28] for k in range(0, len(t), 28)))
    assert np.allclose(whole, quality.statistics(text, Memo(quality._traits)))
    assert not quality.statistics("", Memo(quality._traits)).any()
