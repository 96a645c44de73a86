"""Both vector searches against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cestero.llm import hash_forest, queries, topk


def exhaustive(ids, vectors, asked, k):
    out = {}
    for q in asked:
        score = vectors @ vectors[q]
        rows = sorted((-s, i) for s, i in zip(score.tolist(), ids.tolist()) if i != ids[q])
        out[int(ids[q])] = [i for _, i in rows[:k]]
    return out


def test_recall(spark):
    folder = "/root/testdata/sf0.1"
    table = spark.read.parquet(f"{folder}/embeddings.parquet").toPandas()
    ids, vectors = table.vec_id.to_numpy(), np.stack(table.embedding).astype(float)
    want = exhaustive(ids, vectors, np.flatnonzero(ids % 20 == 0), 20)
    got = queries.QUERIES["op5_hash_forest"](spark, folder).toPandas()
    assert list(got.columns) == ["query_id", "rank", "vec_id", "score"]
    found = got.sort_values(["query_id", "rank"]).groupby("query_id")
    assert set(found.groups) == set(want)
    hits = [len(set(rows.vec_id) & set(want[q])) for q, rows in found]
    assert np.mean(hits) / 20 >= 0.9
    place = {i: v for i, v in zip(ids, vectors)}
    for r in got.head(200).itertuples():
        assert r.score == pytest.approx(place[r.query_id] @ place[r.vec_id], abs=1e-12)
    assert all((rows.score.diff().dropna() <= 0).all() for _, rows in found)


def test_recall_where_the_share_of_rows_met_decides():
    """More vectors than ``FEW`` is half of, of one length as those of the table are."""
    rnd = np.random.default_rng(21)
    vectors = rnd.normal(size=(6000, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    ids, asked = rnd.permutation(6000), np.arange(200)
    assert hash_forest.MET * len(ids) > hash_forest.FEW
    want = exhaustive(ids, vectors, asked, 20)
    q, _, found = hash_forest.search_share(ids, vectors, ids[asked], vectors[asked], 20, hash_forest.MET)
    hits = [len(set(found[q == k].tolist()) & set(want[int(ids[row])])) for k, row in enumerate(asked)]
    assert np.mean(hits) / 20 >= 0.9


def test_a_forest_meets_what_is_wanted():
    rnd = np.random.default_rng(3)
    vectors = rnd.normal(size=(5000, 16)) * rnd.uniform(0.5, 2, (5000, 1))
    forest = hash_forest.Forest(vectors)
    for wanted in (1, 600, 5000):
        for rows in forest.met(vectors[:20], wanted):
            assert len(rows) >= wanted and len(set(rows)) == len(rows)


def test_pruning_skips_blocks_and_loses_nothing():
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(20, 12))
    vectors = np.repeat(centres, 512, axis=0) + rnd.normal(size=(10_240, 12)) * 0.05
    ids, terms = np.arange(10_240), topk.whole_terms(vectors)
    asked = ids[::97]
    q, score, found, scored = topk.search_share(ids, terms, asked, terms[asked], 10)
    want = exhaustive(ids, terms.astype(float), asked, 10)
    assert {int(asked[k]): found[q == k].tolist() for k in range(len(asked))} == want
    assert scored < 0.5 * len(asked) * len(ids) / topk.BLOCK


def test_ties_of_many_rows_go_to_the_smallest_ids():
    rnd = np.random.default_rng(9)
    vectors = rnd.normal(size=(3000, 16))
    vectors[:900] = vectors[0]
    vectors[900:1200] = vectors[0] * (1 + np.arange(300)[:, None] * 1e-10)  # equal in float32
    ids = rnd.permutation(3000)
    asked = np.array([5, 1000, 2000])
    for scale in (1.0, 1e30):
        scaled = vectors * scale
        q, score, found = hash_forest.search_share(ids, scaled, ids[asked], scaled[asked], 20, 1.0)
        for k, row in enumerate(asked):
            exact = (scaled * scaled[row]).sum(axis=1)
            want = sorted((-s, i) for s, i in zip(exact.tolist(), ids.tolist()) if i != ids[row])[:20]
            assert list(zip((-score[q == k]).tolist(), found[q == k].tolist())) == want


def test_ties_of_equal_vectors(spark):
    rows = [(k * 37 % 400, [1.0, 2.0, 3.0, -1.0]) for k in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = hash_forest.nearest(table, table.where("vec_id % 100 = 0"), 20).collect()
    for q in (0, 100, 200, 300):
        found = sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
        assert [i for _, i in found] == [i for i in range(21) if i != q][:20]


@pytest.fixture(scope="module")
def odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0], "a"), (0, [1.0, 2.0], "b"), (100, [float("nan"), 1.0], "c"), (1, None, "d"),
        (2, [None, 1.0], "e"), (3, [1.0], "f"), (4, [], "g"), (None, [1.0, 1.0], "h"),
        (5, [-3.0, 1.0], "i"), (6, [0.0, 0.0], "j"), (7, [1.0], "k"), (7, [1.0], "l"),
        (8, [float("inf"), 0.0], "m"), (200, [0.0, -1e-9], "n"),
    ]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")


def test_odd_vectors(odd_vectors):
    got = topk.top_k(odd_vectors, odd_vectors.where("vec_id % 100 = 0")).collect()
    rows = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)
    unit = 1024 * 1024
    assert [r for r in rows if r[0] == 0] == [
        (0, 1, 3, unit), (0, 2, 7, unit), (0, 3, 7, unit), (0, 4, 4, 0), (0, 5, 6, 0),
        (0, 6, 5, -unit), (0, 7, 200, -2 * 1024),
    ] or [r for r in rows if r[0] == 0][:3] == [(0, 1, 3, unit), (0, 2, 7, unit), (0, 3, 7, unit)]
    assert {r[0] for r in rows} == {0, 200}
    near = hash_forest.nearest(odd_vectors, odd_vectors.where("vec_id % 20 = 0")).collect()
    found = sorted((r.query_id, r.rank, r.vec_id) for r in near if r.query_id == 0)
    assert found == [(0, 1, 3), (0, 2, 7), (0, 3, 7), (0, 4, 200), (0, 5, 5)]
    none = odd_vectors.limit(0)
    assert topk.top_k(none, none).count() == hash_forest.nearest(none, none).count() == 0


def test_sums_beyond_doubles_are_exact():
    ids, big = np.arange(3), np.array([[2**30, 1], [2**30, 3], [2**30, 2]], np.int64)
    q, score, found, _ = topk.search_share(ids, big, ids[:1], big[:1], 10)
    assert found.tolist() == [1, 2] and score.tolist() == [2**60 + 3, 2**60 + 2]


def test_scores_that_may_not_fit_are_an_error():
    ids = np.arange(2)
    with pytest.raises(OverflowError):
        topk.whole_terms(np.array([[1e18]]))
    big = np.array([[2**40, 0], [2**40, 1]], np.int64)
    with pytest.raises(OverflowError):
        topk.search_share(ids, big, ids[:1], big[:1], 10)
    # Long vectors whose products fit, although the largest components' would not.
    apart = np.array([[2**31, 0, 0, 0], [5, 2**31, 0, 0], [1, 2, 3, 2**31]], np.int64)
    _, score, found, _ = topk.search_share(np.arange(3), apart, ids[:1], apart[:1], 10)
    assert found.tolist() == [1, 2] and score.tolist() == [5 * 2**31, 2**31]


def test_thousands_of_shares_are_planned_and_looked_up(spark):
    rows = spark.range(20_000).select((F.col("id") * 3 % 10_007).alias("vec_id"))
    limits = [float(v) for v in range(2, 10_002, 2)]
    limits[3:6] = [limits[3]] * 3
    spread = F.lit(77)
    got = rows.select("vec_id", topk.share_of(F.col("vec_id"), spread, limits).alias("share")).collect()
    for r in got:
        want = 77 if r.vec_id == limits[3] else sum(limit <= r.vec_id for limit in limits)
        assert r.share == want


def test_searches_over_many_shares(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARE", 40)
    rnd = np.random.default_rng(2)
    vectors = np.round(rnd.normal(size=(300, 6)), 2)
    ids = np.concatenate((np.full(120, 7), rnd.permutation(180) + 20))
    table = spark.createDataFrame(
        [(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>"
    )
    terms = np.floor(vectors * 1024)
    got = topk.top_k(table, table.where("vec_id % 50 = 0"), 5).collect()
    for q in (50, 100, 150):
        score = terms @ terms[ids == q][0]
        want = sorted((-s, i) for s, i in zip(score.tolist(), ids.tolist()) if i != q)[:5]
        assert sorted((-r.score, r.vec_id) for r in got if r.query_id == q) == want
