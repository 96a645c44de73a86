"""The search over bitmaps against FP-growth and against counting by hand."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cestero.operators import mining, vertical
from cestero.operators.numbering import numbered
from cestero.plans.summaries import market_basket
from cestero.sinks.shared import stage_table


def by_items(itemsets):
    rows = itemsets.collect()
    found = {tuple(r["items"]): r.freq for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture(scope="module")
def skewed(spark):
    """100,000 baskets in several segments: one item in all, a third of the baskets equal,
    and patterns that a part of the baskets has and the others have not."""
    rows = spark.range(100_000, numPartitions=5).withColumn("h", F.xxhash64("id"))
    some = [
        F.when(F.pmod(F.shiftright("h", k), F.lit(m)) == 0, f"i{k}")
        for k, m in ((3, 3), (7, 4), (11, 5), (17, 9), (23, 12), (29, 40), (31, 60))
    ]
    early = [F.when(F.col("id") < 9000, name) for name in ("early a", "early b")]
    late = F.when(F.col("id") > 97_000, "late")
    items = F.array_compact(F.array(F.lit("all"), *some, *early, late))
    equal = F.array(*map(F.lit, ("all", "i3", "i7", "same 1", "same 2")))
    return rows.select(F.when(F.col("id") % 3 == 0, equal).otherwise(items).alias("items"))


@pytest.mark.parametrize("share_bytes", [vertical.SHARE_BYTES, 1])
def test_the_itemsets_of_fp_growth(skewed, share_bytes):
    """In one share, and in one share for each segment, where some report what others do not."""
    want = by_items(mining.mine_itemsets(skewed, 0.005).itemsets)
    mined = vertical.mine_itemsets(skewed, 0.005, share_bytes=share_bytes)
    assert mined.n_baskets == 100_000 and mined.model is None
    assert by_items(mined.itemsets) == want and len(want) > 100
    assert ("all", "early a", "early b") in want and max(map(len, want)) >= 5


def test_shares_deal_all_segments_and_their_thresholds_suffice(spark):
    rows = [
        (n, max(1, n // 70), items)
        for n in (1, 32_768, 32_769, 1_000_000, 12_345_678)
        for items in (0, 1, 700, 50_000)
    ]
    groups = spark.createDataFrame(rows, "n bigint, least bigint, n_items bigint")
    for share_bytes in (1 << 25, 1 << 23, 1):
        dealt = vertical.dealt(groups, share_bytes, 8)
        segments = dealt.select("*", F.explode(F.expr("sequence(0L, segments - 1)")).alias("segment"))
        shares = vertical.of_shares(segments)
        assert shares.where("NOT (first <= segment AND segment < end AND local <= most)").isEmpty()
        per_share = shares.groupBy("n", "n_items", "least", "segments", "shares", "share", "first", "end", "local").count()
        assert per_share.where(F.col("count") != F.col("end") - F.col("first")).isEmpty()
        per_group = per_share.groupBy("n", "n_items", "least", "segments", "shares").agg(
            F.sum("count").alias("found"), F.count("*").alias("used"), F.sum(F.col("local") - 1).alias("unseen")
        )
        # With one less in every share an itemset misses the overall threshold.
        bad = "found <> segments OR used <> shares OR unseen >= least"
        assert per_group.count() == len(rows) and per_group.where(bad).isEmpty()


@pytest.mark.parametrize("share_bytes", [vertical.SHARE_BYTES, 1])
def test_the_itemsets_of_each_store(skewed, share_bytes):
    """One store has most of the baskets, others few, one no name; thresholds are their own."""
    store = F.when(F.col("h") % 10 < 7, 1).when(F.col("h") % 10 == 8, None).otherwise(F.col("h") % 90)
    spread = skewed.withColumn("h", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1000)))
    baskets = stage_table(spread.select(store.cast("int").alias("store_id"), "items"))
    got, sizes = vertical.mine_itemsets_by(baskets, ["store_id"], 0.03, share_bytes=share_bytes)
    assert got.columns == ["store_id", "items", "freq", "n_baskets"]
    found, rows = {}, got.collect()
    for r in rows:
        found.setdefault((r.store_id, r.n_baskets), {})[tuple(r["items"])] = r.freq
    assert sum(map(len, found.values())) == len(rows)
    assert {(r.store_id, r.n_baskets) for r in sizes.collect()} == set(found) and len(found) == 20
    for (store_id, n), itemsets in list(found.items())[:6]:
        own = baskets.where(F.col("store_id").eqNullSafe(F.lit(store_id)))
        want = mining.mine_itemsets(own, 0.03)
        assert want.n_baskets == n and by_items(want.itemsets) == itemsets


def test_rules_of_each_store(spark):
    rows = [(1, ["a", "b"])] * 3 + [(1, ["a"])] + [(None, ["a", "b"])] + [(None, ["b"])] * 3 + [(2, ["c"])]
    baskets = spark.createDataFrame(rows, "store_id int, items array<string>")
    itemsets, _ = vertical.mine_itemsets_by(baskets, ["store_id"], 0.2)
    rules = mining.association_rules(itemsets, F.col("n_baskets"), 0.5, by=["store_id"])
    assert {
        (r.store_id, *r.antecedent, *r.consequent): (r.confidence, r.lift, r.support) for r in rules.collect()
    } == {
        (1, "a", "b"): (0.75, 1.0, 0.75),
        (1, "b", "a"): (1.0, 1.0, 0.75),
        (None, "a", "b"): (1.0, 1.0, 0.25),
    }


def test_extensions_against_counting():
    rnd = np.random.default_rng(5)
    bits = rnd.random((7, 640)) < rnd.uniform(0.02, 0.5, (7, 1))
    table = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)
    for prefix in range(7):
        got = dict(
            vertical.extensions((prefix,), table[prefix], np.arange(prefix + 1, 7), table[prefix + 1 :], 6)
        )
        want = {}
        for size in range(1, 7):
            for rest in combinations(range(prefix + 1, 7), size):
                n = int(bits[[prefix, *rest]].all(axis=0).sum())
                if n >= 6:
                    want[prefix, *rest] = n
        assert got == want


def test_odd_baskets(spark):
    rows = [(["b", "a", "a", None],), (["a", "b"],), ([],), (None,), (["c", None],), ([None],)]
    baskets = spark.createDataFrame(rows, "items array<string>")
    mined = vertical.mine_itemsets(baskets, 0.3)
    # Of five baskets: the empty ones count, the missing one does not.
    assert mined.n_baskets == 5
    assert by_items(mined.itemsets) == {("a",): 2, ("b",): 2, ("a", "b"): 2}
    assert vertical.mine_itemsets(baskets.limit(0), 0.3).itemsets.isEmpty()
    assert vertical.mine_itemsets(baskets.where("items IS NULL"), 0.3).n_baskets == 0


def test_the_market_basket_by_either_search(receipts):
    tx = receipts([("2024-01-01", 1, 1, b) for b in ["1 2"] * 3 + ["1 2 2"] + ["3"] * 4 + ["1 3", "4", None, ""]])
    found = [
        market_basket(tx, min_support=0.1, search=search)
        for search in (mining.mine_itemsets, vertical.mine_itemsets)
    ]
    sets = [by_items(f["frequent_itemsets"]) for f in found]
    rules = [sorted(map(str, f["association_rules"].collect())) for f in found]
    assert sets[0] == sets[1] and rules[0] == rules[1] and rules[0]


def test_rows_are_numbered_without_a_gap(spark):
    rows = spark.range(1000, numPartitions=7).where("id % 3 <> 1").repartition(5, "id")
    got = numbered(rows.select((F.col("id") * 2).alias("id")))
    assert got.columns == ["id", "number"]
    found = got.collect()
    assert sorted(r.number for r in found) == list(range(len(found)))
    assert len({r.id for r in found}) == len(found) == rows.count()
