"""Itemsets and rules against Spark's model and against counting by hand."""

from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth

from cestero.operators import mining
from cestero.plans.summaries import market_basket, product_summary
from cestero.operators.baskets import explode_transactions
from cestero.sinks import mining as files

PLANTED = ["1 2"] * 3 + ["1 2 2"] + ["3"] * 4 + ["1 3", "4"]


@pytest.fixture
def planted(receipts):
    return receipts([("2024-01-01", 1, 1, b) for b in PLANTED])


def by_items(itemsets):
    return {tuple(r["items"]): r.freq for r in itemsets.collect()}


def test_planted_patterns(planted):
    found = market_basket(planted, min_support=0.1, min_confidence=0.3)
    assert by_items(found["frequent_itemsets"]) == {
        ("1",): 5, ("2",): 4, ("3",): 5, ("4",): 1, ("1", "2"): 4, ("1", "3"): 1,
    }
    rules = {
        (tuple(r.antecedent), tuple(r.consequent)): (r.confidence, r.lift, r.support)
        for r in found["association_rules"].collect()
    }
    assert rules == {
        (("1",), ("2",)): (0.8, 2.0, 0.4),
        (("2",), ("1",)): (1.0, 2.0, 0.4),
    }
    assert mining.strong_rules(found["association_rules"]).count() == 2
    counts = mining.mining_counts(found["frequent_itemsets"], found["association_rules"])
    assert tuple(counts.first()) == (6, 2, 2)


def test_null_and_empty_baskets(receipts):
    tx = receipts([("2024-01-01", 1, 1, b) for b in ["1 2", "1  2", "", None]])
    found = market_basket(tx, min_support=0.5, min_confidence=0.1)
    assert by_items(found["frequent_itemsets"]) == {("1",): 2, ("2",): 2, ("1", "2"): 2}
    # Of three baskets, the empty one included.
    assert {r.support for r in found["association_rules"].collect()} == {2 / 3}


def test_infrequent_items_do_not_change_the_rest(spark):
    rows = [(sorted({f"p{(i * k) % 11}" for k in range(1, 6)}),) for i in range(60)]
    baskets = spark.createDataFrame(rows, "items array<string>")
    mined = mining.mine_itemsets(baskets, 0.2)
    counted = {}
    for (items,) in rows:
        for size in range(1, len(items) + 1):
            for subset in combinations(items, size):
                counted[subset] = counted.get(subset, 0) + 1
    assert by_items(mined.itemsets) == {s: n for s, n in counted.items() if n >= 12}
    assert mined.n_baskets == 60


def test_rules_are_those_of_the_model(spark):
    rows = [(sorted({f"p{(i * k) % 7}" for k in range(1, 5)}),) for i in range(50)]
    baskets = spark.createDataFrame(rows, "items array<string>")
    model = FPGrowth(itemsCol="items", minSupport=0.1, minConfidence=0.4).fit(baskets)
    ours = mining.association_rules(model.freqItemsets, 50, 0.4)

    def flat(rules):
        return sorted(
            (sorted(r.antecedent), r.consequent, round(r.confidence, 9), round(r.lift, 9),
             round(r.support, 9))
            for r in rules.collect()
        )

    assert flat(ours) == flat(model.associationRules) != []


def test_no_basket_at_all(receipts):
    found = market_basket(receipts([]), 0.1, 0.1)
    assert found["frequent_itemsets"].count() == 0
    assert found["association_rules"].count() == 0


def test_stored_search_is_used_for_equal_parameters_only(planted, tmp_path):
    path = str(tmp_path / "mined")
    first = market_basket(planted, 0.1, 0.3, reuse_path=path, source="planted")
    assert first["model"] is not None
    again = market_basket(planted, 0.1, 0.3, reuse_path=path, source="planted")
    assert again["model"] is None
    assert by_items(again["frequent_itemsets"]) == by_items(first["frequent_itemsets"])
    other = market_basket(planted, 0.3, 0.3, reuse_path=path, source="planted")
    assert other["model"] is not None
    assert len(by_items(other["frequent_itemsets"])) == 4
    third = market_basket(planted, 0.1, 0.3, reuse_path=path, source="planted")
    assert third["model"] is None
    assert by_items(third["frequent_itemsets"]) == by_items(first["frequent_itemsets"])


def test_csv_files(spark, planted, tmp_path):
    found = market_basket(planted, 0.1, 0.3)
    files.write_csv(found["frequent_itemsets"], f"{tmp_path}/itemsets")
    back = files.read_itemsets_csv(spark, f"{tmp_path}/itemsets")
    assert by_items(back) == by_items(found["frequent_itemsets"])
    files.write_csv(found["association_rules"], f"{tmp_path}/rules")
    rules = files.read_rules_csv(spark, f"{tmp_path}/rules")
    assert rules.schema.simpleString() == found["association_rules"].schema.simpleString()
    assert sorted(map(tuple, rules.collect())) == sorted(
        map(tuple, found["association_rules"].collect())
    )


def test_product_summary(planted):
    frames = product_summary(planted, explode_transactions(planted), min_support=0.1)
    assert {k: v for k, v in frames["market_basket"].items() if k == "model"}["model"]
    assert frames["top_products"].count() == 4
    assert frames["store_products"].count() == 4
    assert frames["combinations"].count() == 3


def test_stored_search_of_other_baskets_is_not_used(planted, tmp_path):
    path = str(tmp_path / "mined")
    with pytest.raises(ValueError, match="source"):
        market_basket(planted, 0.1, 0.3, reuse_path=path)
    market_basket(planted, 0.1, 0.3, reuse_path=path, source="shop")
    fewer = planted.where("products <> '3'").limit(3)
    found = market_basket(fewer, 0.1, 0.3, reuse_path=path, source="shop")
    assert found["model"] is not None


def test_items_with_marks_in_csv_files(spark, tmp_path):
    rows = [(["a,b", "c"], 3), (["100%", "%2C"], 2), ([' "x" ', "back\\slash"], 1), (["z"], 1)]
    sets = spark.createDataFrame(rows, "items array<string>, freq bigint")
    files.write_csv(sets, f"{tmp_path}/sets")
    back = files.read_itemsets_csv(spark, f"{tmp_path}/sets")
    assert sorted(map(tuple, back.collect())) == sorted((i, n) for i, n in rows)


def test_search_stages_where_it_is_told(spark, planted):
    kept = []

    def stage(df):
        kept.append(df)
        return df.cache()

    found = market_basket(planted, 0.1, 0.3, stage=stage)
    assert len(kept) == 1 and found["frequent_itemsets"].count()
