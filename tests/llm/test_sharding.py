"""Sharding: the law, the tree, and what moves when weights change."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cestero.llm import sharding


def walk(key, tree):
    """The shard of a key, level by level in plain Python."""
    nodes, at, name = tree.children(), 0, ""
    while nodes[at]:
        draws = []
        for node, child, weight in nodes[at]:
            bits = int(hashlib.md5(f"{key}/{child}".encode()).hexdigest()[:13], 16)
            draws.append((-math.log((bits + 0.5) / (1 << 52)) / weight, node, child))
        _, at, name = min(draws)
    return int(name.removeprefix("shard "))


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(20_000).select(F.col("id").cast("string").alias("key"))


def shards_of(keys, tree):
    return {r.key: r.s for r in keys.select("key", sharding.descend(F.col("key"), tree).alias("s")).collect()}


def test_rows_against_plain_python(odd):
    tree = sharding.layout(sharding.SHARDS)
    got = sharding.sharded(odd).collect()
    want = Counter()
    for r in odd.collect():
        key, text = "" if r.doc_id is None else str(r.doc_id), (r.text or "").encode()
        shard, more = walk(key, tree), walk(key, sharding.grown(tree))
        want[r.doc_id, len(text) + 8, zlib.crc32(text), "key", shard, more] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_nothing(nothing):
    assert sharding.sharded(nothing).count() == 0


def test_slots_do_not_depend_on_how_rows_lie(spark):
    """A third of all rows share one id, a third are alike in everything."""
    rows = [(k, f"text {k}") for k in range(3000)] + [(7, f"of seven {k}") for k in range(3000)]
    rows += [(None, "copy")] * 3000
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    listed = [
        sorted(map(str, sharding.sharded(frame.repartition(n)).collect())) for n in (2, 9)
    ]
    assert listed[0] == listed[1]
    per_shard = Counter()
    for r in sharding.sharded(frame.repartition(5)).collect():
        per_shard[r.shard, r.slot] += 1
    assert len(per_shard) == 9000 and set(per_shard.values()) == {1}


def test_no_task_gets_all_rows_of_a_hot_id(spark):
    rows = spark.range(40_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("copy").alias("text"))
    placed = sharding.placed(rows.repartition(8))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = sharding.in_order(placed).groupBy(F.shiftright("place", 33)).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 20_000
    assert sharding.with_slots(placed).agg(F.max("slot")).first()[0] == 39_999


def test_shares_follow_weights(keys):
    weights = [1.0] * 23 + [4.0]
    found = Counter(shards_of(keys, sharding.layout(24, weights=weights)).values())
    for shard, weight in enumerate(weights):
        assert found[shard] == pytest.approx(20_000 * weight / 27, rel=0.2)


@pytest.mark.parametrize("shards", [24, 25, 30])
def test_one_more_shard_takes_rows_only_into_itself(keys, shards):
    before = shards_of(keys, sharding.layout(shards))
    assert sharding.grown(sharding.layout(shards)) == sharding.layout(shards + 1)
    after = shards_of(keys, sharding.layout(shards + 1))
    moved = {k for k in before if before[k] != after[k]}
    assert {after[k] for k in moved} == {shards}
    assert len(moved) == pytest.approx(20_000 / (shards + 1), rel=0.2)


def test_movement_stays_in_the_subtree_whose_weights_change(keys):
    """Shards 0 to 3 are a rack, 0 to 7 a region."""
    plain = shards_of(keys, sharding.layout(24))

    def moves(weights):
        after = shards_of(keys, sharding.layout(24, weights=weights))
        return {(plain[k], after[k]) for k in plain if plain[k] != after[k]}

    within_rack = moves([1.5, 0.5] + [1.0] * 22)
    assert within_rack and {a for m in within_rack for a in m} <= {0, 1, 2, 3}
    assert all(a == 1 or b == 0 for a, b in within_rack)
    within_region = moves([2.0, 1, 1, 1, 0.5, 0.5, 1, 1] + [1.0] * 16)
    assert within_region and {a for m in within_region for a in m} <= set(range(8))
    # A region that gains takes rows from others, which trade none among themselves.
    gained = moves([2.0] + [1.0] * 23)
    assert all(b < 8 for _, b in gained)


def test_a_tree_needs_shards_of_some_weight():
    for shards, weights in ((0, None), (2, [1.0]), (2, [1.0, 0.0])):
        with pytest.raises(ValueError):
            sharding.layout(shards, weights=weights)
