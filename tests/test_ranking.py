"""The n-tiles against Spark's own, and their plan."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cestero.catalog.queries import receipts
from cestero.operators import customers
from cestero.operators.ranking import exact_ntiles, float_ordinal, tile_cuts
from plans import executed_plan


def both(rows, tiles=4):
    ours = exact_ntiles(rows, {"tile": F.col("value")}, "id", tiles)
    window = Window.orderBy(F.asc_nulls_first("value"), F.asc_nulls_first("id"))
    return ours.withColumn("expected", F.ntile(tiles).over(window))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 7, 8])
def test_few_rows(spark, n):
    rows = spark.createDataFrame([(i, i % 2) for i in range(n)], "id int, value int")
    found = both(rows).collect()
    assert len(found) == n
    assert [r for r in found if r.tile != r.expected] == []


@pytest.mark.parametrize("kind", ["int", "bigint"])
@pytest.mark.parametrize("tiles", [2, 4, 7])
def test_values_shared_by_most_rows(spark, kind, tiles):
    chance = random.Random(7)
    top = 2**31 - 1 if kind == "int" else 2**62
    ids = [None] + list({chance.randint(-top, top) for _ in range(400)})
    rows = [(i, chance.choice([None, -5, 1, 1, 1, 1, 1, 2, 900])) for i in ids]
    frame = spark.createDataFrame(rows, f"id {kind}, value int")
    found = both(frame, tiles).collect()
    assert len(found) == len(ids)
    assert [r for r in found if r.tile != r.expected] == []


def test_one_value_for_all(spark):
    rows = spark.range(1000).select("id", F.lit(3).alias("value"))
    sizes = both(rows).groupBy("tile").count().collect()
    assert {r["tile"]: r["count"] for r in sizes} == {1: 250, 2: 250, 3: 250, 4: 250}
    assert both(rows).where("tile <> expected").count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_tiles_of_groups(spark, wide):
    """A group with a third of all rows, one without a name, and groups of fewer rows than tiles."""
    chance = random.Random(11)
    names = ["large"] * 300 + [None] * 100 + ["two"] * 2 + ["one"] + [f"g{k}" for k in range(40)] * 12
    rows = [(i, n, chance.choice([None, 1, 1, 1, 5, -(2**40), i])) for i, n in enumerate(names)]
    frame = spark.createDataFrame(rows, "id bigint, store string, value bigint")
    got = exact_ntiles(
        frame, {"up": F.col("value"), "down": -F.col("value")}, "id", 5, groups=["store"], wide=wide
    )
    assert got.columns == [*frame.columns, "up", "down"]

    def window(value):
        return Window.partitionBy("store").orderBy(F.asc_nulls_first(value), "id")

    want = frame.withColumn("minus", -F.col("value")).select(
        *frame.columns, F.ntile(5).over(window("value")).alias("up"), F.ntile(5).over(window("minus")).alias("down")
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_tiles_of_a_million_doubles(spark):
    value = F.pmod(F.xxhash64("id"), F.lit(10**9 + 7)) / 1024 - 300_000
    odd = F.when(F.col("id") % 1009 == 0, F.lit(float("nan"))).when(F.col("id") % 1013 == 0, F.lit(-0.0))
    odd = odd.when(F.col("id") % 1019 == 0, F.lit(float("-inf"))).when(F.col("id") % 1021 == 0, F.lit(0.0))
    rows = spark.range(1_000_000).select("id", odd.otherwise(value).alias("value"))
    found = exact_ntiles(rows, {"tile": float_ordinal(F.col("value"))}, "id", 7, wide=True)
    # Spark takes both zeros for one when it sorts, and NaN for the last.
    expected = F.ntile(7).over(Window.orderBy("value", "id"))
    assert found.withColumn("expected", expected).where("tile <> expected").isEmpty()


def test_no_step_of_wide_tiles_gathers_different_values(spark):
    rows = spark.range(200_000).select("id", (F.rand(3) * 1e9).alias("value"))
    cuts = tile_cuts(rows, [float_ordinal(F.col("value"))], "id", 4, wide=True)
    assert len(cuts.first()["cuts"]) == 3
    plan = cuts._jdf.queryExecution().analyzed().toString()
    # Windows run over 22 bits, then 21 at a time, of the value and of the key.
    assert plan.count("shiftright(value#") >= 2 and plan.count("shiftright(key#") >= 2


def test_the_order_of_doubles(spark):
    values = [None, float("-inf"), -1e300, -2.5, -1e-310, 0.0, 1e-310, 1.0, 1.5, 3e200, float("inf"), float("nan")]
    frame = spark.createDataFrame(list(enumerate(values)), "id int, value double")
    got = [r.o for r in frame.orderBy("id").select(float_ordinal(F.col("value")).alias("o")).collect()]
    assert got[0] is None and got[1:] == sorted(got[1:]) and len(set(got)) == len(values)
    both_zeros = spark.sql("SELECT CAST(-0.0D AS DOUBLE) AS value UNION ALL SELECT 0.0D")
    assert both_zeros.select(float_ordinal(F.col("value"))).distinct().count() == 1


def test_rfm_scans_once_and_gathers_no_customers(spark, sf_dir):
    plan = executed_plan(customers.rfm_segmentation(receipts(spark, sf_dir)))
    assert sum("FileScan" in line for line in plan) == 1
    assert not any("ntile" in line for line in plan)
    # A single task sees partial results: of the last day, and of the cut rows.
    gathered = [after for line, after in zip(plan, plan[1:]) if "SinglePartition" in line]
    assert gathered
    assert all("partial_" in line for line in gathered)
