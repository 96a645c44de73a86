"""Tokens and sizes of random basket texts against plain Python."""

import random

from pyspark.sql import functions as F

from cestero.functions import basket_tokens, basket_units, distinct_tokens


def test_random_texts(spark):
    chance = random.Random(11)
    texts = ["".join(chance.choices("  1 2x\té", k=chance.randint(0, 12))) for _ in range(400)]
    frame = spark.createDataFrame([(t,) for t in texts], "products string").select(
        "products",
        basket_tokens().alias("tokens"),
        basket_tokens(clean=True).alias("clean"),
        distinct_tokens().alias("distinct"),
        basket_units().alias("units"),
        basket_units(clean=True).alias("clean_units"),
    )
    for row in frame.collect():
        tokens = row.products.strip(" ").split(" ")
        clean = [t for t in tokens if t]
        assert row.tokens == tokens
        assert row.clean == clean
        assert row["distinct"] == list(dict.fromkeys(clean))
        assert (row.units, row.clean_units) == (len(tokens), len(clean))


def test_null_basket_in_both_modes(spark):
    frame = spark.range(1).select(F.lit(None).cast("string").alias("products"))
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            row = frame.select(
                basket_units().alias("a"), basket_units(clean=True).alias("b")
            ).first()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        assert tuple(row) == (None, None)
