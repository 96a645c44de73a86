"""Token counts by two tiers of lookup on the side that reads the texts.

The first tier is a table of the most frequent pieces and their numbers of
tokens, counted over a bounded sample of documents, and broadcast; the second
is what a worker has encoded before. Only what neither knows goes through the
library. No piece is ever shuffled, and the result needs no shuffle at all.
The sample decides how fast a lookup is, never what is counted.

A null text counts as the empty one: 0 bytes, 0 tokens. A text of any length is
counted whole, and every row of the input gives one row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cestero.llm.lookup import library, looked_up, space_led, text_of
from cestero.llm.text import Memo, of_worker

#: Documents whose pieces are counted for the first tier, about, and its entries, at most.
SAMPLE = 2_000
FREQUENT = 1 << 15


def _counter(tokenizer_json: str):
    """Numbers of tokens of many pieces, and of one whole slice."""
    own = library(tokenizer_json, "token counts")

    def many(keys: list[str]) -> list[int | None]:
        texts = [text_of(key) for key in keys]
        known = [t for t in texts if t is not None]
        encoded = own.encode_batch_fast(known, add_special_tokens=False)
        lengths = iter([len(e) for e in encoded])
        return [None if t is None else next(lengths) for t in texts]

    def whole(text: str) -> list[int]:
        return [len(own.encode(text, add_special_tokens=False))]

    return many, whole


def frequent_lengths(documents: DataFrame, tokenizer_json: str) -> tuple[str, list[int]]:
    """The most frequent pieces of a sample, joined by spaces, and their tokens."""
    rows = documents.count()
    every = max(1, rows // SAMPLE)
    sample = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select("text")

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = Counter()
        for batch in batches:
            for text in batch["text"].dropna():
                counts.update(space_led(text, False))
            if len(counts) > 16 * FREQUENT:
                counts = Counter(dict(counts.most_common(4 * FREQUENT)))
        top = [k for k, _ in counts.most_common(FREQUENT) if text_of(k) is not None]
        lengths = _counter(tokenizer_json)[0](top)
        yield pd.DataFrame({"pieces": [" ".join(top)], "tokens": [lengths]})

    found = sample.repartition(1).mapInPandas(counted, "pieces string, tokens array<int>").first()
    return (found.pieces, list(found.tokens)) if found else ("", [])


def n_tokens(text: Column, tokenizer_json: str, frequent) -> Column:
    """Tokens of each text; ``frequent`` is a broadcast of ``frequent_lengths``."""

    @F.pandas_udf(LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces, tokens = frequent.value
        first_tier = dict(zip(pieces.split(" "), tokens)) if tokens else {}
        memo = of_worker("token counts", f"lengths {hash(tokenizer_json)}", Memo)
        many, whole = _counter(tokenizer_json)

        def encode(keys: list[str]) -> list[int | None]:
            known = list(map(first_tier.get, keys))
            rest = iter(many([k for k, v in zip(keys, known) if v is None]))
            return [next(rest) if v is None else v for v in known]

        for batch in batches:
            totals = [0] * len(batch)
            for k, values in looked_up(batch, memo, space_led, encode, whole):
                totals[k] += sum(values)
            yield pd.Series(totals)

    return count(F.coalesce(text, F.lit("")))


def token_counts(documents: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for the library file at ``tokenizer``."""
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary = file.read()
    spark = documents.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_lengths(documents, vocabulary))
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        n_tokens(F.col("text"), vocabulary, frequent).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
