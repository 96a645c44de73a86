"""Registered queries of the operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cestero.llm import (
    bpe,
    hash_forest,
    near_dup,
    oracle,
    packing,
    quality,
    repair,
    sharding,
    spelling,
    suffix_dedup,
    token_counts,
    topk,
    toxicity,
    warc,
)
from cestero.llm.text import held_out, table
from cestero.sinks.shared import shared_folder

#: A replica of the fixity drill differs in the records of ids that this divides.
DRILL = 97


def _scored(documents: DataFrame, score, threshold: float) -> DataFrame:
    scored = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, table(spark, sf_dir, "labels"))
    score = quality.quality(F.col("text"), model).alias("score")
    return _scored(documents, score, quality.THRESHOLD)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    score = toxicity.toxicity(F.col("text"), model).alias("score")
    return _scored(documents, score, toxicity.THRESHOLD)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return topk.top_k(embeddings, embeddings.where("vec_id % 100 = 0"), 10)


def op4_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a replica of all pages that differs in a drill: every 97th id has another date."""
    pages = table(spark, sf_dir, "pages")
    listed = warc.manifest(warc.records(pages))
    date = F.when(F.col("page_id") % DRILL == 0, warc.DATE.replace("00Z", "01Z")).otherwise(warc.DATE)
    altered = warc.record(F.col("page_id"), F.col("url"), F.col("html"), date)
    original = warc.record(F.col("page_id"), F.col("url"), F.col("html"), F.lit(warc.DATE))
    replica = pages.select(
        "page_id", F.sha2(original.cast("binary"), 256).alias("sha256"), altered.alias("record")
    )
    folder = shared_folder(spark)
    warc.write_warc(replica, folder)
    found = warc.in_order(warc.read_warc(spark, folder), *warc.READ_ORDER)
    bad = warc.audit(listed, found).withColumn("bad", F.lit(True))
    return listed.join(bad, "ordinal", "left").select(
        "page_id", "ordinal", "offset", "length", "sha256", F.col("bad").isNull().alias("intact")
    )


def op5_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return hash_forest.nearest(embeddings, embeddings.where("vec_id % 20 = 0"), 20)


def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    library = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), library)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    library = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), library)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept, size = F.col("remains.kept"), F.octet_length("text").cast("long")
    return suffix_dedup.remove_repeats(documents).select(
        "doc_id",
        size.alias("n_bytes"),
        (size - F.octet_length(kept)).alias("n_removed"),
        F.size("remains.spans").cast("long").alias("n_spans"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = table(spark, sf_dir, "documents")
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe.round_trip(documents, ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_top_k": op3_top_k,
    "op4_warc_fixity": op4_warc_fixity,
    "op5_hash_forest": op5_hash_forest,
    "op6_near_dup": op6_near_dup,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_bpe": op10_bpe,
    "op11_repair": op11_repair,
    "op12_spelling": op12_spelling,
    "op13_sharding": op13_sharding,
}
ORACLE_SQL: dict[str, str] = {
    **oracle.ORACLE_SQL,
    "op4_warc_fixity": """
        WITH records AS (
            SELECT page_id, concat(
                'WARC/1.1', e, 'WARC-Type: response', e, 'WARC-Record-ID: <urn:page:', page_id, '>', e,
                'WARC-Target-URI: ', regexp_replace(url, '[\\r\\n]', '', 'g'), e,
                'WARC-Date: 2024-01-01T00:00:00Z', e, 'Content-Type: text/html', e,
                'Content-Length: ', strlen(coalesce(html, '')), e, e, html) AS record
            FROM pages, (SELECT chr(13) || chr(10) AS e)
        ), hashed AS (
            SELECT page_id, strlen(record) AS length, sha256(record) AS sha256 FROM records
        )
        SELECT page_id, row_number() OVER (ORDER BY page_id NULLS FIRST, sha256) - 1 AS ordinal,
            CAST(coalesce(sum(length + 4) OVER (ORDER BY page_id NULLS FIRST, sha256
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset,
            length, sha256, coalesce(page_id % 97 <> 0, true) AS intact
        FROM hashed
    """,
    "op3_top_k": """
        WITH usable AS (
            SELECT vec_id, list_transform(
                embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS terms
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scores AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                CAST(list_inner_product(q.terms, c.terms) AS BIGINT) AS score
            FROM usable q JOIN usable c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
            FROM scores
        ) WHERE rank <= 10
    """,
}
