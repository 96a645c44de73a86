"""The registered queries and the pipeline."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from cestero.llm import near_dup, packing, quality, suffix_dedup, toxicity
from cestero.llm.queries import ORACLE_SQL, QUERIES
from cestero.llm.text import table
from test_repeats import left_over, similar_classes

COLUMNS = {
    "op1": "doc_id held_out score predicted",
    "op2": "doc_id held_out score predicted",
    "op3": "query_id rank vec_id score",
    "op4": "page_id ordinal offset length sha256 intact",
    "op5": "query_id rank vec_id score",
    "op6": "doc_id class_id",
    "op7": "doc_id n_bytes n_tokens over_limit",
    "op8": "doc_id piece start length ids_crc32 sequence_id offset",
    "op9": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op10": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op11": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
    "op12": "word form root n n_near form_n",
    "op13": "doc_id size text_crc32 law shard slot grown_shard",
}


def test_all_queries_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLE_SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_rows(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    number = name.split("_")[0]
    assert set(COLUMNS[number].split()) <= set(got.columns)
    if number in ("op1", "op2", "op6", "op7", "op9", "op10", "op13"):
        assert got.count() == table(spark, sf_dir, "documents").count()


def test_stages_keep_the_columns_and_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == "toxicity quality near_duplicates repeats packing".split()
    labels = table(spark, sf_dir, "labels")
    toxic, good = toxicity.fit(docs, labels), quality.fit(docs, labels)
    text = {r.doc_id: r.text for r in docs.collect()}

    def scores(score, model):
        return {r.doc_id: r.s for r in docs.select("doc_id", score(docs.text, model).alias("s")).collect()}

    first, second = scores(toxicity.toxicity, toxic), scores(quality.quality, good)
    (_, a), (_, b), (_, c), (_, d), (_, e) = corpus_pipeline.STAGES
    clean = a(spark, docs, sf_dir)
    assert clean.columns == columns
    assert {r.doc_id for r in clean.collect()} == {i for i, s in first.items() if s < 0.3}
    fine = b(spark, clean, sf_dir)
    assert {r.doc_id for r in fine.collect()} == {i for i, s in first.items() if s < 0.3 and second[i] >= 0.7}
    single = c(spark, fine, sf_dir)
    assert {r.doc_id for r in single.collect()} == {r.class_id for r in near_dup.classes(fine).collect()}
    short = d(spark, single, sf_dir)
    assert short.columns == columns
    kept = {r.doc_id: bytes(r.remains.kept) for r in suffix_dedup.remove_repeats(single).collect()}
    assert {r.doc_id: r.text for r in short.collect()} == {i: k.decode("utf-8", "ignore") for i, k in kept.items()}
    assert all(r.n_chars == len(r.text) for r in short.collect())
    placed = {(r.doc_id, r.piece): r.length for r in e(spark, short, sf_dir).collect()}
    assert {i for i, _ in placed} == set(kept)
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r.doc_id, r.piece): r.length for r in whole} == placed
    assert set(text) >= {i for i, _ in placed} and max(placed.values()) <= packing.LENGTH


def test_the_pipeline_against_brute_force(spark, sf_dir):
    """``run`` on the small table against pairs, byte strings and the tokenizer library."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    toxic, good = toxicity.fit(docs, labels), quality.fit(docs, labels)
    scored = docs.select(
        "doc_id", "text", toxicity.toxicity(docs.text, toxic).alias("t"), quality.quality(docs.text, good).alias("q")
    )
    rows = [(r.doc_id, r.text) for r in scored.collect() if r.t < 0.3 and r.q >= 0.7]
    first = {class_id for _, class_id in similar_classes(rows)}
    assert 0 < len(first) <= len(rows) and len({i for i, _ in rows}) == len(rows)
    kept = left_over([(i, text) for i, text in rows if i in first])
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for (i, _), (raw, _) in kept.items():
        ids = [*library.encode(raw.decode("utf-8", "ignore"), add_special_tokens=False).ids, packing.END]
        for piece, at in enumerate(range(0, len(ids), packing.LENGTH)):
            cut = ids[at : at + packing.LENGTH]
            want[i, piece] = at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())
    placed = corpus_pipeline.run(spark, sf_dir).collect()
    assert len(placed) == len(want)
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in placed} == want
    taken = sorted((r.sequence_id, r.offset, r.length) for r in placed)
    assert all(o + n <= packing.LENGTH for _, o, n in taken)
    assert all(a[0] < b[0] or a[1] + a[2] <= b[1] for a, b in zip(taken, taken[1:]))


def test_stages_on_odd_rows(spark, sf_dir, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, sf_dir)
            got.count()
            assert name == "packing" or got.columns == docs.columns


def test_crc32_of_an_id_is_that_of_its_text(spark):
    got = spark.sql("SELECT crc32(CAST(CAST(12345 AS STRING) AS BINARY)) AS c").first()
    assert got.c == zlib.crc32(b"12345")
