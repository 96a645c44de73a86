"""Near-duplicates and repeated passages against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cestero.llm import components, near_dup, suffix_dedup
from cestero.llm.text import Memo, word_hash


def left_over(documents, span=suffix_dedup.SPAN):
    """Kept bytes and number of removed runs, by (id, text)."""
    seen, out = set(), {}
    for i, text in sorted(set(documents), key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for k in range(len(raw) - span + 1):
            if raw[k : k + span] in seen:
                covered[k : k + span] = b"\1" * span
            seen.add(raw[k : k + span])
        runs = sum(c > b for b, c in zip(b"\0" + covered, covered))
        out[i, text or ""] = bytes(b for b, c in zip(raw, covered) if not c), runs
    return out


@pytest.fixture(scope="module")
def passages(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(2, 7))) for _ in range(60)]

    def prose(a, b):
        return " ".join(rnd.choice(words) for _ in range(rnd.randint(a, b)))

    common = [prose(15, 60) for _ in range(8)]
    rows = []
    for i in range(120):
        parts = [prose(0, 80)]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(common)[rnd.randint(0, 20) :], prose(0, 9)]
        rows.append((i, rnd.choice(["", " "]).join(parts)))
    rows += [(200, "a" * 500), (201, "ab" * 300), (202, "a" * 99), (203, "a" * 100), (204, "")]
    rows += [(205, None), (206, rows[5][1]), (207, rows[5][1]), (208, common[0] * 4)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()


def check_left_over(documents, **options):
    want = left_over([(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()])
    got = suffix_dedup.remove_repeats(documents, **options).collect()
    assert len(got) == documents.count()
    for r in got:
        kept, runs = want[r.doc_id, r.text]
        assert (bytes(r.remains.kept), len(r.remains.spans)) == (kept, runs)


def test_repeats(passages):
    check_left_over(passages)


def test_repeats_in_crowded_buckets(passages, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 300)
    monkeypatch.setattr(suffix_dedup, "LOCAL_CROWD", 2)
    monkeypatch.setattr(suffix_dedup, "ROWS", 7)
    check_left_over(passages, crowd=3)
    check_left_over(passages)


def test_repeats_of_odd_rows(odd, nothing):
    check_left_over(odd.where("doc_id IS NOT NULL OR text IS NULL").where("doc_id IS NULL OR doc_id < 8 OR doc_id > 9"))
    cut = suffix_dedup.without_repeats(odd)
    assert cut.count() == odd.count()
    assert cut.columns == odd.columns
    assert suffix_dedup.without_repeats(nothing).count() == 0


def test_repeated_rows_are_one_document(spark, monkeypatch):
    """Rows alike in id and text that share a part with another document."""
    rnd = random.Random(4)

    def prose(n):
        return "".join(rnd.choices("abcdefgh ", k=n))

    shared = [prose(180) for _ in range(3)]
    twice = [prose(150) + s + prose(150) for s in shared]
    rows = [(k, text) for k, text in zip((3, 7, None), twice) for _ in range(3)]
    rows += [(5, prose(90) + shared[0] + prose(120)), (6, shared[1] + prose(130)), (9, prose(70) + shared[2])]
    rows += [(7, prose(200)), (8, prose(40) + shared[1] + prose(10))]
    for parts in (1, 4):
        documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        check_left_over(documents)
        check_left_over(documents, crowd=1)
    monkeypatch.setattr(suffix_dedup, "LOCAL_CROWD", 2)
    monkeypatch.setattr(suffix_dedup, "ROWS", 2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        check_left_over(documents)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def similar_classes(rows):
    """Class of each row, by comparing all pairs that share a shingle."""
    memo = Memo(word_hash)
    found = [near_dup.shingles(text or "", memo) for _, text in rows]
    frequencies = np.zeros(1 << near_dup.SLOTS, np.int64)
    for ids, _ in found:
        np.add.at(frequencies, near_dup.slot(ids), 1)
    idf = near_dup.inverse_frequencies(frequencies, len(rows)).astype(float)
    weights = [dict(zip(ids.tolist(), counts * idf[near_dup.slot(ids)])) for ids, counts in found]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    having = defaultdict(list)
    for k, own in enumerate(weights):
        for j, n in Counter(j for i in own for j in having[i]).items():
            shared = sum(min(own[i], weights[j][i]) for i in own.keys() & weights[j].keys()) if n > 1 or len(own) < 9 else 0
            if shared >= 0.8 * (sum(own.values()) + sum(weights[j].values()) - shared) * (1 - 1e-9):
                root[top(k)] = top(j)
        for i in own:
            having[i].append(k)
    members = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        members[top(k)].append(doc_id)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in members.items()}
    return sorted(((doc_id, least[top(k)]) for k, (doc_id, _) in enumerate(rows)), key=str)


def check_classes(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = near_dup.classes(documents).collect()
    assert sorted(((r.doc_id, r.class_id) for r in got), key=str) == similar_classes(rows)


def test_near_duplicates_of_documents(spark, sf_dir):
    check_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_near_duplicates_whose_samples_hardly_agree(spark, monkeypatch):
    """What meets in one band only, by unlucky samples, is compared nevertheless."""

    def unlucky(ids, log_weight, starts):
        own = np.add.reduceat(ids, starts)
        out = (own[:, None] * np.arange(1, 97, 2, dtype=np.uint64) >> np.uint64(32)).astype(np.uint32)
        out[:, : near_dup.ROWS] = 7
        return out

    monkeypatch.setattr(near_dup, "samples", unlucky)
    rnd = random.Random(17)
    rows = []
    for _ in range(8):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(90)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:86] + ["end"]))]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    check_classes(documents)
    assert {r.class_id for r in near_dup.classes(documents).collect()} == set(range(0, 16, 2))


def test_near_duplicates_in_crowds(spark, monkeypatch):
    """Large groups of near copies, of which many are unlike any hub."""
    for name, value in (("CROWD", 3), ("OUTSIDE", 4), ("INSIDE", 8)):
        monkeypatch.setattr(near_dup, name, value)
    rnd = random.Random(11)
    rows = []
    for _ in range(3):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(90)]
        for _ in range(40):
            words = list(base)
            for k in rnd.sample(range(90), rnd.randint(0, 4)):
                words[k] = f"w{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    check_classes(spark.createDataFrame(rows, "doc_id long, text string"))


def test_near_duplicates_of_odd_rows(odd, nothing):
    check_classes(odd)
    kept = near_dup.one_of_each(odd)
    assert kept.columns == odd.columns
    wordless = odd.where(~F.coalesce("text", F.lit("")).rlike(r"(?U)\S")).count()
    named = [c for r, c in ((r.doc_id, r.class_id) for r in near_dup.classes(odd.where("doc_id = 4 OR doc_id > 3")).collect())]
    assert kept.count() == wordless + len(set(named)) + 1  # the one whose id is null
    assert near_dup.classes(nothing).count() == near_dup.one_of_each(nothing).count() == 0


def test_a_chain_that_no_hub_spans_is_one_class(spark):
    """Each text is like the next one only."""
    rnd = random.Random(1)
    words = [f"w{rnd.randrange(10**9)}" for _ in range(400)]
    rows = [(k, " ".join(words[8 * k : 8 * k + 120])) for k in range(24)]
    got = near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0}


def test_samples_agree_as_often_as_weights_do():
    rnd = np.random.default_rng(4)
    both = rnd.integers(1, 1 << 63, 900).astype(np.uint64)
    parts = [np.sort(both[:800]), np.sort(both[100:])]
    equal = []
    for seed in range(40):
        mixed = [np.sort(p * np.uint64(2 * seed + 3)) for p in parts]
        rows = near_dup.samples(
            np.concatenate(mixed), np.zeros(1600, np.float32), np.array([0, 800])
        )
        equal.append((rows[0] == rows[1]).mean())
    assert abs(np.mean(equal) - 700 / 900) < 0.03


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    got = components.components(spark.createDataFrame(edges, "u long, v long")).collect()
    root = {}
    for u, v in edges:
        a, b = ({u} if u not in root else root[u]), ({v} if v not in root else root[v])
        for x in a | b:
            root[x] = a | b
    for _ in range(3):
        for u, v in edges:
            joined = root[u] | root[v]
            for x in joined:
                root[x] = joined
    want = {x: min(part) for x, part in root.items() if len(part) > 1}
    assert {r.node: r.component for r in got} == want


def test_digest_of_copies(spark):
    """The first of several copies stays whole, the others go whole."""
    text = "".join(random.Random(9).choices("abcdefgh ", k=700))
    rows = [(k, text) for k in (5, 3, 9)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    digests = {r.doc_id: hashlib.sha256(bytes(r.remains.kept)).hexdigest() for r in got.collect()}
    assert digests[3] == hashlib.sha256(text.encode()).hexdigest()
    assert digests[5] == digests[9] == hashlib.sha256(b"").hexdigest()


def test_texts_without_an_id_are_told_apart_by_all_of_their_digest(spark):
    """Among them two whose 64-bit hashes agree in 31 bits; nothing in them occurs twice."""
    rnd = random.Random(12)
    seen, pair = {}, None
    while pair is None:
        text = "".join(rnd.choices("abcdefgh ", k=205))
        short = xxhash.xxh64_intdigest(text.encode(), 42) & 0x7FFFFFFF
        pair = (seen[short], text) if short in seen else None
        seen[short] = text
    rows = [(None, text) for text in pair] + [(None, t) for t in list(seen.values())[:2000]]
    for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert bytes(r.remains.kept).decode() == r.text


def test_no_id_is_not_the_last_id(spark):
    text = "".join(random.Random(13).choices("abcdefgh ", k=300))
    rows = [(None, text), ((1 << 63) - 1, text)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: len(r.remains.kept) for r in got} == {None: 0, (1 << 63) - 1: 300}


def test_working_names_of_a_user_s_columns_are_kept(spark):
    names = "row doc__ ta__ tb__ doc ta tb packed__ hits__ remains stretch".split()
    rows = [(k, "".join(random.Random(k // 2).choices("abcd ", k=150)), *names) for k in range(4)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    cut = suffix_dedup.without_repeats(documents)
    assert cut.columns == documents.columns
    for r in cut.collect():
        assert [r[n] for n in names] == names and len(r.text) == (0 if r.doc_id % 2 else 150)
    digests = suffix_dedup.remove_repeats(documents, into="kept")
    assert digests.columns == [*documents.columns, "kept"] and digests.where("ta__ = 'ta__'").count() == 4
