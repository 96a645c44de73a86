"""Token counts, byte-level BPE and packing against the libraries."""

import base64
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cestero.llm import bpe, lookup, packing, token_counts

COUNTED = public_tokenizers.path("byte_bpe_50k.json")
PACKED = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

TEXTS = [
    "", " ", "  ", "a  b", "a   b", " a", "\n a", "a \n b", "a\n\n  b  ", "x <|endoftext|> y",
    "<|endoftext|>", "<|ENDOFTEXT|> <|startoftext|>", "it's  'tis IT'S", "՘࢏ abc՘",
    " " * 50, "aaaa" * 500, "é́  x̱ H̱ y", "tail ", "\t\tx\ty", "a\x1c b\x1f",
    "🎉🎉 hi🎉", "a" * 3000 + " b", "1234567 89 ௰", "İstanbul ΣΑΣ Σ K",
]


@pytest.fixture(scope="module")
def exact():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def documents(spark, odd):
    rows = spark.createDataFrame(list(enumerate(TEXTS, 100)), "doc_id long, text string")
    return odd.unionByName(rows, allowMissingColumns=True)


def in_rows(rows):
    return sorted(rows, key=str)


def test_counts_are_the_library_s(documents, nothing):
    library = Tokenizer.from_file(COUNTED)
    want = []
    for r in documents.collect():
        text = r.text or ""
        n = len(library.encode(text, add_special_tokens=False))
        want.append((r.doc_id, len(text.encode()), n, n > 512))
    got = token_counts.token_counts(documents, COUNTED)
    assert in_rows(map(tuple, got.collect())) == in_rows(want)
    assert token_counts.token_counts(nothing, COUNTED).count() == 0


def test_encoding_and_decoding_are_the_library_s(documents, nothing, exact):
    want = in_rows((r.doc_id, exact.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in documents.collect())
    trip = bpe.round_trip(documents, RANKS, PATTERN)
    assert in_rows((r.doc_id, r.ids, bytes(r.decoded)) for r in trip.collect()) == want
    apart = bpe.decode(bpe.encode(documents, RANKS, PATTERN), RANKS)
    assert in_rows((r.doc_id, r.ids, bytes(r.decoded)) for r in apart.collect()) == want
    assert bpe.round_trip(nothing, RANKS, PATTERN).count() == 0


@pytest.fixture(scope="module")
def replay():
    return bpe.Replay(bpe.read_ranks(RANKS), PATTERN, bpe.younger_characters())


@settings(max_examples=150, deadline=None)
@given(text=st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_replay_of_any_text(text, replay, exact):
    ids = np.frombuffer(b"".join(replay.whole(text)), "<u4").tolist()
    assert ids == exact.encode_ordinary(text)
    words = [m.encode() for m in replay.matches(text)]
    greedy = [k for w in words for k in ([replay.rank[w]] if w in replay.rank else replay.greedy(w))]
    assert greedy == ids


def test_ranks_out_of_order_fall_back_to_the_exact_way():
    """A merge that makes a pair of lower rank, which is due at once."""
    single = [bytes([b]) for b in range(256)]
    replay = bpe.Replay([*single, b"xab", b"ab", b"abab"], PATTERN, "")
    for word in (b"xabab", b"ababxab", b"abxabab"):
        assert np.frombuffer(replay._replay([word])[0], "<u4").tolist() == replay.greedy(word)


@settings(max_examples=200, deadline=None)
@given(text=st.text(st.sampled_from(" \n\tab'1.é　"), max_size=30))
def test_pieces_are_cut_where_the_library_cuts(text, exact):
    memo = lookup.Memo()

    def encode(keys):
        texts = [lookup.text_of(k) for k in keys]
        return [None if t is None else tuple(exact.encode_ordinary(t)) for t in texts]

    whole = lambda s: [tuple(exact.encode_ordinary(s))]
    got = [v for _, values in lookup.looked_up([text], memo, lookup.space_led, encode, whole, 4) for v in values]
    assert [i for v in got for i in v] == exact.encode_ordinary(text)


def pieces_of(documents, length):
    library = Tokenizer.from_file(PACKED)
    for r in documents.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), length)):
            cut = ids[at : at + length]
            yield r.doc_id, piece, at, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))


@pytest.mark.parametrize("length", [16, 4096])
def test_packing(documents, length):
    rows = packing.pack_documents(documents, PACKED, length).collect()
    got = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert in_rows(got) == in_rows(pieces_of(documents, length))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    assert len(sequences) <= -(-sum(r.length for r in rows) // length) * 1.02 + 1


def test_packing_of_nothing(nothing):
    assert packing.pack_documents(nothing, PACKED).count() == 0


def test_a_plan_places_every_length_of_a_histogram():
    rnd = np.random.default_rng(2)
    for _ in range(30):
        histogram = np.zeros(101, np.int64)
        for length in rnd.integers(1, 101, 40):
            histogram[length] += rnd.integers(1, 50)
        plan = packing.plan_packing(histogram)
        used = Counter()
        for count, parts in plan:
            assert sum(n * c for n, c in parts) <= 100 and count > 0
            used.update({n: 0 for n, _ in parts})
            for n, c in parts:
                used[n] += c * count
        assert used == Counter({n: int(c) for n, c in enumerate(histogram) if c})
        rows = packing.slots(plan)
        assert len(np.unique(rows[:, :2], axis=0)) == len(rows)
