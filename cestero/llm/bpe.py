"""Byte-level BPE of whole blocks of texts by replaying the merges in rank order.

For the words of a block that are not known yet, an inverted index leads from
the rank of a pair to the places where it stands. The ranks are taken in order;
each merge visits only the places of its pair and looks up the two pairs that it
makes there, so a word is touched as often as it has merges, not as often as
there are ranks.

A null text counts as the empty one and gives an empty list of ids, which
decodes to no bytes; texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import heapq
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cestero.llm.lookup import looked_up, small, space_led, text_of
from cestero.llm.text import Memo, of_worker

#: Stands for a character that the library takes as neither letter, number nor space.
_OTHER = "†"
#: Words in one generation of a worker's memory.
MEMORY = 1 << 19


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file by their rank."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def younger_characters() -> str:
    """A character class of what is a letter or number here, but not to the library.

    The two know different versions of Unicode; to the older one the
    characters are unassigned.
    """
    single = {bytes([b]): b for b in range(256)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    found: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        library = tiktoken.Encoding("kind", pat_str=kind, mergeable_ranks=single, special_tokens={})
        found |= set(regex.findall(kind, every)) - set(
            bytes(library.encode_ordinary(every)).decode("utf-8")
        )
    return "".join(sorted(found))


class Replay:
    """Merges of one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str, younger: str):
        self.rank = {t: k for k, t in enumerate(tokens) if t}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.pairs = {}
        for k, token in enumerate(tokens):
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 20 | b] = k
        self.pattern = regex.compile(pattern)
        self.others = {ord(c): _OTHER for c in younger}
        self.oldest = min(younger, default="")

    def matches(self, text: str) -> list[str]:
        """All matches of the pattern, as the library finds them."""
        if self.oldest and not text.isascii() and max(text) >= self.oldest:
            found = self.pattern.finditer(text.translate(self.others))
            return [text[m.start() : m.end()] for m in found]
        return self.pattern.findall(text)

    def greedy(self, word: bytes) -> list[int]:
        """The lowest rank first, the leftmost first among equals."""
        ids = [int(self.byte[b]) for b in word]
        while len(ids) > 1:
            ranks = [self.pairs.get(a << 20 | b, 1 << 40) for a, b in zip(ids, ids[1:])]
            low = min(ranks)
            if low == 1 << 40:
                break
            k = ranks.index(low)
            ids[k : k + 2] = [low]
        return ids

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as bytes of unsigned 32-bit integers."""
        out: list[bytes | None] = [None] * len(words)
        rest = []
        for k, word in enumerate(words):
            whole = self.rank.get(word)
            if whole is None:
                rest.append(k)
            else:
                out[k] = whole.to_bytes(4, "little")
        for k, ids in zip(rest, self._replay([words[k] for k in rest])):
            out[k] = ids
        return out

    def _replay(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        ids = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends[sizes > 0] - 1] = -1
        before[starts[sizes > 0]] = -1
        keys = ids[:-1] << 20 | ids[1:]
        inside = np.flatnonzero(after[:-1] >= 0)
        distinct, which = np.unique(keys[inside], return_inverse=True)
        ranks = np.array([self.pairs.get(int(k), -1) for k in distinct], np.int64)[which]
        inside, ranks = inside[ranks >= 0], ranks[ranks >= 0]
        order = np.argsort(ranks, kind="stable")
        cut_ranks, cuts = np.unique(ranks[order], return_index=True)
        index = {
            int(r): places.tolist()
            for r, places in zip(cut_ranks, np.split(inside[order], cuts[1:]))
        }
        heap = sorted(index)
        token, after, before = ids.tolist(), after.tolist(), before.tolist()
        pair, first = self.pairs.get, starts.tolist()
        irregular: set[int] = set()
        while heap:
            rank = heapq.heappop(heap)
            for p in sorted(index.pop(rank)):
                q = after[p]
                if q < 0 or token[p] < 0 or pair(token[p] << 20 | token[q]) != rank:
                    continue
                token[p], token[q] = rank, -1
                following = after[p] = after[q]
                ahead = before[p]
                if following >= 0:
                    before[following] = p
                for a, b in ((ahead, p), (p, following)):
                    if a < 0 or b < 0:
                        continue
                    made = pair(token[a] << 20 | token[b])
                    if made is None:
                        continue
                    if made < rank:  # due before the further places of this rank
                        irregular.add(bisect_right(first, p) - 1)
                    if made in index:
                        index[made].append(a)
                    else:
                        index[made] = [a]
                        heapq.heappush(heap, made)
        left = np.array(token, np.int64)
        alive = left >= 0
        counts = np.concatenate(([0], np.cumsum(alive)))
        raw = left[alive].astype("<u4").tobytes()
        cut = list(zip((4 * counts[starts]).tolist(), (4 * counts[ends]).tolist()))
        out = [raw[a:b] for a, b in cut]
        for k in irregular:
            out[k] = np.array(self.greedy(words[k]), "<u4").tobytes()
        return out

    def pieces(self, keys: list[str], memo: Memo) -> list[bytes | None]:
        """Ids of space-led pieces; every match of the pattern is a word.

        Words that are remembered as pieces of their own, such as one that a
        full stop follows here, are not encoded again.
        """
        found: list[list[str] | None] = []
        ids: dict[str, bytes | None] = {}
        for key in keys:
            if key.isascii() and key.isalpha():
                words = [" " + key]
            else:
                text = text_of(key)
                words = None if text is None else self.matches(text)
            found.append(words)
            for word in words or ():
                if word not in ids:
                    led = len(words) > 1 and word[0] == " " and len(word) > 1
                    ids[word] = memo.recall(word[1:]) if led else None
        new = [word for word, value in ids.items() if value is None]
        ids.update(zip(new, self.words([word.encode() for word in new])))
        return [None if w is None else b"".join([ids[x] for x in w]) for w in found]

    def whole(self, text: str) -> list[bytes]:
        return self.words([m.encode() for m in self.matches(text)])


def _encoder(spark: SparkSession, ranks: str, pattern: str):
    """From batches of ``doc_id, text`` to batches of ``doc_id, ids``.

    The vocabulary is broadcast; it is as large as its file, whatever the corpus.
    """
    shared = spark.sparkContext.broadcast((read_ranks(ranks), pattern, younger_characters()))
    key = f"replay {ranks}"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, memo = of_worker("bpe", key, lambda: (Replay(*shared.value), Memo(most=MEMORY)))

        def pieces(keys: list[str]) -> list[bytes | None]:
            return replay.pieces(keys, memo)

        for batch in small(batches):
            parts: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            texts = (t.as_py() for t in batch.column(1))
            for k, values in looked_up(texts, memo, space_led, pieces, replay.whole):
                parts[k].append(b"".join(values))
            joined = [b"".join(p) for p in parts]
            ends = np.cumsum([0] + [len(j) // 4 for j in joined]).astype(np.int32)
            values = np.frombuffer(b"".join(joined), np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, values)], ["doc_id", "ids"]
            )

    return encoded


def _decoder(spark: SparkSession, ranks: str):
    """From batches of ``doc_id, ids`` to batches that have ``decoded`` besides."""
    shared = spark.sparkContext.broadcast(read_ranks(ranks))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        sizes = np.array([len(t) for t in tokens], np.int64)
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
            raw = b"".join(map(tokens.__getitem__, ids.tolist()))
            lengths = np.concatenate(([0], np.cumsum(sizes[ids])))
            cuts = lengths[ends - ends[0]].astype(np.int32)
            binary = pa.Array.from_buffers(
                pa.binary(), len(lists), [None, pa.py_buffer(cuts), pa.py_buffer(raw)]
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, binary], ["doc_id", "ids", "decoded"]
            )

    return decoded


_IDS = "doc_id long, ids array<int>"
_DECODED = f"{_IDS}, decoded binary"


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def encode(documents: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of each text by the rank file at ``ranks``."""
    encoder = _encoder(documents.sparkSession, ranks, pattern)
    return _texts(documents).mapInArrow(encoder, _IDS)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that the ids stand for."""
    decoder = _decoder(encoded.sparkSession, ranks)
    return encoded.select("doc_id", "ids").mapInArrow(decoder, _DECODED)


def round_trip(documents: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``decode`` of ``encode``, one after the other in the same worker."""
    spark = documents.sparkSession
    encoder, decoder = _encoder(spark, ranks, pattern), _decoder(spark, ranks)
    return _texts(documents).mapInArrow(lambda batches: decoder(encoder(batches)), _DECODED)
