"""Words, hashes and shared folders, as the operators of this package use them."""

from __future__ import annotations

import atexit
import ctypes
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cestero.sinks.shared import shared_folder, stage_table

#: Texts are cut at white space into pieces of about so many characters while
#: their words are listed, so that a very long text needs no more memory.
SLICE = 1 << 20
#: Words in one generation of a worker's memory.
REMEMBERED = 1 << 18

_EDGES = re.compile(r"^\W+|\W+$")
_SPACE = re.compile(r"\s")


def slices(text: str, size: int = SLICE, gaps: re.Pattern = _SPACE) -> Iterator[str]:
    """Pieces of ``text`` that begin at a gap; one after the other they are the text."""
    start = 0
    while len(text) - start > size:
        gap = gaps.search(text, start + size)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:] if start else text


def plain_word(chunk: str) -> str:
    """Lower case without marks at the edges; what has only marks stays as it is."""
    lower = chunk.lower()
    return lower if lower.isalnum() else _EDGES.sub("", lower) or lower


class Memo(dict):
    """Values of ``compute`` by key. What was not asked for lately is forgotten.

    Keys live in two generations of at most ``most``; when the young one is
    full it becomes the old one, and what the old one held is dropped.
    """

    def __init__(self, compute=None, most: int = REMEMBERED):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        value = self.recall(key)
        if value is None:
            value = self.compute(key)
            self.keep(key, value)
        return value

    def recall(self, key):
        value = self.get(key)
        if value is None:
            value = self.old.pop(key, None)
            if value is not None:
                self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value


def kept_by(owner: str) -> dict:
    """What an operator, the ``owner``, keeps in a worker process, which outlives a task.

    What another one has left there is let go first, also if this one keeps nothing.
    Called once a task, as it also hands back what earlier tasks have freed.
    """
    kept = sys.__dict__.setdefault("_cestero_kept", {})
    if kept.keys() - {owner}:
        kept.clear()
    _hand_back()
    return kept.setdefault(owner, {})


def _hand_back() -> None:
    """Return freed memory to the system, which allocators otherwise keep for the worker."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def of_worker(owner: str, name: str, make):
    """``make()`` once for a worker process; asked for once a task."""
    own = kept_by(owner)
    if name not in own:
        own[name] = make()
    return own[name]


def word_hash(chunk: str) -> int:
    return xxhash.xxh3_64_intdigest(plain_word(chunk).encode("utf-8", "surrogatepass"))


def word_hashes(text: str, memo: Memo) -> np.ndarray:
    """64 bits for each word of a text."""
    parts = []
    for piece in slices(text):
        words = piece.split()
        parts.append(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows no model may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_texts(
    documents: DataFrame, labels: DataFrame, label: str, most: int
) -> DataFrame:
    """``text, label`` of at most ``most`` labelled documents that may be learnt from.

    Which ones is decided by a hash of the id, so that a repeat learns the same.
    At most ``most`` ids are broadcast, which bounds that side of the join.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(most)
    )
    return (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")
    )


def staged(df: DataFrame) -> DataFrame:
    """``df`` written once below the shared folder, where it stays until this process ends."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession)

    def remove() -> None:
        if spark._jsc.sc().isStopped():
            return
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    atexit.register(remove)
    return stage_table(df, folder)
