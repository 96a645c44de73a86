"""Packing of documents into sequences by patterns of lengths.

Which lengths go together depends on the histogram of lengths alone, which has
as many cells as a sequence has tokens, however large the corpus is. Patterns of
a few lengths that fill a sequence exactly are enumerated, their repeat counts
are fitted to the histogram by non-negative least squares and rounded down, and
what is left is packed best-fit, longest first, again on the histogram. The
plan that comes out, a bounded list of patterns with repeat counts, is broadcast,
and each piece finds its place in it by its rank among the pieces of its length.

Ranks need no group of equal lengths in one place: a task numbers its own
pieces of each length, and the tasks' counts are summed up to offsets.

A null text is the empty one; a document is at least its end token, so every row
gives at least one piece. Repeated rows are pieces of their own. Null ids are
kept as they are.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cestero.llm.lookup import library, looked_up, small, white_split
from cestero.llm.text import Memo, of_worker, staged

LENGTH = 4096
#: Ends each document.
END = 1
#: Patterns of three lengths that are fitted, at most, besides those of two.
TRIPLES = 20_000
#: Words in one generation of a worker's memory.
MEMORY = 1 << 19
SWEEPS = 12

Plan = list[tuple[int, list[tuple[int, int]]]]


def tokenised(documents: DataFrame, tokenizer: str, length: int = LENGTH, ids: bool = False):
    """Pieces of the documents' tokens: ``doc_id, piece, start, length, ids_crc32``.

    ``task, rank`` number the pieces of one length in the task that made them.
    With ``ids`` the tokens come along. ``tokenizer`` is a library file whose
    pattern drops white space.
    """
    with open(tokenizer, encoding="utf-8") as file:
        vocabulary = documents.sparkSession.sparkContext.broadcast(file.read())
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"]
    types = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, rank long"
    if ids:
        names, types = [*names, "ids"], f"{types}, ids array<int>"
    end = END.to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library(vocabulary.value, "packing")
        memo = of_worker("packing", f"ids {tokenizer}", lambda: Memo(most=MEMORY))
        task, ranks = TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)

        def encode(keys: list[bytes]) -> list[bytes]:
            texts = [key.decode() for key in keys]
            encoded = own.encode_batch_fast(texts, add_special_tokens=False)
            return [array("I", e.ids).tobytes() for e in encoded]

        def whole(text: str) -> list[bytes]:
            return encode([text.encode()])

        for batch in small(batches):
            parts: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            texts = (t.as_py() for t in batch.column(1))
            for k, values in looked_up(texts, memo, white_split, encode, whole):
                parts[k].append(b"".join(values))
            out: list[tuple] = []
            raws = []
            for doc_id, part in zip(batch.column(0).to_pylist(), parts):
                raw = b"".join([*part, end])
                for piece, at in enumerate(range(0, len(raw), 4 * length)):
                    cut = raw[at : at + 4 * length]
                    n = len(cut) // 4
                    out.append((doc_id, piece, at // 4, n, zlib.crc32(cut), task, int(ranks[n])))
                    ranks[n] += 1
                    raws.append(cut)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else []
            if not out:
                continue
            if ids:
                ends = np.cumsum([0] + [len(r) // 4 for r in raws]).astype(np.int32)
                values = np.frombuffer(b"".join(raws), np.int32)
                columns.append(pa.ListArray.from_arrays(ends, values))
            yield pa.RecordBatch.from_arrays(columns, names)

    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return texts.mapInArrow(pieces, types)


def filling_patterns(lengths: np.ndarray, room: int) -> np.ndarray:
    """Rows of three lengths (the first may be 0) that fill ``room`` exactly."""
    there = np.zeros(room + 1, bool)
    there[lengths] = True
    low = lengths[2 * lengths <= room]
    pairs = low[there[room - low]]
    found = [np.stack([0 * pairs, pairs, room - pairs], axis=1)]
    step = 1
    usable = lengths[3 * lengths <= room]
    while len(usable) * len(lengths) / 4 / step > TRIPLES:
        step += 1
    for a in usable:
        middle = lengths[(lengths >= a) & (2 * lengths <= room - a)][int(a) % step :: step]
        middle = middle[there[room - a - middle]]
        found.append(np.stack([0 * middle + a, middle, room - a - middle], axis=1))
    return np.concatenate(found).astype(np.int64)


def fitted_counts(patterns: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative least squares by coordinate descent; residuals weigh as their length."""
    left = histogram.astype(float)
    left[0] = 0
    left, counts = left.tolist(), [0.0] * len(patterns)
    rows = [[int(i) for i in p if i] for p in patterns]
    norms = [sum(i * row.count(i) for i in row) for row in rows]
    for _ in range(SWEEPS):
        for j, row in enumerate(rows):
            step = sum([i * left[i] for i in row]) / norms[j]
            if step < -counts[j]:
                step = -counts[j]
            if step:
                counts[j] += step
                for i in row:
                    left[i] -= step
    return np.array(counts)


def plan_packing(histogram: np.ndarray) -> Plan:
    """Repeat counts with ``(length, copies)`` lists; every piece is in exactly one."""
    room = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    plan: Plan = []
    if left[room]:
        plan.append((int(left[room]), [(room, 1)]))
        left[room] = 0
    lengths = np.flatnonzero(left)
    if len(lengths):
        patterns = filling_patterns(lengths, room)
        for pattern, count in zip(patterns, fitted_counts(patterns, left)):
            parts = {int(i): int((pattern == i).sum()) for i in pattern if i}
            count = min(int(count), *(int(left[i]) // c for i, c in parts.items()))
            if count > 0:
                plan.append((count, sorted(parts.items(), reverse=True)))
                for i, c in parts.items():
                    left[i] -= c * count
    return plan + best_fit(left)


def best_fit(histogram: np.ndarray) -> Plan:
    """Longest first into the fullest sequences with room, many equal ones at a time."""
    size = len(histogram) - 1
    groups: list[list[tuple[int, tuple]]] = [[] for _ in range(size + 1)]  # by room left
    for length in range(size, 0, -1):
        todo, room = int(histogram[length]), length
        while todo:
            while room <= size and not groups[room]:
                room += 1
            if room > size:
                each = min(size // length, todo)
                count = todo // each
                groups[size - each * length].append((count, ((length, each), None)))
                todo -= each * count
                # What is left over, less than a full sequence, opens one of its own.
                room = length
                if todo:
                    groups[size - todo * length].append((1, ((length, todo), None)))
                    todo = 0
                break
            count, parts = groups[room].pop()
            each = min(room // length, todo)
            taken = min(count, todo // each)
            if taken < count:
                groups[room].append((count - taken, parts))
            groups[room - each * length].append((taken, ((length, each), parts)))
            todo -= taken * each
            room = length
    plan: Plan = []
    for group in groups:
        for count, node in group:
            parts = []
            while node:
                part, node = node
                parts.append(part)
            plan.append((count, parts[::-1]))
    return plan


def slots(plan: Plan) -> np.ndarray:
    """Rows ``length, first rank, copies, offset, first sequence``, sorted by the first two."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for count, parts in plan:
        offset = 0
        for length, copies in parts:
            rank = used.get(length, 0)
            rows.append((length, rank, copies, offset, sequence))
            used[length] = rank + copies * count
            offset += copies * length
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """``tokenised`` pieces with ``sequence_id, offset``; ``task, rank`` are dropped.

    ``pieces`` has to be a written table, as its tasks' numbering is relied on.
    At most ``length`` counts reach the driver.
    """
    per_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    histogram = np.zeros(length + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():
        histogram[row["length"]] = row["count"]
    shared = pieces.sparkSession.sparkContext.broadcast(slots(plan_packing(histogram)))
    kept = [c for c in pieces.columns if c not in ("task", "rank")]

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = shared.value
        keys = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            rank = (batch.pop("rank") + batch.pop("before")).to_numpy(np.int64)
            own = batch["length"].to_numpy(np.int64)
            row = table[np.searchsorted(keys, own << 44 | rank, side="right") - 1]
            index = rank - row[:, 1]
            batch["sequence_id"] = row[:, 4] + index // row[:, 2]
            batch["offset"] = row[:, 3] + index % row[:, 2] * own
            yield batch

    numbered = pieces.join(offsets.drop("n"), ["length", "task"]).select(*kept, "rank", "before")
    schema = pieces.select(*kept).schema.add("sequence_id", "long").add("offset", "long")
    return numbered.mapInPandas(placed, schema)


def pack_documents(documents: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of all pieces."""
    packed = pack(staged(tokenised(documents, tokenizer, length)), length)
    return packed.withColumn("length", F.col("length").cast("long"))
