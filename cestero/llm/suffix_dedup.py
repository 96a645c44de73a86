"""Removal of repeated byte strings by a sparse suffix array with bucket pointers.

A byte goes if a string of ``SPAN`` bytes covers it that also starts earlier: in
a document with a smaller id, or further ahead in the same one.

Suffixes are bucketed by their first ``GRAM`` bytes. A bucket's identifier is
built from identifiers of half the depth, its own and that of a later offset
(1, 2, 4, ... bytes), so that each step reuses what the last one made.
Of these suffixes only those are sorted whose identifier is the smallest among
``SPAN - GRAM + 1`` neighbours: every string of ``SPAN`` bytes has such an
anchor, at the same place wherever it occurs, so no repeat is missed.

1. Anchors are sorted by bucket and by the identifier of their surroundings, all
   bytes that a string of ``SPAN`` bytes through the anchor can reach. Of equal
   surroundings all but the earliest are covered whole.
2. Buckets that still hold several different surroundings are refined: with the
   bytes around each anchor at hand, identifiers are doubled on from ``GRAM`` to
   ``SPAN`` bytes by those of later offsets, and sorting by them tells which
   strings occur earlier in the bucket.

A task settles equal surroundings of its own documents before anything is
shuffled and deals buckets that are large within it by their surroundings, so
that a passage in a third of all documents gives each task's partner a few rows.
Buckets of more than ``CROWD`` different surroundings are refined by a grouping
on the identifiers themselves, which combines before it shuffles.

Identifiers have 64 bits, and two of them have to agree. A null text is the
empty one. Texts under ``SPAN`` bytes keep all. A null id comes after all
others; rows of equal id but different text are ordered by a digest of the text,
88 bits of its MD5; rows alike in id and text are one document, and each gets
that document's result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cestero.llm.text import kept_by, mixed, staged

SPAN, GRAM = 100, 32
#: Different surroundings of a bucket that one task refines by itself, at most.
CROWD = 1 << 16
#: Different surroundings of a bucket within one task, from which on they are dealt out.
LOCAL_CROWD = 16
#: Bytes of a text and rows of a bucket table that are worked on at a time.
SEGMENT, ROWS = 1 << 20, 1 << 14

_U = np.uint64
_FACTORS = [_U(f) for f in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                            0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD,
                            0xC4CEB9FE1A85EC53)]
_MARK = np.iinfo(np.int64).max
_LAST_ID = (1 << 63) - 1


def identifiers(ids: np.ndarray, start: int, depth: int) -> np.ndarray:
    """Of buckets ``depth`` deep, from those ``start`` deep (a power of two times it), by the last axis."""
    level = start.bit_length() - 1
    while start < depth:
        deeper = ids[..., :-start] * _FACTORS[level]
        deeper += ids[..., start:]
        deeper ^= deeper >> _U(29)
        ids, start, level = deeper, 2 * start, level + 1
    return ids


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    size = 1
    while 2 * size <= width:
        values, size = pick(values[:-size], values[size:]), 2 * size
    rest = width - size
    return pick(values[:-rest], values[rest:]) if rest else values


def anchors(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """Positions, bucket identifiers and those of the surroundings, a segment at a time."""
    n, reach = len(raw), SPAN - GRAM
    if n < SPAN:
        return
    for a in range(0, n - GRAM + 1, SEGMENT):
        low = max(0, a - reach)
        part = np.frombuffer(raw, np.uint8)[low : a + SEGMENT + SPAN - 1]
        if len(part) < SPAN:  # the tail: what reaches it began before
            low = n - SPAN
            part = np.frombuffer(raw, np.uint8)[low:]
        ids = mixed(identifiers(part.astype(np.uint64) + _U(1), 1, GRAM))
        edge = np.zeros(reach, np.uint64)
        lowest = _slide(ids, reach + 1, np.minimum)
        chosen = _slide(np.concatenate((edge, lowest, edge)), reach + 1, np.maximum)
        at = np.flatnonzero(chosen == ids)
        at = at[(at + low >= a) & (at + low < a + SEGMENT)]
        buckets, at = ids[at], at + low
        left, right = np.maximum(at - reach, 0).tolist(), np.minimum(at + SPAN, n).tolist()
        hashed = xxhash.xxh3_64_intdigest
        around = [hashed(raw[x:y], seed=p - x) for x, y, p in zip(left, right, at.tolist())]
        yield at, buckets, around


#: ``at`` is the place of an anchor, above it the second part of the document's digest.
_ANCHOR = "route long, q long, c long, doc long, ta long, at long"


def _locally_settled(q, c, own, at, docs: list[tuple[int, int, int]]) -> pa.RecordBatch:
    """Rows of anchors for the shuffle; ``own`` is the place of an anchor's document in ``docs``.

    ``at`` is negative for anchors that are settled: an earlier one of this
    task has the same surroundings.
    """
    keys = sorted(set(docs))
    rank = {key: k for k, key in enumerate(keys)}
    doc = np.array([rank[key] for key in docs])[own]
    order = np.lexsort((at, doc, c, q))
    q, c, doc, at = q[order], c[order], doc[order], at[order]
    new_q = np.ones(len(q), bool)
    new_q[1:] = q[1:] != q[:-1]
    first = new_q.copy()
    first[1:] |= c[1:] != c[:-1]
    again = np.zeros(len(q), bool)
    again[1:] = ~first[1:] & (doc[1:] == doc[:-1]) & (at[1:] == at[:-1])
    bucket = np.cumsum(new_q) - 1
    crowded = np.bincount(bucket, first)[bucket] >= LOCAL_CROWD
    route = q.copy()
    dealt = crowded | ~first
    salt = np.where(first, c, at).view(np.uint64) * _FACTORS[0]
    route[dealt] = mixed(salt + q.view(np.uint64)).view(np.int64)[dealt]
    docs_, ta, tb = np.array(keys, np.int64).reshape(-1, 3).T
    at = tb[doc] << 32 | at
    at = np.where(first, at, -1 - at)
    keep = ~again
    marks = new_q & crowded
    columns = [
        np.concatenate((x[keep], y))
        for x, y in (
            (route, q[marks]),
            (q, q[marks]),
            (c, ~c[marks]),
            (docs_[doc], docs_[doc[marks]]),
            (ta[doc], ta[doc[marks]]),
            (at, np.full(marks.sum(), _MARK)),
        )
    ]
    names = ["route", "q", "c", "doc", "ta", "at"]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept_by("suffix dedup")
    held: list[tuple] = []
    docs: list[tuple[int, int, int]] = []
    size = 0
    for batch in batches:
        keys = zip(*(batch.column(k).to_pylist() for k in range(3)))
        for key, text in zip(keys, batch.column(3)):
            docs.append(key)
            for at, buckets, around in anchors(text.as_buffer().to_pybytes()):
                held.append(
                    (
                        buckets.view(np.int64),
                        np.array(around, np.uint64).view(np.int64),
                        np.full(len(at), len(docs) - 1, np.int32),
                        at,
                    )
                )
                size += len(at)
            if size >= 1 << 19:
                yield _locally_settled(*map(np.concatenate, zip(*held)), docs)
                held, docs, size = [], [], 0
    if held:
        yield _locally_settled(*map(np.concatenate, zip(*held)), docs)


def _settled_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted anchors: ``settled`` ones, and those whose bucket has to be refined.

    Whatever the size of a bucket, one row of it is held.
    """
    kept_by("suffix dedup")
    pending = None  # (q, row of its only surroundings so far or None if there are several)
    last = None  # the row before
    for batch in batches:
        rows = [batch.column(k).to_numpy() for k in range(6)]
        done = rows[-1] < 0
        _, q, _, doc, ta, at = (x[done] for x in rows)
        parts = [(doc, ta, -1 - at, q, np.ones(len(q), bool))]
        rows = [x[~done] for x in rows]
        route, q, c, doc, ta, at = rows
        if len(q):
            before = last or (0,) * len(rows)
            same = [x == np.concatenate(([v], x[:-1])) for v, x in zip(before, rows)]
            new_q = ~(same[0] & same[1])
            new_q[0] |= last is None
            first = new_q | ~same[2]
            again = ~first & same[3] & same[4] & same[5]
            last = tuple(int(x[-1]) for x in rows)
            rest = ~first & ~again & (at != _MARK)
            own = (doc, ta, at, q)
            parts.append((*(x[rest] for x in own), np.ones(rest.sum(), bool)))
            bucket = np.cumsum(new_q)  # 0: goes on from the batch before
            size = np.bincount(bucket, first, minlength=bucket[-1] + 1)
            held = pending if bucket[0] == 0 else None
            if held and size[0]:
                if held[1] is not None:
                    parts.append(held[1])
                    pending = (held[0], None)
                size[0] = max(size[0], 2)
            known = (size[bucket] > 1) | (route != q)
            refined = first & known & (at != _MARK)
            parts.append((*(x[refined] for x in own), np.zeros(refined.sum(), bool)))
            if bucket[-1] > 0:
                k = np.flatnonzero(first & (bucket == bucket[-1]))
                alone = len(k) == 1 and route[k[0]] == q[k[0]]
                row = None
                if alone:
                    kept = np.array([at[k[0]] != _MARK])
                    row = (*(x[k][kept] for x in own), np.zeros(kept.sum(), bool))
                pending = (int(q[-1]), row)
        doc, ta, at, q, settled = (np.concatenate(x) for x in zip(*parts))
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (doc, ta, at >> 32, at & 0xFFFFFFFF, q, settled)],
            ["doc", "ta", "tb", "pos", "q", "settled"],
        )


_AROUND = "q long, doc long, ta long, tb long, pos long, left int, around binary"


def _surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes around each anchor that is still open."""
    kept_by("suffix dedup")
    reach = SPAN - GRAM
    for batch in batches:
        columns = (batch[c] for c in (*_KEY, "text", "hits__"))
        for doc, ta, tb, text, hits in zip(*columns):
            raw = text.encode()
            q, pos = np.asarray(hits["q"], np.int64), np.asarray(hits["pos"], np.int64)
            left = np.minimum(pos, reach)
            yield pd.DataFrame(
                {
                    "q": q,
                    "doc": doc,
                    "ta": ta,
                    "tb": tb,
                    "pos": pos,
                    "left": left.astype(np.int32),
                    "around": [raw[p - x : p + SPAN] for p, x in zip(pos.tolist(), left.tolist())],
                }
            )


def string_identifiers(left: np.ndarray, around: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of all strings through the anchors, by row and offset; and which there are."""
    reach, width = SPAN - GRAM, 2 * SPAN - GRAM
    padded = b"".join(bytes(reach - x) + a + bytes(width - reach + x - len(a)) for x, a in zip(left.tolist(), around))
    table = np.frombuffer(padded, np.uint8).reshape(len(around), width)
    ids = identifiers(table.astype(np.uint64) + _U(1), 1, 64)
    rest = SPAN - 64
    strings = ids[:, : reach + 1] * _FACTORS[6] + ids[:, rest : rest + reach + 1]
    begin = np.arange(reach + 1)
    ends = reach - left + np.array([len(a) for a in around])
    there = (begin >= (reach - left)[:, None]) & (begin + SPAN <= ends[:, None])
    return mixed(strings), there


def _refined(q: np.ndarray, pos: np.ndarray, left: np.ndarray, around: list[bytes]):
    """Rows that hold a string which an earlier row of their bucket has, and its extent."""
    strings, there = string_identifiers(left, around)
    offset = np.arange(strings.shape[1], dtype=np.uint64) * _FACTORS[1]
    key = mixed(strings + offset + (q.view(np.uint64) * _FACTORS[2])[:, None])[there]
    _, where, which = np.unique(key, return_index=True, return_inverse=True)
    repeated = np.zeros(there.shape, bool)
    repeated[there] = where[which] != np.arange(len(key))
    row = np.flatnonzero(repeated.any(axis=1))
    begin = repeated[row].argmax(axis=1)
    end = repeated.shape[1] - 1 - repeated[row][:, ::-1].argmax(axis=1)
    origin = pos[row] - (SPAN - GRAM)
    return row, origin + begin, origin + end + SPAN


def _refined_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Covered stretches from rows sorted by bucket, document and position.

    A place comes once for each row alike in id and text; it counts once.
    """

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        q, pos, left = (rows[c].to_numpy() for c in ("q", "pos", "left"))
        k, start, stop = _refined(q, pos.astype(np.int64), left, list(rows["around"]))
        out = rows[["doc", "ta", "tb"]].iloc[k].copy()
        out["start"], out["stop"] = start, stop
        return out

    held: list[pd.DataFrame] = []
    before = None  # the place of the last row
    for batch in batches:
        places = batch[["q", "doc", "ta", "tb", "pos"]].to_numpy()
        new = np.ones(len(places), bool)
        new[1:] = (places[1:] != places[:-1]).any(axis=1)
        if len(places):
            new[0] = before is None or (places[0] != before).any()
            before = places[-1]
        batch = batch[new]
        for k in range(0, len(batch), ROWS):
            part = batch.iloc[k : k + ROWS]
            q = part["q"].to_numpy()
            if held and held[-1]["q"].iloc[-1] == q[0] and q[-1] == q[0]:
                held.append(part)
                continue
            cut = len(q) - int((q[::-1] != q[-1]).argmax()) if q[0] != q[-1] else 0
            held.append(part.iloc[:cut])
            whole = pd.concat(held)
            if len(whole):
                yield work(whole)
            held = [part.iloc[cut:]]
    if held and len(whole := pd.concat(held)):
        yield work(whole)


def _string_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For crowded buckets: a row for each string through an anchor."""
    for batch in batches:
        for k in range(0, len(batch), ROWS):
            part = batch.iloc[k : k + ROWS]
            strings, there = string_identifiers(part["left"].to_numpy(), list(part["around"]))
            row, offset = np.nonzero(there)
            start = part["pos"].to_numpy()[row] - (SPAN - GRAM) + offset
            out = part[["q", "doc", "ta", "tb"]].iloc[row].copy()
            out["string"] = strings[there].view(np.int64)
            out["start"], out["offset"] = start, offset.astype(np.int32)
            yield out


#: The key of a document: its id, and a digest of its text among rows of equal id.
_KEY = ("doc__", "ta__", "tb__")
_NAMES = ("doc", "ta", "tb")


def keyed(documents: DataFrame) -> DataFrame:
    """Each of ``documents`` as a ``row``, with a text that is never null and the key.

    Packed up, its other columns cannot clash with those this module works with. The
    digest is cut into two numbers, of 60 and 28 bits; above the first one's is
    whether there is no id, which no id is equal to. The same rows, columns and
    all, go into each join with them, so that texts are shuffled once.
    """
    text = F.coalesce("text", F.lit(""))
    digest = F.md5(text.cast("binary"))
    halves = [F.conv(F.substring(digest, at, n), 16, 10).cast("long") for at, n in ((1, 15), (16, 7))]
    absent = F.col("doc_id").isNull().cast("long")
    key = (
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)),
        F.shiftleft(absent, 60).bitwiseOR(halves[0]),
        halves[1],
    )
    columns = (k.alias(name) for k, name in zip(key, _KEY))
    others = F.struct(F.lit(0).alias("_"), *(c for c in documents.columns if c != "text"))
    return documents.select(others.alias("row"), text.alias("text"), *columns)


def _renamed(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed(dict(zip(_NAMES, _KEY)))


def repeated_stretches(documents: DataFrame, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """``doc, ta, tb, start, stop`` of covered stretches, and the documents with their key."""
    source = keyed(documents)
    key = [F.col(k).alias(name) for k, name in zip(_KEY, _NAMES)]
    sorted_anchors = (
        source.select(*key, F.col("text").cast("binary").alias("text"))
        .mapInArrow(_anchor_rows, _ANCHOR)
        .repartition("route")
        .sortWithinPartitions("route", "q", "c", "doc", "ta", "at")
    )
    schema = "doc long, ta long, tb long, pos long, q long, settled boolean"
    found = staged(sorted_anchors.mapInArrow(_settled_rows, schema))
    open_ = found.where(~F.col("settled"))
    crowded = open_.groupBy("q").count().where(F.col("count") > crowd).select("q")

    def around(rows: DataFrame) -> DataFrame:
        """The text is shuffled by key once for both uses and for the last join."""
        lists = F.struct(F.collect_list("q").alias("q"), F.collect_list("pos").alias("pos"))
        hits = _renamed(rows.groupBy(*_NAMES).agg(lists.alias("hits__")))
        return source.join(hits, list(_KEY)).mapInPandas(_surroundings, _AROUND)

    stretch = "doc long, ta long, tb long, start long, stop long"
    refined = (
        around(open_.join(crowded, "q", "left_anti"))
        .repartition("q")
        .sortWithinPartitions("q", *_NAMES, "pos")
        .mapInPandas(_refined_rows, stretch)
    )
    strings = around(open_.join(crowded, "q", "left_semi")).mapInPandas(
        _string_rows, "q long, doc long, ta long, tb long, string long, start long, offset int"
    )
    by = ["q", "string", "offset"]
    place = F.struct(*_NAMES, "start")
    earliest = strings.groupBy(*by).agg(F.min(place).alias("earliest"))
    crowds = (
        strings.join(earliest, by)
        .where(F.col("earliest") != place)
        .select(*_NAMES, "start", (F.col("start") + SPAN).alias("stop"))
    )
    first = F.greatest(F.col("pos") - (SPAN - GRAM), F.lit(0))
    settled = found.where("settled").select(
        *_NAMES, first.alias("start"), (F.col("pos") + SPAN).alias("stop")
    )
    return settled.unionByName(refined).unionByName(crowds), source


def _merged(packed: np.ndarray | None, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the union of stretches, which may touch."""
    if packed is None or not len(packed):
        none = np.zeros(0, np.int64)
        return none, none
    packed = np.sort(np.asarray(packed, np.int64))
    start, stop = packed >> 32, np.minimum(packed & 0xFFFFFFFF, size)
    stop = np.maximum.accumulate(stop)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > stop[:-1]
    return start[new], stop[np.append(np.flatnonzero(new)[1:] - 1, len(stop) - 1)]


def _cut(raw: bytes, packed: np.ndarray | None) -> tuple[bytes, np.ndarray, np.ndarray]:
    """What remains of a text, and starts and stops of what went."""
    start, stop = _merged(packed, len(raw))
    edges = [0, *np.stack((start, stop), 1).ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])), start, stop


def remaining(text: Column, packed: Column) -> Column:
    """``kept`` bytes, and ``spans`` (start << 32 | stop) that were removed."""

    @F.pandas_udf("kept binary, spans array<long>")
    def cut(texts: pd.Series, stretches: pd.Series) -> pd.DataFrame:
        found = [_cut(text.encode(), packed) for text, packed in zip(texts, stretches)]
        spans = [start << 32 | stop for _, start, stop in found]
        return pd.DataFrame({"kept": [kept for kept, _, _ in found], "spans": spans})

    return cut(text, packed)


def remaining_text(text: Column, packed: Column) -> Column:
    """What remains, as text."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, stretches: pd.Series) -> pd.Series:
        rows = zip(texts, stretches)
        return pd.Series([_cut(text.encode(), packed)[0].decode("utf-8", "ignore") for text, packed in rows])

    return cut(text, packed)


def _with_stretches(documents: DataFrame, crowd: int) -> DataFrame:
    """``row, text`` of ``keyed`` documents, and ``packed``: the stretches to remove."""
    stretches, source = repeated_stretches(documents, crowd)
    stretch = F.shiftleft("start", 32).bitwiseOR(F.col("stop"))
    packed = _renamed(stretches.groupBy(*_NAMES).agg(F.collect_list(stretch).alias("packed")))
    return source.join(packed, list(_KEY), "left")


def remove_repeats(documents: DataFrame, crowd: int = CROWD, into: str = "remains") -> DataFrame:
    """All columns of ``documents`` and a struct ``into``: ``kept`` and ``spans``, which replaces
    a column of that name."""
    own = documents.drop(into)
    columns = (F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in own.columns)
    remains = remaining(F.col("text"), F.col("packed")).alias(into)
    return _with_stretches(own, crowd).select(*columns, remains)


def without_repeats(documents: DataFrame) -> DataFrame:
    """``documents`` with what remains of each text; ``n_chars``, if there is one, counts it anew.

    A character that was cut through goes altogether.
    """
    text = remaining_text(F.col("text"), F.col("packed"))
    cut = _with_stretches(documents, CROWD).select("row", text.alias("text"))
    changed = {"text": F.col("text")}
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        changed["n_chars"] = F.char_length("text").cast(kind)
    return cut.select(*(changed.get(c, F.col("row")[c]).alias(c) for c in documents.columns))
