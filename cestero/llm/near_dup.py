"""Near-duplicates by consistent weighted sampling over TF-IDF word shingles.

A text is the multiset of its shingles of ``WORDS`` words (lower case, without
marks at their edges; a text of fewer words is one shingle). A shingle weighs
its count times an inverse document frequency between 1 and 1.5, so that
passages found everywhere count less. Document frequencies cover all documents;
they are kept for ``2 ** SLOTS`` hash slots, which bounds what is broadcast.

1. Improved consistent weighted sampling (Ioffe, 2010) draws ``BANDS * ROWS``
   samples, of which two texts share each with a probability equal to their
   weighted Jaccard similarity.
2. Texts that agree in a band meet in a bucket. A bucket links each of its texts
   to a hub, the smallest by one of ``ORDERS`` orders, never all pairs.
3. Links are verified by the exact weighted Jaccard similarity, ``SIMILAR`` or more.
4. Texts of a bucket that are not connected to its hub after that are compared
   with all texts of the bucket that are in another component, by the exact
   similarity again. So no link between components is lost to the choice of hubs.
   Buckets of more than ``CROWD`` texts give no pairs: those that overlap form a
   crowd, whose texts outside its largest component are compared in blocks with
   all of the crowd, inside of tasks, and only links that join two components come
   out.

Equal texts are one node from the start, whatever their number. Null, empty or
blank texts resemble nothing: each row is a class of its own. Null ids are kept;
a class is named by the smallest id it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cestero.llm.components import components
from cestero.llm.text import Memo, mixed, of_worker, staged, word_hash, word_hashes

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS, ORDERS = 12, 4, 3
SLOTS = 20
#: Texts of a bucket from which on it belongs to a crowd, and the sides of a
#: crowd's blocks: texts outside the largest component, and all texts.
CROWD, OUTSIDE, INSIDE = 64, 512, 2048
#: Shingles that are sampled together; a text of more is sampled by itself.
CHUNK = 1 << 16
#: Words in one generation of a worker's memory.
MEMORY = 3 << 17

_BLOCK = 1 << 14
_U = np.uint64
_A, _B = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9)


def _hashes() -> Memo:
    return of_worker("near duplicates", "word hashes", lambda: Memo(word_hash, MEMORY))


def shingles(text: str, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 64-bit identifiers of a text's shingles, and how often each occurs."""
    words = word_hashes(text, memo)
    if not len(words):
        return words, np.zeros(0, np.int64)
    width = min(WORDS, len(words))
    ids = words[: len(words) - width + 1].copy()
    for k in range(1, width):
        ids *= _A
        ids += words[k : len(words) - width + 1 + k]
    return np.unique(mixed(ids + _U(width)), return_counts=True)


def slot(ids: np.ndarray) -> np.ndarray:
    return (ids >> _U(64 - SLOTS)).astype(np.int64)


def document_frequencies(documents: DataFrame) -> tuple[np.ndarray, int]:
    """By slot, over all documents; and the number of documents.

    Tasks send their counts in blocks, which are added up as they stream in.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = _hashes()
        counts, rows = np.zeros(1 << SLOTS, np.int32), 0
        for batch in batches:
            for text in batch["text"]:
                np.add.at(counts, slot(shingles(text, memo)[0]), 1)
            rows += len(batch)
        if rows:
            blocks = counts.reshape(-1, _BLOCK)
            yield pd.DataFrame(
                {"block": range(len(blocks)), "counts": [b.tobytes() for b in blocks], "n": rows}
            )

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        rows = 0
        for batch in batches:
            for block, counts, n in zip(batch["block"], batch["counts"], batch["n"]):
                sums[block] = sums.get(block, 0) + np.frombuffer(counts, np.int32).astype(np.int64)
                rows += n if block == 0 else 0
        for block, counts in sums.items():
            yield pd.DataFrame({"block": [block], "counts": [counts.tobytes()], "n": [rows]})

    schema = "block int, counts binary, n long"
    parts = documents.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(counted, schema)
    out, rows = np.zeros((1 << SLOTS) // _BLOCK * _BLOCK, np.int64), 0
    for row in parts.repartition("block").mapInPandas(added, schema).collect():
        out[row.block * _BLOCK : (row.block + 1) * _BLOCK] = np.frombuffer(row.counts, np.int64)
        rows += row.n if row.block == 0 else 0
    return out, rows


def inverse_frequencies(frequencies: np.ndarray, rows: int) -> np.ndarray:
    """1 for a shingle that all documents have, up to 1.5 for one that no other has."""
    share = np.log((rows + 1) / (np.minimum(frequencies, rows) + 1)) / np.log(rows + 2)
    return (1 + share / 2).astype(np.float32)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """4096 quantiles each of a Gamma(2, 1), of the logarithm of one, and of a uniform variable."""
    level = (np.arange(4096) + 0.5) / 4096
    x = np.full(4096, 2.0)
    for _ in range(60):  # Newton on 1 - (1 + x) exp(-x) = level
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - level) / (x * np.exp(-x)), x / 4)
    return x.astype(np.float32), np.log(x).astype(np.float32), level.astype(np.float32)


def samples(ids: np.ndarray, log_weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Consistent weighted samples, a row of 32-bit fingerprints for each stretch from ``starts``."""
    gamma, log_gamma, uniform = _tables()
    seeds = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _A) | _U(1)
    low, out = _U(4095), np.empty((len(starts), BANDS * ROWS), np.uint32)
    one, middle, scale = np.float32(1), np.float32(64), np.float32(1 << 25)
    for k, seed in enumerate(seeds):
        x = ids * seed
        x ^= x >> _U(31)
        x *= _B
        r = gamma.take((x >> _U(52)).view(np.int64))
        beta = uniform.take((x >> _U(40) & low).view(np.int64))
        t = np.floor(log_weight / r + beta)
        # ln c - r (t + 1 - beta), between -64 and 64 for any count below e ** 40, as a
        # fixed-point number above 32 bits that tell shingle and level apart.
        np.subtract(t, beta, out=beta)
        beta += one
        beta *= r
        place = log_gamma.take((x >> _U(28) & low).view(np.int64))
        place -= beta
        place += middle
        place *= scale
        key = place.astype(np.uint64)
        key <<= _U(32)
        x += t.astype(np.int64).view(np.uint64) * _A
        x ^= x >> _U(29)
        x *= _B
        key |= x >> _U(32)
        out[:, k] = np.minimum.reduceat(key, starts).astype(np.uint32)
    return out


def node(text: Column) -> Column:
    """Names a text by 128 bits."""
    return F.unhex(F.md5(text.cast("binary")))


def _texts(documents: DataFrame) -> DataFrame:
    """``node, text`` of all rows whose text has a word."""
    return documents.where(F.col("text").rlike(r"(?U)\S")).select(node(F.col("text")).alias("node"), "text")


def signatures(texts: DataFrame, weights) -> DataFrame:
    """``node, samples`` for each text that has a shingle."""

    def drawn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, idf = _hashes(), weights.value
        for batch in batches:
            nodes, found, size = [], [], 0
            for k, (name, text) in enumerate(zip(batch["node"], batch["text"]), 1):
                ids, counts = shingles(text, memo)
                if len(ids):
                    nodes.append(name)
                    found.append((ids, counts))
                    size += len(ids)
                if nodes and (size >= CHUNK or k == len(batch)):
                    ids = np.concatenate([i for i, _ in found])
                    counts = np.concatenate([c for _, c in found])
                    starts = np.cumsum([0] + [len(i) for i, _ in found[:-1]])
                    weight = np.log(counts * idf[slot(ids)]).astype(np.float32)
                    rows = samples(ids, weight, starts)
                    yield pd.DataFrame({"node": nodes, "samples": [r.tobytes() for r in rows]})
                    nodes, found, size = [], [], 0

    return texts.mapInPandas(drawn, "node binary, samples binary")


def _bands(signed: DataFrame) -> DataFrame:
    """``band, key, node``: one row for each band of a text."""
    width = 4 * ROWS
    each = F.posexplode(
        F.array(*(F.xxhash64(F.substring("samples", 1 + width * b, width)) for b in range(BANDS)))
    ).alias("band", "key")
    return signed.select("node", each)


def _verified(pairs: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """``u, v, similar`` of pairs ``u, v`` of nodes."""

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, idf = _hashes(), weights.value
        kept: dict[bytes, tuple] = {}

        def weighed(name: bytes, text: str) -> tuple:
            got = kept.get(name)
            if got is None:
                ids, counts = shingles(text, memo)
                got = ids, counts * idf[slot(ids)].astype(float)
                if len(kept) >= 16:
                    kept.clear()
                if len(ids) < CHUNK:
                    kept[name] = got
            return got

        for batch in batches:
            similar = []
            for u, v, a, b in zip(batch["u"], batch["v"], batch["text_u"], batch["text_v"]):
                (x, wx), (y, wy) = weighed(u, a), weighed(v, b)
                _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                shared = np.minimum(wx[i], wy[j]).sum()
                similar.append(bool(shared >= SIMILAR * (wx.sum() + wy.sum() - shared) * (1 - 1e-9)))
            yield pd.DataFrame({"u": batch["u"], "v": batch["v"], "similar": similar})

    first = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    second = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))
    joined = pairs.join(second, "v").join(first, "u").select("u", "v", "text_u", "text_v")
    return joined.mapInPandas(compared, "u binary, v binary, similar boolean")


def _joining(outside: list[tuple], inside: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
    """Links between texts of different parts, at most one for each two parts it joins.

    A text is ``node, part, ids, weights``. Those inside are searched by an
    inverted index from shingle to texts.
    """
    if not outside or not inside:
        return
    row = np.repeat(np.arange(len(inside)), [len(t[2]) for t in inside])
    ids, weights = (np.concatenate([t[k] for t in inside]) for k in (2, 3))
    order = np.argsort(ids, kind="stable")
    ids, weights, row = ids[order], weights[order], row[order]
    totals = np.array([t[3].sum() for t in inside])
    parts = [t[1] for t in inside]
    root: dict[bytes, bytes] = {}

    def top(part: bytes) -> bytes:
        while (above := root.get(part, part)) != part:
            part = above
        return part

    for name, part, own, weight in outside:
        first, last = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        sizes = last - first
        at = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        shared = np.bincount(
            row[at], np.minimum(weights[at], np.repeat(weight, sizes)), minlength=len(inside)
        )
        similar = shared >= SIMILAR * (totals + weight.sum() - shared) * (1 - 1e-9)
        for k in np.flatnonzero(similar):
            a, b = top(part), top(parts[k])
            if a != b:
                root[max(a, b)] = min(a, b)
                yield name, inside[k][0]


def _crowded_links(met: DataFrame, parts: DataFrame, wanted: DataFrame, weights) -> DataFrame:
    """``u, v``: links that join components within crowds."""
    crowds = components(met.where(F.col("size") > CROWD).select(F.col("node").alias("u"), F.col("hub").alias("v")))
    members = staged(
        crowds.withColumnRenamed("component", "crowd")
        .join(parts, "node", "left")
        .select("crowd", "node", F.coalesce("component", "node").alias("part"))
    )
    sizes = members.groupBy("crowd", "part").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("crowd").agg(
        F.max(F.struct("n", "part"))["part"].alias("largest"), F.sum("n").alias("all")
    )
    largest = largest.join(
        sizes.join(largest, "crowd")
        .where("part <> largest")
        .groupBy("crowd")
        .agg(F.sum("n").alias("few")),
        "crowd",
    )
    placed = members.join(largest, "crowd").withColumns(
        {
            "columns": F.ceil(F.col("few") / OUTSIDE),
            "rows": F.ceil(F.col("all") / INSIDE),
            "h": F.xxhash64("node"),
        }
    )
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    outside = placed.where("part <> largest").select(
        "crowd", F.pmod("h", "columns").alias("column"), each("rows").alias("row"), "node", "part", F.lit(True).alias("outside")
    )
    inside = placed.select(
        "crowd", each("columns").alias("column"), F.pmod("h", "rows").alias("row"), "node", "part", F.lit(False).alias("outside")
    )
    cells = outside.unionByName(inside).join(wanted, "node")

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, idf = _hashes(), weights.value
        cell, sides = None, ([], [])

        def links() -> pd.DataFrame:
            return pd.DataFrame(list(_joining(sides[1], sides[0])), columns=["u", "v"])

        for batch in batches:
            for r in batch.itertuples(index=False):
                if (r.crowd, r.column, r.row) != cell:
                    yield links()
                    cell, sides = (r.crowd, r.column, r.row), ([], [])
                ids, counts = shingles(r.text, memo)
                sides[r.outside].append((r.node, r.part, ids, counts * idf[slot(ids)].astype(float)))
        yield links()

    key = ["crowd", "column", "row"]
    return cells.repartition(*key).sortWithinPartitions(*key).mapInPandas(compared, "u binary, v binary")


def links(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Verified links ``u, v`` between different texts, and ``node, component`` of linked ones."""
    spark = documents.sparkSession
    frequencies, rows = document_frequencies(documents)
    weights = spark.sparkContext.broadcast(inverse_frequencies(frequencies, rows))
    texts = _texts(documents)
    signed = staged(signatures(texts, weights).dropDuplicates(["node"]))
    bands = _bands(signed)
    # An order for each third of the bands: the node, seen with another hash before it.
    order = F.struct(F.xxhash64(F.pmod("band", F.lit(ORDERS)), "node").alias("h"), "node")
    hubs = (
        bands.groupBy("band", "key")
        .agg(F.min(order)["node"].alias("hub"), F.count(F.lit(1)).alias("size"))
        .where("size > 1")
    )
    met = staged(bands.join(hubs, ["band", "key"]).select("band", "key", "node", "hub", "size"))
    pairs = met.where("node <> hub").select(
        F.greatest("node", "hub").alias("u"), F.least("node", "hub").alias("v")
    )
    wanted = staged(
        texts.join(met.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    )
    checked = staged(_verified(pairs.distinct(), wanted, weights))
    linked = checked.where("similar").select("u", "v")
    parts = components(linked)

    # Texts that did not come into their hub's component, against the others they met.
    def part(name: str) -> DataFrame:
        return parts.select(F.col("node").alias(name), F.col("component").alias(f"{name}_part"))

    placed = (
        met.where(F.col("size") <= CROWD)
        .join(part("node"), "node", "left")
        .join(part("hub"), "hub", "left")
        .withColumns(
            {
                "node_part": F.coalesce("node_part", "node"),
                "hub_part": F.coalesce("hub_part", "hub"),
            }
        )
    )
    apart = placed.where("node_part <> hub_part").select(
        "band", "key", F.col("node").alias("u"), F.col("node_part").alias("u_part")
    )
    others = placed.where("node <> hub").select(
        "band", "key", F.col("node").alias("v"), F.col("node_part").alias("v_part")
    )
    open_ = (
        apart.join(others, ["band", "key"])
        .where("u_part <> v_part")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    )
    more = _verified(open_.distinct(), wanted, weights).where("similar").select("u", "v")
    more = staged(more.union(_crowded_links(met, parts, wanted, weights)))
    if more.isEmpty():
        return linked, parts
    every = linked.union(more)
    return every, components(every)


def classes(documents: DataFrame) -> DataFrame:
    """``doc_id, class_id`` of every row; ``class_id`` is the smallest id of the class."""
    _, parts = links(documents)
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id", F.when(text.rlike(r"(?U)\S"), node(text)).alias("node")
    )
    by_node = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = by_node.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("class_id"))
    by_node = named.join(least, "component").select("node", "class_id")
    return rows.join(by_node, "node", "left").select(
        "doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """``documents`` without near-duplicates: of each class the row with the smallest id.

    Ids that are null come last; of rows with equal ids one with the smallest
    hash of its text is kept.
    """
    _, parts = links(documents)
    text = F.coalesce("text", F.lit(""))
    rows = documents.withColumn("node__", node(text))
    id_ = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id__")
    by_node = (
        rows.where(text.rlike(r"(?U)\S"))
        .groupBy("node__")
        .agg(F.min(id_).alias("id__"))
        .join(parts.select(F.col("node").alias("node__"), "component"), "node__", "left")
    )
    first = by_node.groupBy(F.coalesce("component", "node__").alias("component__")).agg(
        F.min(F.struct("id__", "node__")).alias("first")
    )
    keep = first.select("first.id__", "first.node__").withColumn("keep__", F.lit(True))
    alike = Window.partitionBy("node__", "id__").orderBy("node__")
    kept = (
        rows.withColumn("id__", id_)
        .where(text.rlike(r"(?U)\S"))
        .join(keep, ["node__", "id__"])
        .withColumn("rank__", F.row_number().over(alike))
        .where("rank__ = 1")
        .select(*documents.columns)
    )
    return kept.unionByName(documents.where(~text.rlike(r"(?U)\S")))
