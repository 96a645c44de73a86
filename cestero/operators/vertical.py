"""Frequent itemsets by intersecting bitmaps, without item names on the driver.

Baskets are numbered, and every frequent item gets bitmaps: one bit per basket, in
segments of as many baskets as a bitmap has bits. An itemset's frequency is the
number of bits in the intersection of its items' bitmaps.

1. Segments are dealt to shares of about equal size, and the items of a share to
   prefix classes, so that there are enough tasks for few shares. A task takes
   the classes of one share and walks depth-first from each item through the items
   after it (rarer ones come first), intersecting as it goes. It reports what is as
   frequent in its share as it would have to be on average. An itemset that is
   frequent overall is reported by one share at least.
2. What not all shares reported, and could still be frequent, is counted in the
   shares that did not, by intersecting their bitmaps again.

Both steps are exact, for all baskets or for those of each store by itself. The
driver gets the number of baskets. A task holds one share's bitmaps, bounded by ``SHARE_BYTES``, or one
segment's if that takes more: 4 KB per frequent item, of which there are at most
mean basket size / minimum support. Neither the size of a group of equal baskets
nor the frequency of one item changes that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cestero.operators.mining import MIN_CONFIDENCE, MIN_SUPPORT, MinedItemsets
from cestero.operators.numbering import numbered
from cestero.sinks.shared import stage_table

# Fixed value: bits in a bitmap of Spark's bitmap functions.
SEGMENT = 1 << 15

#: Bytes of the bitmaps of a share, if one segment does not take more.
SHARE_BYTES = 1 << 25

#: Itemsets in an output batch.
_BATCH = 1 << 14


def _div(a: Column, b: Column) -> Column:
    """Whole quotient, rounded up, of numbers whose product may exceed 64 bits."""
    exact = a.cast("decimal(38,0)")
    return F.ceil(exact / b.cast("decimal(19,0)")).cast("bigint")


def dealt(groups: DataFrame, share_bytes: int, tasks: int) -> DataFrame:
    """``groups`` (``n, least, n_items``) with how their segments are dealt: ``segments``,
    ``shares``, ``classes``, and ``most``, the greatest threshold of a share."""
    together = F.greatest(
        F.lit(1), F.floor(F.lit(share_bytes) / F.greatest(F.lit(1), F.col("n_items") * (SEGMENT // 8)))
    )
    total = groups.agg(F.sum("n")).scalar()
    own_tasks = F.ceil(F.lit(tasks) * F.col("n") / total)
    return (
        groups.withColumn("segments", F.ceil(F.col("n") / SEGMENT).cast("bigint"))
        .withColumn("shares", F.ceil(F.col("segments") / together).cast("bigint"))
        .withColumn("classes", F.ceil(own_tasks / F.col("shares")).cast("int"))
        .withColumn("largest", F.ceil(F.col("segments") / F.col("shares")) * SEGMENT)
        .withColumn(
            "most", _div(F.col("least") * F.least("n", F.col("largest").cast("bigint")), F.col("n"))
        )
        .drop("largest")
    )


def of_shares(segments: DataFrame) -> DataFrame:
    """A group's segments (with the columns of ``dealt``) with their ``share``, its ``first``
    segment and the ``end``, and ``local``: the least count in the share of which all
    shares together make a frequent itemset."""
    start = "CAST(ceil(CAST({} * segments AS DECIMAL(38,0)) / shares) AS BIGINT)"
    size = F.least(F.col("n"), F.col("end") * SEGMENT) - F.col("first") * SEGMENT
    return (
        segments.withColumn("share", F.expr("CAST(segment * shares div segments AS INT)"))
        .withColumn("first", F.expr(start.format("share")))
        .withColumn("end", F.expr(start.format("(share + 1)")))
        .withColumn("local", F.greatest(F.lit(1), _div(F.col("least") * size, F.col("n"))))
    )


def bitmaps(placed: DataFrame, items: DataFrame) -> DataFrame:
    """``grp, segment, no, bits``: the baskets of a segment that have an item."""
    lines = placed.select("grp", "number", F.explode("items").alias("item"))
    return (
        lines.join(items.select("grp", "item", "no"), ["grp", "item"])
        .groupBy("grp", F.expr(f"number div {SEGMENT}").alias("segment"), "no")
        .agg(F.bitmap_construct_agg((F.col("number") % SEGMENT).cast("int")).alias("bits"))
    )


_KEY = ("gno", "share", "class")


def _by_class(vertical: DataFrame, groups: DataFrame) -> DataFrame:
    """Bitmaps by group, share and prefix class; a class needs its own items and all after them."""
    wanted = F.sequence(F.lit(0), F.least(F.col("classes") - 1, F.col("no")))
    return of_shares(vertical.join(groups, "grp")).select(
        "gno", "share", F.explode(wanted).alias("class"), "classes", "first", "end", "local", "no", "segment", "bits"
    )


def _share_table(rows: list[tuple[int, int, bytes]], first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of a share's items in order, and a row of 64-bit words for each."""
    words = SEGMENT // 64
    found = np.array(sorted({no for no, _, _ in rows}), np.int64)
    table = np.zeros((len(found), (end - first) * words), np.uint64)
    place = {no: k for k, no in enumerate(found.tolist())}
    for no, segment, bits in rows:
        at = (segment - first) * words
        table[place[no], at : at + words] = np.frombuffer(bits, np.uint64)
    return found, table


def extensions(
    prefix: tuple[int, ...], own: np.ndarray, numbers: np.ndarray, table: np.ndarray, least: int
) -> Iterator[tuple[tuple[int, ...], int]]:
    """Frequent itemsets that begin with ``prefix``, depth-first; the prefix itself is not given.

    ``table`` has the bitmaps of the items that may follow, ``own`` that of the
    prefix. Words without any basket of the prefix are left out on the way down.
    """
    used = np.flatnonzero(own)
    if 2 * len(used) < len(own):
        own, table = own[used], table[:, used]
    both = table & own
    counts = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
    kept = np.flatnonzero(counts >= least)
    numbers, both, counts = numbers[kept], both[kept], counts[kept]
    for k, (no, count) in enumerate(zip(numbers.tolist(), counts.tolist())):
        yield (*prefix, no), count
        if k + 1 < len(numbers):
            yield from extensions((*prefix, no), both[k], numbers[k + 1 :], both[k + 1 :], least)


@dataclass
class _Share:
    """What a task has of one share for one prefix class."""

    key: tuple[int, int, int]
    classes: int
    first: int
    end: int
    local: int
    bitmaps: list[tuple[int, int, bytes]]

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        return _share_table(self.bitmaps, self.first, self.end)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Share, Iterator[list]]]:
    """Each share and class, and the itemsets that are asked for there, from sorted rows."""
    rows = (row for batch in batches for row in _tuples(batch))
    row = next(rows, None)
    while row is not None:
        share = _Share(row[:3], *(v or 0 for v in row[3:7]), [])
        while row is not None and row[:3] == share.key and row[9] is not None:
            share.bitmaps.append(row[7:10])
            row = next(rows, None)

        def asked() -> Iterator[list]:
            nonlocal row
            while row is not None and row[:3] == share.key:
                yield row[10]
                row = next(rows, None)

        yield share, asked()
        while row is not None and row[:3] == share.key:
            row = next(rows, None)


def _tuples(batch: pa.RecordBatch) -> Iterator[tuple]:
    for k in range(0, batch.num_rows, 64):
        yield from zip(*(column.to_pylist() for column in batch.slice(k, 64).columns))


_FOUND = "gno int, share int, items array<int>, n long"


def _reported(found: Iterator[tuple[int, int, tuple[int, ...], int]]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.int64())
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, kind) for c, kind in zip(zip(*held), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["gno", "share", "items", "n"])

    for row in found:
        held.append(row)
        if len(held) == _BATCH:
            yield batch()
            held = []
    if held:
        yield batch()


def _sorted(rows: DataFrame) -> DataFrame:
    """Bitmaps of a share and class first, then itemsets to count, if any."""
    wide = rows if "items" in rows.columns else rows.withColumn("items", F.lit(None).cast("array<int>"))
    return wide.repartition(*_KEY).sortWithinPartitions(
        *_KEY, F.col("bits").isNull(), "no", "segment", "items"
    )


def local_itemsets(by_class: DataFrame) -> DataFrame:
    """``gno, share, items, n``: itemsets of two items or more that a share reports."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int, tuple[int, ...], int]]:
            for share, _ in _read(batches):
                group, number, own = share.key
                numbers, table = share.table()
                for k in np.flatnonzero(numbers % share.classes == own).tolist():
                    prefix, rest = (int(numbers[k]),), slice(k + 1, None)
                    for items, n in extensions(prefix, table[k], numbers[rest], table[rest], share.local):
                        yield group, number, items, n

        return _reported(found())

    return _sorted(by_class).mapInArrow(search, _FOUND)


def counted(by_class: DataFrame, asked: DataFrame) -> DataFrame:
    """``gno, share, items, n`` of the itemsets ``asked`` for (``gno, share, classes, items``)."""
    own = F.pmod(F.col("items")[0], F.col("classes"))
    questions = asked.select("gno", "share", own.alias("class"), "items")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, int, tuple[int, ...], int]]:
            for share, itemsets in _read(batches):
                group, number, _ = share.key
                numbers, table = share.table()
                place = {no: k for k, no in enumerate(numbers.tolist())}
                for items in itemsets:
                    rows = [place.get(no) for no in items]
                    n = 0
                    if None not in rows:
                        n = int(np.bitwise_count(np.bitwise_and.reduce(table[rows])).sum(dtype=np.int64))
                    yield group, number, tuple(items), n

        return _reported(found())

    rows = by_class.unionByName(questions, allowMissingColumns=True)
    return _sorted(rows).mapInArrow(search, _FOUND)


def mine_itemsets_by(
    baskets: DataFrame,
    by: Sequence[str] = (),
    min_support: float = MIN_SUPPORT,
    num_partitions: int | None = None,
    stage: Callable[[DataFrame], DataFrame] = stage_table,
    share_bytes: int = SHARE_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Frequent itemsets of each store, say: ``*by, items, freq, n_baskets``, stored; and
    ``*by, n_baskets`` of all of them.

    An itemset is frequent where ``min_support`` of that store's own baskets have
    it. Stores are numbered, one row each, and share the tasks by their baskets: a
    small one is a task, a large one as many as it has shares.
    """
    tasks = num_partitions or int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = baskets.where(F.col("items").isNotNull()).select(
        F.struct(*(by or [F.lit(0).alias("all")])).alias("grp"),
        F.array_distinct(F.array_compact("items")).alias("items"),
    )
    placed = numbered(slim, by="grp", stage=stage)
    item = F.explode(F.array_append("items", F.lit(None).cast("string"))).alias("item")
    counts = stage(placed.select("grp", item).groupBy("grp", "item").agg(F.count("*").alias("freq")))
    least = F.greatest(F.lit(1), F.ceil(F.lit(float(min_support)) * F.col("n")))
    totals = counts.where("item IS NULL").select("grp", F.col("freq").alias("n"))
    totals = totals.withColumn("least", least)
    in_order = Window.partitionBy("grp").orderBy("freq", "item")
    items = stage(
        counts.where("item IS NOT NULL")
        .join(totals, "grp")
        .where(F.col("freq") >= F.col("least"))
        # At most mean basket size / minimum support rows of a group.
        .select("grp", "item", "freq", (F.row_number().over(in_order) - 1).alias("no"))
    )
    listed = totals.join(items.groupBy("grp").agg(F.count("*").alias("n_items")), "grp", "left")
    number = F.row_number().over(Window.orderBy("grp")) - 1
    groups = dealt(listed.na.fill(0, ["n_items"]), share_bytes, tasks).withColumn("gno", number)
    groups = stage(groups)

    by_class = _by_class(stage(bitmaps(placed, items)), groups)
    found = stage(local_itemsets(by_class))
    of = groups.select("gno", "grp", "n", "least", "shares", "classes", "most")
    sums = (
        found.groupBy("gno", "items")
        .agg(F.sum("n").alias("seen"), F.count("*").alias("reported"))
        .join(of, "gno")
    )
    # A share that does not report an itemset has fewer of it than its threshold.
    missing = F.col("shares") - F.col("reported")
    possible = sums.where((missing > 0) & (F.col("seen") + missing * (F.col("most") - 1) >= F.col("least")))
    every = F.explode(F.sequence(F.lit(0), F.col("shares").cast("int") - 1))
    asked = possible.select("gno", "classes", "items", every.alias("share")).join(
        found.select("gno", "share", "items"), ["gno", "share", "items"], "left_anti"
    )
    frequent = (
        found.unionByName(counted(by_class, asked))
        .groupBy("gno", "items")
        .agg(F.sum("n").alias("freq"))
        .join(of, "gno")
        .where(F.col("freq") >= F.col("least"))
    )
    names = (
        frequent.select("grp", "items", "freq", F.explode("items").alias("no"))
        .join(items.select("grp", "no", "item"), ["grp", "no"])
        .groupBy("grp", "items")
        .agg(F.sort_array(F.collect_list("item")).alias("names"), F.first("freq").alias("freq"))
        .select("grp", F.col("names").alias("items"), "freq")
    )
    single = items.select("grp", F.array("item").alias("items"), "freq")
    own = [F.col("grp")[c].alias(c) for c in by]
    sizes = groups.select("grp", F.col("n").alias("n_baskets"))
    itemsets = single.unionByName(names).join(sizes, "grp")
    return stage(itemsets.select(*own, "items", "freq", "n_baskets")), sizes.select(*own, "n_baskets")


def mine_itemsets(
    baskets: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    num_partitions: int | None = None,
    stage: Callable[[DataFrame], DataFrame] = stage_table,
    share_bytes: int = SHARE_BYTES,
) -> MinedItemsets:
    """The itemsets in at least ``min_support`` of ``baskets`` (column ``items``).

    The result is that of the search by FP-growth; there is no model. Repeats and
    NULLs in a basket count for nothing, and an empty basket is one without items.
    This runs jobs; ``stage`` writes what several steps read. ``min_confidence``
    takes no part, rules being joined from itemsets.
    """
    itemsets, sizes = mine_itemsets_by(baskets, (), min_support, num_partitions, stage, share_bytes)
    n = sizes.agg(F.coalesce(F.sum("n_baskets"), F.lit(0))).first()[0]
    return MinedItemsets(itemsets.select("items", "freq"), n, None)
