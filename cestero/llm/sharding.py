"""Shards by a hierarchical weighted hash tree: region, then rack, then shard.

A row descends from the root. At each node every child draws a number from a
hash of the row's key and the child, ``-ln(u) / weight``, and the least draw
wins, so that a child gets its share of the keys by weight. A draw depends on
nothing but the key, the child and its weight. If weights change, rows
therefore move only within the smallest subtree that holds every node of
another weight, and there only into nodes that gained and out of nodes that
lost. A rack whose shards trade weight among themselves moves rows within itself;
no other rack sees any of it.

The law of this placement is ``key``: the key and the number of shards decide.
Shards beyond the planned ones are a region each (``layout``), so that one more
shard takes rows into itself and moves no other row.

A row's slot is its place in its shard by id, checksum, size and place in the input.
Rows are ordered by a range partitioning in which rows alike are told apart by
that place, so that neither a hot id nor copies end in one task. Only a row
per task and shard has to be added up for that.

A null id is a key of its own, the empty text. A null text is empty. Rows alike
in everything get the same shard and a slot each. An empty table has no slots.
Other columns are not read, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cestero.llm.text import staged

SHARDS = 24
#: Racks in a region and shards in a rack, as planned.
RACKS, RACK = 2, 4
#: Bytes a row takes beside its text.
OVERHEAD = 8
LAW = "key"
LEVELS = ("region", "rack", "shard")

#: Bits of a row's place within its task's output.
_PLACE = 33


@dataclass(frozen=True)
class Tree:
    """Racks of shards by region: names and weights of the three levels.

    The weight of a region or rack is the sum of what it holds. A shard may
    appear once.
    """

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    def children(self) -> list[list[tuple[int, str, float]]]:
        """For every node its children: number, name and weight. The root is number 0;
        shards come last and have none."""
        nodes: list[list[tuple[int, str, float]]] = [[]]

        def add(parent: int, name: str, weight: float) -> int:
            nodes.append([])
            nodes[parent].append((len(nodes) - 1, name, float(weight)))
            return len(nodes) - 1

        for r, racks in enumerate(self.regions):
            region = add(0, f"{r}", sum(w for rack in racks for _, w in rack))
            for k, rack in enumerate(racks):
                node = add(region, f"{r}.{k}", sum(w for _, w in rack))
                for shard, weight in rack:
                    add(node, f"shard {shard}", weight)
        return nodes

    def shards(self) -> list[int]:
        return [s for racks in self.regions for rack in racks for s, _ in rack]


def layout(
    shards: int, planned: int = SHARDS, weights: Sequence[float] | None = None
) -> Tree:
    """The tree of so many shards: the planned ones in full regions, later ones a region each."""
    if shards < 1:
        raise ValueError("there has to be a shard")
    weights = weights or [1.0] * shards
    if len(weights) != shards or min(weights) <= 0:
        raise ValueError("each shard needs a weight above 0")
    leaves = [(s, float(w)) for s, w in enumerate(weights)]

    def cut(rows: list, size: int) -> list[list]:
        return [rows[k : k + size] for k in range(0, len(rows), size)]

    regions = cut(cut(leaves[:planned], RACK), RACKS) + [[[leaf]] for leaf in leaves[planned:]]
    return Tree(tuple(tuple(tuple(rack) for rack in racks) for racks in regions))


def grown(tree: Tree) -> Tree:
    """``tree`` with one more shard, in a region of its own."""
    return Tree((*tree.regions, (((max(tree.shards()) + 1, 1.0),),)))


def draw(key: Column, name: Column, weight: Column) -> Column:
    """A child's draw: exponential, of a rate that is its weight.

    52 bits of the MD5 of key and name, kept off 0 and 1 by half a step.
    """
    digest = F.md5(F.concat(key, F.lit("/"), name).cast("binary"))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / weight


def descend(key: Column, tree: Tree) -> Column:
    """The number of a row's shard; ``key`` is a text without nulls.

    Three steps of one row of draws each: the children of the node reached are
    looked up in a table of the whole tree, which is as long as its shards.
    """
    nodes = tree.children()
    kind = "array<struct<node: int, name: string, weight: double>>"

    def listed(children: list[tuple[int, str, float]]) -> Column:
        names = ("node", "name", "weight")
        rows = (F.struct(*(F.lit(v).alias(n) for n, v in zip(names, c))) for c in children)
        return F.array(*rows).cast(kind)

    literal = F.array(*map(listed, nodes))
    at = F.lit(0)
    for _ in LEVELS:
        draws = F.transform(
            F.get(literal, at),
            lambda c: F.struct(draw(key, c["name"], c["weight"]).alias("draw"), c["node"].alias("node")),
        )
        at = F.array_min(draws)["node"]
    numbers = [-1] * len(nodes)
    for children in nodes:
        for node, name, _ in children:
            if name.startswith("shard "):
                numbers[node] = int(name.removeprefix("shard "))
    return F.get(F.array(*map(F.lit, numbers)), at)


def placed(documents: DataFrame, shards: int = SHARDS, tree: Tree | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, shard, grown_shard`` of every row.

    ``grown_shard`` is the shard if there were one more.
    """
    tree = tree or layout(shards)
    text = F.coalesce("text", F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return documents.select(
        "doc_id",
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        descend(key, tree).alias("shard"),
        descend(key, grown(tree)).alias("grown_shard"),
    )


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` in the order of slots, with their ``place``: the task, and the place within it."""
    order = ("shard", "doc_id", "text_crc32", "size")
    return (
        rows.withColumn("input", F.monotonically_increasing_id())
        .repartitionByRange(*order, "input")
        .sortWithinPartitions(*order, "input")
        .drop("input")
        .withColumn("place", F.monotonically_increasing_id())
    )


def with_slots(rows: DataFrame) -> DataFrame:
    """``rows`` with a ``slot``, counted from 0 in each shard without a gap.

    ``rows`` are written once in order. A task's rows of one shard are neighbours
    there, so their slots are their places less that of the first of them, plus
    how many rows of the shard earlier tasks have. Of that there is a row per
    task, and one more per shard at most.
    """
    table = staged(in_order(rows))
    task = F.shiftright("place", _PLACE).alias("task")
    runs = table.groupBy("shard", task).agg(
        F.min("place").alias("first"), F.count("*").alias("n")
    )
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "shard", "task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    )
    # As many rows as tasks and shards, which bounds what is broadcast.
    joined = table.withColumn("task", task).join(F.broadcast(starts), ["shard", "task"])
    return joined.select(*rows.columns, (F.col("place") + F.col("shift")).alias("slot"))


def sharded(documents: DataFrame, shards: int = SHARDS, tree: Tree | None = None) -> DataFrame:
    """Place and slot of every row under the law ``key``."""
    return with_slots(placed(documents, shards, tree)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
