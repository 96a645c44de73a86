"""Exact n-tiles without sorting all rows in one task.

``ntile`` over an unpartitioned window sends every row to a single task. All it
needs, though, are the ``tiles - 1`` rows at which one tile ends. They are found
by descending through a histogram: first over the ranked value, then, inside the
few values where a tile ends, over the leading bits of the key, and then over
the bits after those. Each step counts in parallel, keeps a running total over
the small histogram and hands on one cell per tile. Every row is then compared
with the cut rows and never shuffled. Several values rank in one go.

A value with few differences, such as a day, takes one step. Any other number is
``wide``: it descends through its bits as the key does, so that no step has more
than 2**22 cells. Within ``groups``, each group has tiles and cuts of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How far a number is shifted right at each step. No step can split a cell into
# more than 2**22 smaller ones, which bounds the rows of its running total.
_SHIFTS = {"int": (16, 0), "bigint": (42, 21, 0)}

_BEFORE_ALL = -(2**63)


def _ordinal(column: Column) -> Column:
    """``column`` as a number in which NULL comes first."""
    return F.coalesce(column.cast("bigint"), F.lit(_BEFORE_ALL))


def float_ordinal(column: Column) -> Column:
    """A number in the order of a float or double, NaN last; different values have different ones.

    These are the bits of a double, where those below the sign run backwards in
    negative ones. Adding 0 makes one of the two zeros.
    """
    value = column.cast("double") + F.lit(0.0)
    bits = F.java_method(
        F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(value, F.lit(0.0))
    ).cast("bigint")
    turned = F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits)
    return F.when(column.isNotNull(), turned)


def _cells_at_ranks(cells: DataFrame, of: list[str], parts: list[str]) -> DataFrame:
    """For every tile the cell that holds its last rank, counted from the start
    of that cell. ``cells`` has the parts of a cell and its number of rows.
    """
    in_order = Window.partitionBy(*of, "tile").orderBy(parts[-1])
    running = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("upto") - F.col("n")
    return (
        cells.select("*", running.alias("upto"))
        .where((F.col("rank") > before) & (F.col("rank") <= F.col("upto")))
        .select(*of, "tile", (F.col("rank") - before).alias("rank"), *parts)
    )


def tile_cuts(
    rows: DataFrame,
    values: list[Column],
    key: str,
    tiles: int,
    groups: Sequence[str] = (),
    wide: bool = False,
) -> DataFrame:
    """One row (per group, whose struct is ``of``) with an array ``cuts``: the last
    (value, key) of every tile but the last one, for the first value, then for the
    second, and so on.
    """
    key_shifts = _SHIFTS.get(rows.schema[key].dataType.simpleString(), _SHIFTS["bigint"])
    value_shifts = _SHIFTS["bigint"] if wide else (0,)
    shifts = [("value", s) for s in value_shifts] + [("key", s) for s in key_shifts]
    parts = [f"part{i}" for i in range(len(shifts))]
    # In a struct, NULL is equal to NULL, which joins need.
    grouped = [F.struct(*groups).alias("of")] if groups else []
    of = ["of"] if groups else []

    def cells_of(depth: int) -> DataFrame:
        """Rows with the first parts of their cells."""
        ranked = F.posexplode(F.array(*(_ordinal(v) for v in values))).alias("by", "value")
        seen = rows.select(*grouped, _ordinal(F.col(key)).alias("key"), ranked)
        return seen.select(
            *of,
            "by",
            *(
                (F.shiftright(name, s) if s else F.col(name)).alias(part)
                for (name, s), part in zip(shifts[:depth], parts)
            ),
        )

    # Of a value that is not wide there is one row per different value, of which each
    # ``by`` and tile has one task: calendar days, or purchase counts, where T receipts
    # allow sqrt(2 T).
    total = F.sum("n").over(Window.partitionBy(*of, "by"))
    tile = F.explode(F.sequence(F.lit(1), F.lit(tiles - 1)))
    last_rank = F.expr(f"tile * (total div {tiles}) + least(tile, total % {tiles})")
    cells = (
        cells_of(1)
        .groupBy(*of, "by", "part0")
        .agg(F.count("*").alias("n"))
        .select(*of, "by", "part0", "n", total.alias("total"))
        .select("*", tile.alias("tile"))
        .select("*", last_rank.alias("rank"))
    )
    wanted = _cells_at_ranks(cells, [*of, "by"], parts[:1])
    for depth in range(1, len(parts)):
        # Without groups, tiles - 1 rows per value, so safe to broadcast for any input.
        small = wanted if groups else F.broadcast(wanted)
        cells = (
            cells_of(depth + 1)
            .join(small, [*of, "by", *parts[:depth]])
            .groupBy(*of, "by", "tile", "rank", *parts[: depth + 1])
            .agg(F.count("*").alias("n"))
        )
        wanted = _cells_at_ranks(cells, [*of, "by"], parts[: depth + 1])
    value_part = parts[len(value_shifts) - 1]
    cut = F.struct("by", "tile", F.col(value_part).alias("value"), F.col(parts[-1]).alias("key"))
    return wanted.groupBy(*of).agg(F.sort_array(F.collect_list(cut)).alias("cuts"))


def exact_ntiles(
    rows: DataFrame,
    values: Mapping[str, Column],
    key: str,
    tiles: int = 4,
    groups: Sequence[str] = (),
    wide: bool = False,
) -> DataFrame:
    """``rows`` with ``ntile(tiles)`` by each of ``values``, ties by ``key``.

    A value is an integer expression (``float_ordinal`` makes one of a double) and
    gives its name to the new column; ``key`` is an integer column without repeats
    within a group. NULL comes first in both. Say ``wide`` unless a value has few
    differences.
    """
    cuts = tile_cuts(rows, list(values.values()), key, tiles, groups, wide)
    ordinal = _ordinal(F.col(key))
    found = []
    for i, (name, value) in enumerate(values.items()):
        tile = F.lit(1)
        for at in range(i * (tiles - 1), (i + 1) * (tiles - 1)):
            cut = F.get("cuts", F.lit(at))
            passed = F.struct(_ordinal(value), ordinal) > F.struct(cut["value"], cut["key"])
            tile = tile + passed.cast("int")
        found.append(tile.alias(name))
    if groups:
        with_cuts = rows.join(cuts, F.struct(*groups) == F.col("of"))
    else:
        # As a column, the subquery is planned once and not for every use.
        with_cuts = rows.select("*", cuts.scalar().alias("cuts"))
    return with_cuts.select(*(rows[c] for c in rows.columns), *found)
