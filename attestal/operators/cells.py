"""Ordered operators over keys of any size.

A window partitioned by a key puts all rows of that key into one task. Where a
key is too large for that, the order axis (time, then the tie columns) is cut
into cells of at most about ``max_rows`` rows, counted over all keys, windows
run per (key, cell), and a second, small window carries values over the cell
edges. The second window sees at most two rows per key and cell. Where every
key fits, one plain window is used.

The cuts are quantiles from a mergeable sketch, combined map-side: one pass for
each axis, and no more numbers than there are cells.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS = 2_000_000
#: The most cells; past them, cells grow with the rows.
MOST_CELLS = 1 << 14
#: A cell of a quarter of the bound stays within it when sketches err and equal values fall on a cut.
_PARTS = 4
_AXES = 4
CELL = "__cell"
_CUTS, _CLASS = "__cuts", "__class"


def with_cells(df: DataFrame, order: Sequence[str], max_rows: int = MAX_ROWS, keys: Sequence[str] | None = None) -> tuple[DataFrame, bool]:
    """Adds the ``__cell`` column, which rises with the order; the flag says whether there is more than one.

    ``order`` names bigint columns, the most significant first; others end the
    list. A value of one axis that holds many rows becomes a cell of its own
    and is cut by the next axis. With ``keys`` nothing is cut unless one of them
    has more than ``max_rows`` rows. At most ``MOST_CELLS`` quantiles and their
    cells come to the driver, whatever the number of rows.
    """
    axes = [c for c in order if df.schema[c].dataType.simpleString() == "bigint"][:_AXES]
    counted = df.groupBy(*(keys or [])).agg(F.count(F.lit(1)).alias("n"))
    rows, largest = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    celled = df.withColumn(CELL, F.lit(0).cast("long"))
    if largest <= max_rows or not axes:
        return celled, False
    # cells still to be cut, and into how many parts
    large = {0: min(MOST_CELLS, math.ceil(_PARTS * rows / max_rows))}
    for axis in axes:
        if not large:
            break
        cuts, below = {}, {}
        for cell, values in _quantiles(celled, axis, large):
            cuts[cell], found = _cut(values)
            # the cell of a value that several quantiles share
            below |= {_place(cell, place): times + 1 for place, times in found.items()}
        celled = _assign(celled, axis, cuts)
        large = below
    return celled, True


def _quantiles(celled: DataFrame, axis: str, large: dict[int, int]) -> list[tuple[int, list[int]]]:
    """By cell to cut, as many quantiles of the axis as it is to have parts (rounded up to a power of two)."""
    classes = {cell: max(1, math.ceil(math.log2(parts))) for cell, parts in large.items()}
    table = celled.sparkSession.createDataFrame(list(classes.items()), f"{CELL} long, {_CLASS} int")
    marked = celled.select(CELL, axis).join(F.broadcast(table), CELL)
    sketches = []
    for size in sorted(set(classes.values())):
        parts = 1 << size
        shares = F.lit([i / parts for i in range(1, parts)])
        sketches.append(F.percentile_approx(F.when(F.col(_CLASS) == size, F.col(axis)), shares, 16 * parts))
    found = marked.groupBy(CELL).agg(F.coalesce(*sketches).alias(_CUTS)).filter(F.col(_CUTS).isNotNull())
    return [(cell, list(values)) for cell, values in found.collect()]


def _cut(values: Sequence[int]) -> tuple[list[int], dict[int, int]]:
    """Where cells start, and the places of cells that hold one frequent value, with the quantiles it fills."""
    starts, frequent = [], {}
    for value, times in sorted(Counter(values).items()):
        if not starts or starts[-1] != value:
            starts.append(value)
        if times > 1:
            frequent[len(starts)] = times
            starts.append(value + 1)
    return starts, frequent


def _place(cell: int, place: int) -> int:
    return cell * (4 * MOST_CELLS) + place


def _assign(celled: DataFrame, axis: str, cuts: dict[int, list[int]]) -> DataFrame:
    """Rows of the cells that were cut, in their new cells: by binary search among the cuts."""
    table = celled.sparkSession.createDataFrame(list(cuts.items()), f"{CELL} long, {_CUTS} array<long>")
    steps = F.lit([1 << i for i in reversed(range(max((len(c) for c in cuts.values()), default=1).bit_length()))])

    def step(at: Column, size: Column) -> Column:
        return F.when(F.get(_CUTS, at + size - 1) <= F.col(axis), at + size).otherwise(at)

    place = F.aggregate(steps, F.lit(0), step).cast("long")
    cell = F.col(CELL) * F.lit(4 * MOST_CELLS) + F.when(F.col(_CUTS).isNotNull(), place).otherwise(0)
    return celled.join(F.broadcast(table), CELL, "left").withColumn(CELL, cell).drop(_CUTS)


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    time_us: str,
    tie: Sequence[str],
    value: Column,
    out: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Adds ``out``: a struct ``<v>`` with the previous row's value, null on the first row."""
    order = [time_us, *tie]
    packed = df.withColumn("__v", F.struct(value.alias("v")))
    celled, split = with_cells(packed, order, max_rows, keys)
    within = Window.partitionBy(*keys, CELL).orderBy(*order)
    if not split:
        by_key = Window.partitionBy(*keys).orderBy(*order)
        return packed.withColumn(out, F.lag("__v").over(by_key)).drop("__v")
    marked = (
        celled.withColumn("__first", F.row_number().over(within) == 1)
        .withColumn("__last", F.lead(F.lit(1)).over(within).isNull())
        .withColumn(out, F.lag("__v").over(within))
    )
    across = Window.partitionBy(*keys).orderBy(*order)
    edges = marked.filter("__first OR __last").withColumn(out, F.lag("__v").over(across))
    whole = marked.filter("NOT __first").unionByName(edges.filter("__first"))
    return whole.drop("__v", "__first", "__last", CELL)


def with_position(
    df: DataFrame, keys: Sequence[str], time_us: str, tie: Sequence[str], out: str, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Adds ``out``: the row's dense 0-based position within its key."""
    order = [time_us, *tie]
    celled, split = with_cells(df, order, max_rows, keys)
    if not split:
        by_key = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(out, (F.row_number().over(by_key) - 1).cast("long"))
    before = Window.partitionBy(*keys).orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        celled.groupBy(*keys, CELL)
        .agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*order)).alias("__start"))
        .withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n", "__start")
    )
    within = Window.partitionBy(*keys, CELL).orderBy(*order)
    numbered = celled.withColumn("__rank", F.row_number().over(within) - 1)
    return (
        numbered.join(base, [*keys, CELL])
        .withColumn(out, (F.col("__rank") + F.col("__base")).cast("long"))
        .drop("__rank", "__base", CELL)
    )
