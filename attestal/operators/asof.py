"""Joining rows with the version of something that held at their time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestal.operators.cells import CELL, with_cells

#: Rows of a line that one task sorts whole. A line may have no keys, so it is all rows, which are wide.
LINE_ROWS = 1 << 17

_ROW, _HELD, _TIME, _SIDE = "__row", "__held", "__time", "__side"


def as_of_join(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    time_us: str,
    since_us: str,
    take: Sequence[str],
    max_rows: int = LINE_ROWS,
) -> DataFrame:
    """Every row with ``take`` of the last version of its key at or before its time, null where there is none.

    Times are bigint columns; keys match null with null, and with no keys there
    is one line of versions for all. Of versions that begin at one time the
    largest by ``take`` holds. Both sides are put in one line and the last version
    is carried along it; a key too large for a task is cut into cells, which
    hand the version on over their edges. So neither side is broadcast and no
    row meets more than one version.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    key_columns = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
    left = rows.select(*key_columns, F.col(time_us).cast("long").alias(_TIME), F.lit(1).cast("long").alias(_SIDE), F.struct(*rows.columns).alias(_ROW))
    right = versions.select(
        *key_columns, F.col(since_us).cast("long").alias(_TIME), F.lit(0).cast("long").alias(_SIDE), F.struct(*take).alias(_HELD)
    ).filter(F.col(_TIME).isNotNull())
    line = left.unionByName(right, allowMissingColumns=True)
    celled, split = with_cells(line, [_TIME, _SIDE], max_rows, names)
    where = [*names, CELL]
    within = Window.partitionBy(*where).orderBy(_TIME, _SIDE, _HELD).rowsBetween(Window.unboundedPreceding, 0)
    carried = celled.withColumn(_HELD, F.last(_HELD, ignorenulls=True).over(within)).filter(F.col(_SIDE) == 1)
    if split:
        last = F.max_by(_HELD, F.when(F.col(_HELD).isNotNull(), F.struct(_TIME, _HELD)))
        before = Window.partitionBy(*names).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
        edges = celled.groupBy(*where).agg(last.alias("__last")).withColumn("__entry", F.last("__last", ignorenulls=True).over(before))
        same = reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in where])
        met = carried.alias("r").join(edges.drop("__last").alias("e"), same)
        carried = met.select("r.*", F.coalesce(f"r.{_HELD}", "e.__entry").alias("__found")).withColumn(_HELD, F.col("__found"))
    return carried.select(f"{_ROW}.*", *[F.col(_HELD)[c].alias(c) for c in take])
