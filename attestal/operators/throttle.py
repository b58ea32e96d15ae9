"""Greedy suppression in event time.

Per key, the first row is kept, and so is every later row that comes more than
its own ``wait`` after the last *kept* row; a row marked ``force`` is always
kept. What is kept next depends on what was kept before, so no window function
expresses it.

Ordinary keys are read once, in order, from hash partitions sorted by key and
time; nothing is held per key but the last kept time. A key above ``hot_rows``
rows never reaches that scan: its rows are written to the shared folder in time
slices no wider than the shortest wait. Within such a slice a key can keep at
most one row that is not forced, and that row is a plain minimum, so each slice
is one map-side combined aggregation over all hot keys. The number of steps is
the time span over the shortest wait, whatever the number of rows.

Where that would be many steps, waits are short against the span, and the order
axis is cut into cells instead. A cell is summed up as a function from the last
kept time before it to the last kept time after it, which few rows decide. The
functions of neighbouring cells are composed up a tree, the entry times handed
down it, and then all cells are scanned side by side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestal.operators.cells import CELL, with_cells
from attestal.session import work_dir

HOT_ROWS = 5_000_000
ROWS_PER_FILE = 5_000_000
CELL_ROWS = 2_000_000
MAX_STEPS = 400
ROWS_PER_STEP = 1_000_000
_MAX_HOT_KEYS = 10_000
#: Cells, or nodes of the tree over them, that are composed to one.
FAN = 16
_WAIT, _FORCE, _LAST, _SLICE = "__wait", "__force", "__last", "__slice"
_NODE, _PARENT = "__node", "__parent"


def throttle(
    df: DataFrame,
    keys: Sequence[str],
    time_us: str,
    tie: Sequence[str],
    wait_us: Column | int,
    force: Column | None = None,
    hot_rows: int = HOT_ROWS,
    sized_by: DataFrame | None = None,
    initial: DataFrame | None = None,
    max_steps: int = MAX_STEPS,
) -> DataFrame:
    """Rows of ``df`` that pass; same columns. ``time_us`` is a bigint column.

    ``sized_by`` may name a cheaper frame with the same keys, times and waits,
    on which key sizes are counted. ``initial`` holds what is remembered from
    before: at most one row per key, the key columns and ``__last``.
    """
    wait = F.lit(wait_us) if isinstance(wait_us, int) else wait_us
    rows = df.withColumn(_WAIT, wait.cast("long")).withColumn(
        _FORCE, F.lit(False) if force is None else F.coalesce(force, F.lit(False))
    )
    if initial is None:
        known = T.StructType([*[df.schema[k] for k in keys], T.StructField(_LAST, T.LongType())])
        initial = df.sparkSession.createDataFrame([], known)
    hot = _hot_keys((df if sized_by is None else sized_by).withColumn(_WAIT, wait.cast("long")), keys, time_us, hot_rows)
    if not hot:
        return _scan(rows, initial, keys, time_us, tie).select(*df.columns)
    sliced, chained = [], []
    for h in hot:
        # Many steps are worth it only where each has much to do.
        steps = (h["__high"] - h["__low"]) // (h[_WAIT] + 1) + 1
        (sliced if steps <= max(max_steps, h["__n"] // ROWS_PER_STEP) else chained).append(h)
    kept = _scan(_pick(rows, keys, hot, "left_anti"), _pick(initial, keys, hot, "left_anti"), keys, time_us, tie).select(*df.columns)
    for part, way in ((sliced, _by_slices), (chained, _by_cells)):
        if part:
            mine, known = _pick(rows, keys, part, "left_semi"), _pick(initial, keys, part, "left_semi")
            kept = kept.unionByName(way(mine, known, part, keys, time_us, tie).select(*df.columns))
    return kept


def _pick(df: DataFrame, keys: Sequence[str], hot: Sequence[Row], how: str) -> DataFrame:
    """Rows with (left_semi) or without (left_anti) one of the listed keys, at most 10,000."""
    listed = df.sparkSession.createDataFrame([h[: len(keys)] for h in hot], T.StructType([df.schema[k] for k in keys]))
    return df.alias("r").join(F.broadcast(listed.alias("h")), _same_key(keys, "r", "h"), how)


def _same_key(keys: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _hot_keys(df: DataFrame, keys: Sequence[str], time_us: str, hot_rows: int) -> list[Row]:
    """The largest keys above ``hot_rows`` rows, each with its size, span and shortest wait.

    At most 10,000 of them, so the list may be local. A key left out of a full
    list holds less than a ten-thousandth of the table and can be scanned; both
    ways give the same rows.
    """
    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.min(time_us).alias("__low"), F.max(time_us).alias("__high"), F.min(_WAIT).alias(_WAIT)
    )
    return sizes.filter(F.col("__n") > hot_rows).orderBy(F.desc("__n")).limit(_MAX_HOT_KEYS).collect()


def _scan(rows: DataFrame, initial: DataFrame, keys: Sequence[str], time_us: str, tie: Sequence[str]) -> DataFrame:
    """What is remembered sorts before the rows of its key and is not passed on."""
    seeded = rows.withColumn(_LAST, F.lit(None).cast("long")).unionByName(initial, allowMissingColumns=True)
    ordered = seeded.repartition(*keys).sortWithinPartitions(*keys, F.col(_LAST).desc_nulls_last(), time_us, *tie)
    return ordered.mapInArrow(_keep_fn(list(keys), time_us), seeded.schema)


def _keep_fn(keys: list[str], time_us: str) -> Callable[[Iterator], Iterator]:
    """Scan of sorted record batches; the state outlives a batch, not a key."""
    columns = (time_us, _WAIT, _FORCE, _LAST)

    def keep(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def changes(column: pa.Array) -> np.ndarray:
            """True where a value differs from the one above; null equals null."""
            head, tail = column[:-1], column[1:]
            differs = pc.fill_null(pc.not_equal(head, tail), False)
            one_null = pc.xor(pc.is_null(head), pc.is_null(tail))
            return pc.or_(differs, one_null).to_numpy(zero_copy_only=False)

        def plain(column: pa.Array) -> list:
            return pc.fill_null(column, False if pa.types.is_boolean(column.type) else 0).to_numpy(zero_copy_only=False).tolist()

        open_key, last = None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            starts = np.zeros(n, dtype=bool)
            for name in keys:
                starts[1:] |= changes(batch.column(name))
            starts[0] = open_key != [batch.column(k)[0].as_py() for k in keys]
            seeds = batch.column(columns[3]).is_valid().to_numpy(zero_copy_only=False).tolist()
            times, waits, forced, lasts = (plain(batch.column(c)) for c in columns)
            mask = [False] * n
            for i, fresh in enumerate(starts.tolist()):
                now = times[i]
                if seeds[i]:
                    last = lasts[i]
                elif fresh or forced[i] or now > last + waits[i]:
                    mask[i], last = True, now if fresh else max(last, now)
            open_key = [batch.column(k)[n - 1].as_py() for k in keys]
            yield batch.filter(pa.array(mask))

    return keep


def _by_slices(
    rows: DataFrame, initial: DataFrame, hot: Sequence[Row], keys: Sequence[str], time_us: str, tie: Sequence[str]
) -> DataFrame:
    """The same rule for hot keys, one aggregation per slice of time.

    Rows, and the outcome of each slice, are written to the shared folder: a
    lost executor costs a re-read, and no plan grows with the number of slices.
    """
    spark = rows.sparkSession
    folder = work_dir(spark, "throttle")
    width = max(min(h[_WAIT] for h in hot) + 1, 1)
    first, final = min(h["__low"] for h in hot) // width, max(h["__high"] for h in hot) // width
    # Each slice goes to enough writers to keep files even, and to no more.
    writers = math.ceil(sum(h["__n"] for h in hot) / (final - first + 1) / ROWS_PER_FILE)
    salt = F.pmod(F.xxhash64(time_us, *tie), F.lit(writers))
    sliced = rows.withColumn(_SLICE, F.floor(F.col(time_us) / F.lit(width)))
    sliced.repartition(F.col(_SLICE), salt).write.partitionBy(_SLICE).parquet(f"{folder}/rows")
    stored = spark.read.schema(sliced.schema).parquet(f"{folder}/rows")
    slices = [r[0] for r in stored.select(_SLICE).distinct().orderBy(_SLICE).collect()]

    order = [time_us, *tie]
    packed = F.struct(*order, *[c for c in rows.columns if c not in order])
    state = initial.select(*keys, _LAST)
    steps = []
    for number in slices:
        # The state has one row per hot key, so it is always small enough to broadcast.
        joined = (
            stored.filter(F.col(_SLICE) == number)
            .drop(_SLICE)
            .alias("r")
            .join(F.broadcast(state.alias("s")), _same_key(keys, "r", "s"), "left")
            .select("r.*", f"s.{_LAST}")
        )
        ready = ~F.col(_FORCE) & (F.col(_LAST).isNull() | (F.col(time_us) > F.col(_LAST) + F.col(_WAIT)))
        step = (
            joined.unionByName(state, allowMissingColumns=True)
            .groupBy(*keys)
            .agg(
                F.min(F.when(ready & F.col(time_us).isNotNull(), packed)).alias("__pick"),
                F.min(F.when(F.col(_FORCE), F.struct(*order))).alias("__first_forced"),
                F.max(F.when(F.col(_FORCE), F.col(time_us))).alias("__last_forced"),
                F.max(_LAST).alias(_LAST),
            )
        )
        # A forced row restarts the wait, so only a row before it can be due.
        due = F.col("__first_forced").isNull() | (F.struct(*[F.col("__pick")[c] for c in order]) < F.col("__first_forced"))
        step = step.withColumn("__pick", F.when(due, F.col("__pick")))
        step = step.withColumn(_LAST, F.greatest(F.col("__pick")[time_us], "__last_forced", _LAST))
        step = step.select(*keys, "__pick", _LAST)
        steps.append(f"{folder}/steps/n={number}")
        step.write.parquet(steps[-1])
        state = spark.read.schema(step.schema).parquet(steps[-1]).select(*keys, _LAST)
    picked = spark.read.schema(step.schema).parquet(*steps).filter("__pick IS NOT NULL").select("__pick.*")
    return picked.unionByName(stored.filter(_FORCE).drop(_SLICE))


def _by_cells(
    rows: DataFrame, initial: DataFrame, hot: Sequence[Row], keys: Sequence[str], time_us: str, tie: Sequence[str]
) -> DataFrame:
    """The same rule for hot keys with short waits, all cells of a key side by side."""
    order, where = [time_us, *tie], [*keys, CELL]
    cell_rows = max(1, min(CELL_ROWS, min(h["__n"] for h in hot) // 2))
    celled, _ = with_cells(rows, order, cell_rows)
    steps = T.ArrayType(T.LongType())
    bounds = [T.StructField("below", steps), T.StructField("leave", steps), T.StructField("top", T.LongType())]
    summary = T.StructType([*[celled.schema[c] for c in where], *bounds])
    # One remembered row per listed key at most, so it may be broadcast.
    narrow = celled.select(*where, *order, _WAIT, _FORCE).alias("r")
    seeded = narrow.join(F.broadcast(initial.alias("h")), _same_key(keys, "r", "h"), "left").select("r.*", f"h.{_LAST}")
    summed = seeded.groupBy(*where).applyInPandas(_sum_up_fn(where, order, time_us), summary)
    # cells cut the order axis of all keys, so one numbering, of as many rows as there are cells, serves all
    starts = celled.groupBy(CELL).agg(F.min(F.struct(*order)).alias("__start"))
    numbered = starts.select(CELL, (F.row_number().over(Window.orderBy("__start")) - 1).cast("long").alias(_NODE))
    entered = _entries(summed.join(numbered, CELL), initial, keys)
    return _scan(celled, entered.select(*where, _LAST), where, time_us, tie)


def _entries(cells: DataFrame, initial: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells with the last kept time with which each is entered; none where there is none yet.

    A tree over the cells: on the way up the functions of ``FAN`` neighbours are
    composed to one, on the way down each node hands its entry time to its
    children, in order. No group is larger than ``FAN``, and the rounds are the
    levels of the tree. Every level is written, so that no plan grows with them.
    """
    spark, folder = cells.sparkSession, work_dir(cells.sparkSession, "entries")
    cells.write.parquet(f"{folder}/up-0")
    cells = spark.read.schema(cells.schema).parquet(f"{folder}/up-0")
    highest = cells.agg(F.max(_NODE)).first()[0] or 0
    node = T.StructType([*[f for f in cells.schema.fields if f.name != CELL]])
    levels = [cells.drop(CELL)]
    while highest > 0:
        over = levels[-1].withColumn(_PARENT, F.floor(F.col(_NODE) / FAN).cast("long"))
        over.groupBy(*keys, _PARENT).applyInPandas(_compose_fn(), node).write.parquet(f"{folder}/up-{len(levels)}")
        levels.append(spark.read.schema(node).parquet(f"{folder}/up-{len(levels)}"))
        highest //= FAN
    entry = T.StructType([*[cells.schema[k] for k in keys], cells.schema[_NODE], T.StructField(_LAST, T.LongType())])
    # the root is entered with what is remembered
    entered = initial.select(*keys, F.lit(0).cast("long").alias(_NODE), _LAST)
    for level in range(len(levels) - 2, -1, -1):
        above = entered.withColumnRenamed(_NODE, _PARENT).alias("h")
        below = levels[level].withColumn(_PARENT, F.floor(F.col(_NODE) / FAN).cast("long")).alias("r")
        met = below.join(above, _same_key([*keys, _PARENT], "r", "h"), "left").select("r.*", f"h.{_LAST}")
        met.groupBy(*keys, _PARENT).applyInPandas(_enter_fn(list(keys)), entry).write.parquet(f"{folder}/down-{level}")
        entered = spark.read.schema(entry).parquet(f"{folder}/down-{level}")
    places = cells.select(*keys, CELL, _NODE).alias("r").join(entered.alias("h"), _same_key([*keys, _NODE], "r", "h"))
    return places.select("r.*", f"h.{_LAST}").filter(F.col(_LAST).isNotNull())


def _sum_up_fn(where: list[str], order: list[str], time_us: str) -> Callable:
    """A cell as steps: coming with a last time under ``below[i]``, it is left with ``leave[i]``."""
    wait_name, force_name, last_name = _WAIT, _FORCE, _LAST

    def sum_up(rows):  # noqa: ANN001, ANN202 - pandas in, pandas out
        from bisect import bisect_left

        rows = rows.sort_values(order)
        times = rows[time_us].tolist()
        # A row moves the last kept time when that is under the row's limit.
        limits = [
            t if forced else t - w
            for t, w, forced in zip(times, rows[wait_name].tolist(), rows[force_name].tolist(), strict=True)
        ]
        # From the back: rows whose limit no earlier row of the rest exceeds,
        # nearest last, so their limits fall from left to right.
        leave, ahead, marks = [0] * len(times), [], []
        for i in range(len(times) - 1, -1, -1):
            found = bisect_left(marks, -times[i]) - 1
            leave[i] = leave[ahead[found]] if found >= 0 else times[i]
            while marks and -marks[-1] <= limits[i]:
                marks.pop()
                ahead.pop()
            marks.append(-limits[i])
            ahead.append(i)
        seed = rows[last_name].iloc[0]
        highest = times[0] if seed != seed or seed is None else max(times[0], int(seed))
        below, after = [], []
        for i, limit in enumerate(limits):
            if below and limit <= below[-1]:
                continue
            if below and after[-1] == leave[i]:
                below[-1] = limit
            else:
                below.append(limit)
                after.append(leave[i])
            if limit > highest:
                break
        out = rows.iloc[:1][where].copy()
        out["below"], out["leave"], out["top"] = [below], [after], highest
        return out

    return sum_up


def _through(below: Sequence[int], leave: Sequence[int], last: int | None) -> int:
    """The last kept time after cells that are entered with ``last``."""
    from bisect import bisect_right

    if last is None:
        return int(leave[0])
    at = bisect_right(below, last)
    return int(leave[at]) if at < len(below) else last


def _compose_fn() -> Callable:
    """Neighbouring cells, or nodes, as one; entered with at most the ``top`` of the first."""
    through, node, parent = _through, _NODE, _PARENT

    def compose(cells):  # noqa: ANN001, ANN202 - pandas in, pandas out
        cells = cells.sort_values(node)
        out = cells.iloc[:1].drop(columns=node).rename(columns={parent: node})
        top = int(cells["top"].iloc[0])
        below, leave = list(cells["below"].iloc[0]), list(cells["leave"].iloc[0])
        for next_below, next_leave in zip(cells["below"].iloc[1:], cells["leave"].iloc[1:], strict=True):
            next_below = list(next_below)
            limits = below if below[-1] > top else below + [b for b in next_below if b > below[-1]]
            after = [through(next_below, next_leave, v) for v in leave]
            after += [through(next_below, next_leave, b - 1) for b in limits[len(below) :]]
            # steps that lead to the same time are one
            last = [i for i in range(len(limits)) if i + 1 == len(limits) or after[i] != after[i + 1]]
            below, leave = [limits[i] for i in last], [after[i] for i in last]
        out["below"], out["leave"] = [below], [leave]
        return out

    return compose


def _enter_fn(keys: list[str]) -> Callable:
    """The last kept time with which each child of a node is entered."""
    through, node, last_name = _through, _NODE, _LAST

    def enter(cells):  # noqa: ANN001, ANN202 - pandas in, pandas out
        import pandas as pd

        cells = cells.sort_values(node)
        known = cells[last_name].iloc[0]
        last = None if pd.isna(known) else int(known)
        entries = []
        for below, leave in zip(cells["below"], cells["leave"], strict=True):
            entries.append(last)
            last = through(list(below), leave, last)
        out = cells[[*keys, node]].copy()
        out[last_name] = pd.array(entries, dtype="Int64")
        return out

    return enter
