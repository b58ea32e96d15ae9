"""Suppression of a stream with keyed state, event-time timers and an ordering buffer.

Rows wait in the state until the watermark has passed them and then go through
the rule in order of time, whatever order they came in. For each key the state
holds the last kept time and the last mark. Keys are dealt into buckets by
hash, so that Python is entered once for many keys; Spark keeps one state per
bucket (RocksDB, see ``streams.rocksdb``) and reads and writes only the buckets
of a batch or of a timer; no table is written anew. A key whose memory can no
longer suppress anything is forgotten by the timer.

The watermark trails the newest event by ``delay``. A row that comes later
than that is not judged: it is passed on at once with ``late`` set, so that the
caller can put it aside. Spark itself is told ``delay`` plus ``grace``, because it
drops what comes behind its watermark; only rows later than both are lost to it
(it counts them as ``numRowsDroppedByWatermark``).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

_SECOND = 1_000_000
DAY_S = 86_400
#: Rows later than the delay by more than this are dropped by Spark.
GRACE_S = 365 * DAY_S
#: Written with every row, so that nothing is lost on its way through Python.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
_NEVER = -(2**63)
#: Buckets of keys; choose them so that one holds some hundred keys. A checkpoint keeps its number.
BUCKETS = 1024


def _sortable(column: str, kind: T.DataType) -> Column:
    """A text that sorts like the value, null first."""
    value = F.col(column)
    if isinstance(kind, T.IntegralType):
        text = F.lpad((value.cast("decimal(20,0)") + F.lit(str(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    else:
        text = value.cast("string")
    return F.when(value.isNull(), "0").otherwise(F.concat(F.lit("1"), text))


def throttled(
    rows: DataFrame,
    keys: Sequence[str],
    time_us: str,
    tie: Sequence[str],
    wait_us: Column | int,
    longest_wait_us: int,
    delay_s: int,
    fingerprint: str | None = None,
    tick: str | None = None,
    grace_s: int = GRACE_S,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The rows of a stream that pass, as ``throttle`` passes them in a batch, with ``late``.

    ``time_us`` is a bigint column, ``tie`` breaks equal times (whole numbers, or
    by text). With ``fingerprint``, a text column, a row that differs from the row
    before it passes in any case. ``longest_wait_us`` bounds ``wait_us``: so long a
    key is remembered. Rows whose column ``tick`` is true only tell the time: they
    advance the watermark and are neither kept nor passed on; a source sends them
    when it is idle or at its end. A row without a time counts as late.

    A bucket's waiting rows are sorted in one task: as many as the source sends its
    keys within the delay. For larger keys that arrive in order see ``streams.throttle_stream``.
    """
    if "late" in (c.lower() for c in rows.columns):
        raise ValueError("the column late is added here")
    wait = F.lit(wait_us) if isinstance(wait_us, int) else wait_us
    is_tick = F.lit(False) if tick is None else F.coalesce(F.col(tick), F.lit(False))
    given = rows.select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("__bucket"),
        F.to_json(F.struct(*keys), _JSON).alias("__key"),
        F.coalesce(F.col(time_us), F.lit(_NEVER)).alias("__t"),
        F.coalesce(wait.cast("long"), F.lit(0)).alias("__wait"),
        (F.lit("") if fingerprint is None else F.col(fingerprint)).alias("__mark"),
        F.concat_ws("\x01", *[_sortable(c, rows.schema[c].dataType) for c in tie]).alias("__order"),
        F.to_json(F.struct(*rows.columns), _JSON).alias("__row"),
        is_tick.alias("__tick"),
        F.timestamp_micros(time_us).alias("__at"),
    )
    timed = given.withWatermark("__at", f"{delay_s + grace_s} seconds")
    step = _step(longest_wait_us, grace_s * _SECOND, fingerprint is not None)
    out = timed.groupBy("__bucket").applyInPandasWithState(
        _step(longest_wait_us, grace_s * _SECOND, fingerprint is not None),
        "row string, late boolean", "held binary", "append", GroupStateTimeout.EventTimeTimeout,
    )
    return out.select(F.from_json("row", rows.schema, _JSON).alias("r"), "late").select("r.*", "late")


def _step(longest_us: int, grace_us: int, by_mark: bool) -> Callable:
    """One bucket in one batch, or at its timer."""

    def step(bucket, frames: Iterator, state) -> Iterator:  # noqa: ANN001 - Spark's own types
        import pandas as pd

        mark_ms = state.getCurrentWatermarkMs()
        # up to here rows have been judged
        now = mark_ms * 1000 + grace_us if mark_ms > 0 else -1
        #: by key (last kept time, last mark); rows that wait, as (time, order, row, key, wait, mark)
        memory, held = pickle.loads(state.get[0]) if state.exists else ({}, [])
        late = []
        if not state.hasTimedOut:
            for frame in frames:
                columns = (frame[c].tolist() for c in ("__t", "__order", "__row", "__key", "__wait", "__mark", "__tick"))
                for *row, is_tick in zip(*columns, strict=True):
                    if is_tick:
                        continue
                    if row[0] <= now:
                        late.append(row[2])
                    else:
                        held.append(tuple(row))
        held.sort(key=lambda r: r[:3])
        ready = next((i for i, r in enumerate(held) if r[0] > now), len(held))
        passed = []
        for t, _, row, key, wait, mark in held[:ready]:
            last, before = memory.get(key, (None, None))
            if last is None or t > last + wait or (by_mark and mark != before):
                passed.append(row)
                last = t if last is None else max(last, t)
            memory[key] = (last, mark)
        held = held[ready:]
        # no row still to come can be suppressed by an older memory
        memory = {key: known for key, known in memory.items() if known[0] + longest_us > now}
        # the watermark, in Spark's terms, at which there is something to do next
        due = held[0][0] if held else min((last for last, _ in memory.values()), default=0) + longest_us
        if held or memory:
            state.update((pickle.dumps((memory, held)),))
            state.setTimeoutTimestamp(max(-(-(due - grace_us) // 1000), mark_ms + 1))
        elif state.exists:
            state.remove()
        if passed or late:
            yield pd.DataFrame({"row": passed + late, "late": [False] * len(passed) + [True] * len(late)})

    return step
