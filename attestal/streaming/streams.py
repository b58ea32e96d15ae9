"""Continuous forms of the operators.

Each function takes a streaming DataFrame and starts one query. State lives in
the checkpoint; event time drives every lifetime, so a replay gives the same
rows. ``trigger`` defaults to available-now; pass ``{"processingTime": "1
minute"}`` for a standing job. Bound the micro-batch at the source
(``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from attestal.operators import digest
from attestal.operators.cells import with_previous
from attestal.operators.dedup import latest_per_key
from attestal.operators.throttle import HOT_ROWS, throttle
from attestal.sources.published import BatchLog, KeyedTable

AVAILABLE_NOW = {"availableNow": True}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    """Keeps keyed state on disk instead of on the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


@contextmanager
def rocksdb(spark) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's setting is then as before."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    use_rocksdb(spark)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def run(query: StreamingQuery) -> None:
    """Waits for an available-now query and raises what made it fail."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def append_files(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def per_batch(
    rows: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Writes ``transform(batch)`` to ``path/batch=<id>``; a retry overwrites its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def status_stream(
    credentials: DataFrame,
    people: Callable[[], DataFrame],
    classify: Callable[[DataFrame, DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Status rows of arriving credentials: ``classify(batch, people())``.

    The required list is read anew for each micro-batch, so a new list takes
    effect with the next one. While there is no list the query stops with an
    error and its credentials wait; none is lost.
    """

    def judge(batch: DataFrame) -> DataFrame:
        listed = people()
        if listed.isEmpty():
            raise RuntimeError("no required list yet")
        return classify(batch, listed)

    return per_batch(credentials, judge, path, checkpoint, trigger=trigger)


def throttle_stream(
    rows: DataFrame,
    keys: Sequence[str],
    time_us: str,
    tie: Sequence[str],
    wait_us: Column | int,
    path: str,
    checkpoint: str,
    fingerprint: str | None = None,
    keep_us: int | None = None,
    trigger: dict | None = None,
    hot_rows: int = HOT_ROWS,
) -> StreamingQuery:
    """Cooldown (or, with ``fingerprint``, change filter with lifetime) of a stream.

    Each micro-batch goes through the batch operators, which split a key of any
    size, starting from what earlier batches left: per key the last kept time
    and the last fingerprint. That memory is a table with two versions, written
    in turn, so a retried batch finds its predecessor unharmed and overwrites
    only its own output. Entries older than ``keep_us`` before the newest event
    are forgotten; choose at least the longest wait plus the expected lateness.
    """
    mark = "__mark"
    memory = T.StructType(
        [*[rows.schema[k] for k in keys], T.StructField("__last", T.LongType()), T.StructField(mark, T.StringType())]
    )
    wait = F.lit(wait_us) if isinstance(wait_us, int) else wait_us

    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = f"{path}/state/{(number + 1) % 2}"
        known = spark.read.schema(memory).parquet(before) if number else spark.createDataFrame([], memory)
        value = F.lit("") if fingerprint is None else F.col(fingerprint)
        fresh = batch.withColumn(mark, value)
        if fingerprint is None:
            kept = throttle(fresh, keys, time_us, tie, wait, hot_rows=hot_rows, initial=known.drop(mark))
        else:
            marked = _changes_since(fresh, known, keys, time_us, tie, mark)
            kept = throttle(
                marked, keys, time_us, tie, wait, F.col("__changed"), hot_rows, sized_by=fresh, initial=known.drop(mark)
            )
        out = f"{path}/out/batch={number}"
        kept.select(*batch.columns).write.mode("overwrite").parquet(out)
        _remember(spark.read.schema(batch.schema).parquet(out), fresh, known, f"{path}/state/{number % 2}")

    def _remember(kept: DataFrame, fresh: DataFrame, known: DataFrame, folder: str) -> None:
        sent = kept.select(*keys, F.col(time_us).alias("__last"), F.lit(None).cast("string").alias(mark), F.lit(None).cast("long").alias("__at"))
        seen = fresh.select(*keys, F.lit(None).cast("long").alias("__last"), mark, F.col(time_us).alias("__at"))
        old = known.withColumn("__at", F.lit(None).cast("long"))
        state = (
            sent.unionByName(seen)
            .unionByName(old)
            .groupBy(*keys)
            .agg(
                F.max("__last").alias("__last"),
                F.coalesce(
                    F.max_by(mark, F.when(F.col("__at").isNotNull(), F.struct("__at", mark))),
                    F.max(F.when(F.col("__at").isNull(), F.col(mark))),
                ).alias(mark),
            )
        )
        if keep_us is not None:
            newest = fresh.agg(F.max(time_us)).first()[0]
            # a batch without rows tells no time, so it forgets nothing
            state = state if newest is None else state.filter(F.col("__last") >= F.lit(newest - keep_us))
        state.select(*[f.name for f in memory]).write.mode("overwrite").parquet(folder)

    return (
        rows.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def _changes_since(
    fresh: DataFrame, known: DataFrame, keys: Sequence[str], time_us: str, tie: Sequence[str], mark: str
) -> DataFrame:
    """Adds ``__changed``; the first row of a key is compared with what is remembered.

    Only those first rows, one per key, meet the memory in a join.
    """
    rows = with_previous(fresh, keys, time_us, tie, F.col(mark), "__before")
    first = F.col("__before").isNull()
    old = known.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(mark).alias("__old"), F.lit(True).alias("__known"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    opening = rows.filter(first).join(old, same, "left").withColumn(
        "__changed", F.col("__known").isNull() | ~F.col(mark).eqNullSafe(F.col("__old"))
    )
    inner = rows.filter(~first).withColumn("__changed", ~F.col(mark).eqNullSafe(F.col("__before.v")))
    return opening.select(*fresh.columns, "__changed").unionByName(inner.select(*fresh.columns, "__changed"))


def drop_redeliveries(rows: DataFrame, id_column: str, event_time: str, ttl: str = "24 hours") -> DataFrame:
    """Drops copies of ids that never recur on purpose, such as random ones.

    The built-in operator forgets an id once the watermark passes its lifetime,
    which may be later than the lifetime itself; for the exact rule use
    ``throttle_stream`` with the id as key.
    """
    return rows.withWatermark(event_time, ttl).dropDuplicatesWithinWatermark([id_column])


def published(
    rows: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    log: BatchLog,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Appends ``transform(batch)`` to a log whose readers see whole batches only."""
    return _each_batch(rows, lambda batch, number: log.append(transform(batch), number), checkpoint, trigger)


def _each_batch(rows: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE_NOW)).start()


def latest_table(rows: DataFrame, table: KeyedTable, order: Sequence[str], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keeps the latest row of every key in a table: a row replaces an older one, an older one changes nothing."""

    def step(batch: DataFrame, number: int) -> None:
        table.merge(batch, number, lambda both: latest_per_key(both, table.keys, order))

    return _each_batch(rows, step, checkpoint, trigger)


def summary_tables(
    status: DataFrame, people: KeyedTable, counts: KeyedTable, order: Sequence[str], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keeps the issue counts of every department in step with the latest status of every person.

    Where a batch replaces a person's row, the old row is taken off its
    department and the new one added to its own; other persons' rows count no more. A row
    that is older than the known one changes nothing. Both tables start from
    what was published before the batch, so a repeated batch counts once.
    """
    names = [c for c in counts.schema.names if c != "department"]

    def step(batch: DataFrame, number: int) -> None:
        newest = latest_per_key(batch.select(*people.schema.names), people.keys, order)
        known = people.read_buckets_of(newest, number).join(newest.select(*people.keys), list(people.keys), "left_semi")
        after = latest_per_key(newest.unionByName(known.select(*newest.columns)), people.keys, order)
        signed = digest.department_summary(after).unionByName(
            digest.department_summary(known).select("department", *[(-F.col(n)).alias(n) for n in names])
        )
        counts.merge(signed, number, lambda both: both.groupBy("department").agg(*[F.sum(n).alias(n) for n in names]))
        people.merge(newest, number, lambda both: latest_per_key(both, people.keys, order))

    return _each_batch(status, step, checkpoint, trigger)


def latest_stream(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Running latest row per key, for update mode; partial results combine map-side."""
    row = F.struct(*rows.columns)
    return rows.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("__row")).select("__row.*")


def message_rate_stream(rows: DataFrame, event_time: str, delay: str = "10 minutes", width: str = "1 minute") -> DataFrame:
    """Messages per topic and minute, for update mode; late data up to ``delay`` counts."""
    return (
        rows.withWatermark(event_time, delay)
        .groupBy("topic", F.window(event_time, width).alias("w"))
        .agg(F.count(F.lit(1)).alias("messages"))
        .select("topic", F.col("w.start").alias("minute"), "messages")
    )
