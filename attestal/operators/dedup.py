"""Change detection, cooldowns and latest-row selection, in event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal import constants as K
from attestal.functions.predicates import FrequencyRule
from attestal.operators import cells
from attestal.operators.rules import interval_seconds
from attestal.operators.throttle import HOT_ROWS, throttle

_SECOND = 1_000_000


def mark_changes(
    df: DataFrame,
    keys: Sequence[str],
    time_us: str,
    tie: Sequence[str],
    fingerprint: str,
    out: str = "changed",
    max_rows: int = cells.MAX_ROWS,
) -> DataFrame:
    """Adds ``out``: true for the first row of a key and wherever the fingerprint moves."""
    rows = cells.with_previous(df, keys, time_us, tie, F.col(fingerprint), "__before", max_rows)
    changed = F.col("__before").isNull() | ~F.col(fingerprint).eqNullSafe(F.col("__before.v"))
    return rows.withColumn(out, changed).drop("__before")


def change_filter(
    df: DataFrame, keys: Sequence[str], time_us: str, tie: Sequence[str], fingerprint: str, max_rows: int = cells.MAX_ROWS
) -> DataFrame:
    """Rows whose fingerprint differs from the row before them in the same key."""
    return mark_changes(df, keys, time_us, tie, fingerprint, "__changed", max_rows).filter("__changed").drop("__changed")


def change_filter_ttl(
    df: DataFrame,
    keys: Sequence[str],
    time_us: str,
    tie: Sequence[str],
    fingerprint: str,
    ttl_seconds: int,
    max_rows: int = cells.MAX_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """As ``change_filter``, but an unchanged row passes once the memory expired.

    The stored fingerprint is always that of the previous row, so changes are
    found first and the lifetime then only throttles the rows in between.
    """
    marked = mark_changes(df, keys, time_us, tie, fingerprint, "__changed", max_rows)
    wait = ttl_seconds * _SECOND - 1
    kept = throttle(marked, keys, time_us, tie, wait, F.col("__changed"), hot_rows, sized_by=df)
    return kept.drop("__changed")


def cooldown(
    df: DataFrame,
    keys: Sequence[str],
    time_us: str,
    tie: Sequence[str],
    interval_s: Column | int,
    ttl_seconds: int = K.COOLDOWN_TTL_S,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """First row per key, then each row later than last sent + its own interval.

    The last-sent memory itself expires after ``ttl_seconds``; at that very
    moment a row passes, whereas a row exactly one interval later does not.
    """
    interval = F.lit(interval_s) if isinstance(interval_s, int) else interval_s
    return throttle(df, keys, time_us, tie, cooldown_wait(interval, ttl_seconds), hot_rows=hot_rows)


def cooldown_wait(interval_s: Column, ttl_seconds: int = K.COOLDOWN_TTL_S) -> Column:
    """Wait in microseconds: the interval, cut short by the memory's own lifetime."""
    return F.least(interval_s.cast("long") * _SECOND, F.lit(ttl_seconds * _SECOND - 1))


def cooldown_by_rules(
    df: DataFrame,
    keys: Sequence[str],
    time_us: str,
    tie: Sequence[str],
    rules: Sequence[FrequencyRule],
    days: Column,
    ttl_seconds: int = K.COOLDOWN_TTL_S,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    return cooldown(df, keys, time_us, tie, interval_seconds(rules, days), ttl_seconds, hot_rows)


def once_per_id(
    df: DataFrame,
    id_column: str,
    time_us: str,
    tie: Sequence[str],
    ttl_seconds: int | None = K.COMMAND_TTL_S,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """First occurrence of an id; it may pass again once its memory expired."""
    if ttl_seconds is None:
        return first_per_key(df, [id_column], [time_us, *tie])
    return throttle(df, [id_column], time_us, tie, ttl_seconds * _SECOND - 1, hot_rows=hot_rows)


def missing_suppressed(
    detections: DataFrame,
    time_us: str,
    tie: Sequence[str],
    email: str = "email",
    list_version: str = "list_version",
    ttl_seconds: int = K.MISSING_TTL_S,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One report per person and day; a new required list forgets earlier reports."""
    return throttle(detections, [email, list_version], time_us, tie, ttl_seconds * _SECOND - 1, hot_rows=hot_rows)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("__row")).select("__row.*")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key; combined map-side, so a busy key costs one row per task."""
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("__row")).select("__row.*")


def latest_per_person(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Latest row per address, or per id where there is no address.

    By id alone, the row of a person once reported missing stays beside the row
    of the credential they hand in later.
    """
    person = F.coalesce(F.concat(F.lit("e:"), "email"), F.concat(F.lit("u:"), "userId"))
    return latest_per_key(df.withColumn("__person", person), ["__person"], order).drop("__person")
