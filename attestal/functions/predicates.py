"""Boolean Columns: filters over credentials, statuses, rules and logs."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestal import constants as K
from attestal.functions.scalar import any_true, clock_seconds, weekday_number


def is_children_check(type_name: Column) -> Column:
    return F.lower(type_name).contains(K.DOCUMENT_TYPE_WORD)


def should_notify(status: Column) -> Column:
    return status.isin(*K.NOTIFIABLE)


def is_non_compliant(status: Column) -> Column:
    return status != K.COMPLIANT


def severity_lines(container: Column, line: Column, containers: Sequence[str]) -> Column:
    """Error and warning lines of the named containers."""
    return container.isin(*containers) & line.rlike("ERROR|WARN")


# --- frequency conditions ---------------------------------------------------


@dataclass(frozen=True)
class FrequencyRule:
    """One line of the ordered notification frequency table."""

    name: str
    condition: str
    interval_hours: int

    @property
    def test(self) -> DaysTest | None:
        return parse_condition(self.condition)


@dataclass(frozen=True)
class DaysTest:
    """Parsed condition; ``op`` is ``always`` or a comparison with ``bound``."""

    op: str
    bound: int = 0

    def holds(self, days: Column) -> Column:
        if self.op == "always":
            return F.lit(True)
        compare = {
            "<=": days <= self.bound,
            "<": days < self.bound,
            ">=": days >= self.bound,
            ">": days > self.bound,
        }
        return any_true(compare[self.op])


def parse_condition(text: str) -> DaysTest | None:
    """``always`` or ``days_until_expiry <op> <int>``; None for anything else.

    A bad threshold makes the rule one that never matches instead of failing
    the records it meets; ``config.invalid_rules`` reports such rules.
    """
    if text == "always":
        return DaysTest("always")
    if not text.startswith("days_until_expiry"):
        return None
    op = next((o for o in ("<=", "<", ">=", ">") if o in text), None)
    if op is None:
        return None
    operand = text.rsplit(op, 1)[1].strip()
    if not re.fullmatch(r"[+-]?[0-9]+", operand) or not -(1 << 31) <= int(operand) < 1 << 31:
        return None
    return DaysTest(op, int(operand))


def condition_holds(text: str, days: Column) -> Column:
    test = parse_condition(text)
    return F.lit(False) if test is None else test.holds(days)


# --- digest schedule --------------------------------------------------------


def local_time(utc: Column, zone: str) -> Column:
    """Wall-clock time in ``zone`` of a zone-less UTC timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def digest_due(
    utc: Column, weekday: Column | str, clock: Column | str, zone: str, last_sent: Column | None = None
) -> Column:
    """True from two minutes before to three after the weekly slot, inclusive.

    ``utc`` is a zone-less UTC timestamp, ``last_sent`` the local ISO date of
    the last digest. The slot is turned back into UTC, so days on which clocks
    change are measured in elapsed time.
    """
    weekday = F.lit(weekday) if isinstance(weekday, str) else weekday
    clock = F.lit(clock) if isinstance(clock, str) else clock
    local = local_time(utc, zone)
    midnight = F.date_trunc("DAY", local).cast("timestamp_ntz")
    slot = midnight + F.make_dt_interval(secs=clock_seconds(clock))
    slot_utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), slot)
    in_window = utc.between(slot_utc - F.expr("INTERVAL 2 MINUTES"), slot_utc + F.expr("INTERVAL 3 MINUTES"))
    due = (F.weekday(local) == weekday_number(weekday)) & in_window
    if last_sent is not None:
        due = due & ~any_true(last_sent == F.to_date(local).cast("string"))
    return due
