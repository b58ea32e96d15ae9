"""Column builders for dates, names, statuses, fingerprints and texts.

Every function takes Columns and returns a Column; none of them looks at the
clock, so the as-of date is always an argument.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from attestal import constants as K

# Characters up to and including the blank count as outer white space.
_OUTER_BLANK = r"^[\x00-\x20]+|[\x00-\x20]+$"
_CLOCK = r"^([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]{1,9})?)?$"
DEFAULT_CLOCK_S = 9 * 3600


def any_true(condition: Column) -> Column:
    """A three-valued condition read as a filter would: unknown is false."""
    return F.coalesce(condition, F.lit(False))


# --- dates ------------------------------------------------------------------


def expiry_text(date: Column) -> Column:
    """``struct<year,month,day>`` as text, unchecked: 2024-02-30 prints as is."""
    text = F.format_string("%d-%02d-%02d", date["year"], date["month"], date["day"])
    return F.when(date.isNotNull(), text)


def calendar_date(date: Column) -> Column:
    """``struct<year,month,day>`` as a date, null when no such day exists."""
    text = F.format_string("%04d-%02d-%02d", date["year"], date["month"], date["day"])
    return F.when(date.isNotNull(), F.try_to_date(text, "yyyy-MM-dd"))


def days_until_expiry(date: Column, as_of: Column) -> Column:
    return F.datediff(calendar_date(date), as_of).cast("long")


def days_since_start(start_text: Column, as_of: Column) -> Column:
    """Whole days since an ISO start date; negative if it lies ahead."""
    strict = F.when(start_text.rlike(r"^\d{4}-\d{2}-\d{2}$"), start_text)
    return F.datediff(as_of, F.try_to_date(strict, "yyyy-MM-dd")).cast("long")


def epoch_micros(moment: Column, dtype: str) -> Column:
    """Microseconds since 1970 of a timestamp column of either kind."""
    if dtype == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), moment)
    return F.unix_micros(moment)


# --- names and identities ---------------------------------------------------


def name_key(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, _OUTER_BLANK, ""))


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def synthetic_user_id(email: Column) -> Column:
    """Stand-in id for a person the provider does not know."""
    return F.substring(F.md5(email), 1, 16)


def fingerprint(fields: Mapping[str, Column] | Sequence[tuple[str, Column]]) -> Column:
    """Hex digest of the named fields; null and empty text count as equal."""
    items = fields.items() if isinstance(fields, Mapping) else fields
    parts = [F.coalesce(value.cast("string"), F.lit("")).alias(name) for name, value in items]
    return F.md5(F.to_json(F.struct(*parts)))


def credential_fingerprint(credential: Column) -> Column:
    """Digest of the seven fields whose change makes a credential worth publishing."""
    return fingerprint(
        [
            ("user_id", credential["subject_user_id"]),
            ("document_id", credential["document_id"]),
            ("version_id", credential["document_version_id"]),
            ("expiry_status", credential["metadata"]["expiry_status"]),
            ("approval_status", credential["metadata"]["approval"]["status"]),
            ("credential_number", credential["attributes"]["credential_number"]),
            ("expiry_date", expiry_text(credential["attributes"]["expiry_period_end_date"])),
        ]
    )


def state_key(*parts: Column | str) -> Column:
    """Colon-joined key, e.g. ``state_key("notification", "last", user, status)``."""
    return F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def last_notification_key(user: Column, status: Column) -> Column:
    return state_key("notification", "last", user, status)


def sent_key(notification_id: Column) -> Column:
    return state_key("notification", "sent", notification_id)


def credential_key(user: Column, document: Column) -> Column:
    return state_key("sc", "credential", user, document)


def compliance_key(user: Column) -> Column:
    return state_key("wwcc", "compliance", user)


def missing_key(email: Column) -> Column:
    return state_key("wwcc", "missing", email)


def manager_display_name(address: Column) -> Column:
    """Local part of an address; ``Manager`` where there is no address."""
    local = F.substring_index(address, "@", 1)
    return F.when(address.contains("@"), local).otherwise(F.lit("Manager"))


# --- status and flags -------------------------------------------------------


def compliance_status(
    expiry_status: Column, approval_status: Column, is_required: Column, since_start: Column
) -> Column:
    return (
        F.when(~is_required, K.UNEXPECTED)
        .when(~approval_status.eqNullSafe(K.APPROVAL_APPROVED), K.NOT_APPROVED)
        .when(since_start < 0, K.NOT_STARTED)
        .when(expiry_status == K.EXPIRY_EXPIRED, K.EXPIRED)
        .when(expiry_status == K.EXPIRY_EXPIRING, K.EXPIRING)
        .otherwise(K.COMPLIANT)
    )


def compliance_flags(status: Column, has_number: Column) -> Column:
    by_status = F.lit(None).cast("string")
    for name, flag in K.FLAG_BY_STATUS.items():
        by_status = F.when(status == name, flag).otherwise(by_status)
    return F.array_compact(F.array(by_status, F.when(~has_number, K.FLAG_NO_NUMBER)))


# --- schedule ---------------------------------------------------------------


def weekday_number(text: Column) -> Column:
    """0 = Monday; any unknown name counts as Monday."""
    number = F.lit(0)
    for index, name in enumerate(K.WEEKDAYS):
        number = F.when(F.upper(text) == name, index).otherwise(number)
    return number


def clock_seconds(text: Column) -> Column:
    """Second of the day of ``HH:mm`` text; unreadable text means 09:00."""
    hours = F.substring(text, 1, 2).try_cast("int")
    minutes = F.substring(text, 4, 2).try_cast("int")
    seconds = F.coalesce(F.substring(text, 7, 2).try_cast("int"), F.lit(0))
    value = hours * 3600 + minutes * 60 + seconds
    return F.when(text.rlike(_CLOCK), value).otherwise(F.lit(DEFAULT_CLOCK_S))


# --- texts ------------------------------------------------------------------


def plain_body(
    user_name: Column, issue: Column, priority: Column, number: Column, expiry: Column, days: Column
) -> Column:
    """Plain-text alert; the days line stays, empty, when days are unknown."""

    def given(label: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(label), value), F.lit(label + "Not provided"))

    lines = [
        F.concat(F.lit("Dear "), user_name, F.lit(",")),
        F.lit(""),
        F.lit(K.BODY_INTRO),
        F.lit(""),
        F.concat(F.lit("Issue Type: "), issue),
        F.concat(F.lit("Priority: "), priority),
        F.lit(""),
        given("WWCC Number: ", number),
        given("Expiry Date: ", expiry),
        F.coalesce(F.concat(F.lit("Days until expiry: "), days.cast("string")), F.lit("")),
        F.lit(""),
        F.lit(K.BODY_ACTION),
        F.lit(""),
        F.lit(K.BODY_FOOTER),
    ]
    return F.concat_ws("\n", *lines)


def days_colour(days: Column) -> Column:
    colour = F.lit(K.DAYS_COLOUR_DEFAULT)
    for bound, name in reversed(K.DAYS_COLOURS):
        colour = F.when(days < bound, name).otherwise(colour)
    return colour


def issue_text(issue: Column) -> Column:
    """``struct<message,action,background,foreground>`` of an issue type."""

    def pack(row: Sequence[str]) -> Column:
        names = ("message", "action", "background", "foreground")
        return F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)])

    text = pack(K.ISSUE_TEXT_DEFAULT)
    for name, row in K.ISSUE_TEXT.items():
        text = F.when(issue == name, pack(row)).otherwise(text)
    return text
