"""Known answers for dates, names, statuses, flags, texts and schedules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from attestal.functions import predicates as P
from attestal.functions import scalar as S

DATE = "d struct<year:int,month:int,day:int>"


def column(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_expiry_text(spark):
    rows = [((2025, 12, 31),), ((2025, 1, 5),), ((2024, 2, 30),), (None,)]
    assert column(spark, rows, DATE, S.expiry_text(F.col("d"))) == ["2025-12-31", "2025-01-05", "2024-02-30", None]


def test_days_until_expiry(spark):
    cases = [
        ((2024, 1, 31), "2024-01-01", 30),
        ((2024, 1, 1), "2024-02-01", -31),
        ((2024, 5, 5), "2024-05-05", 0),
        ((2024, 12, 31), "2024-01-01", 365),
        (None, "2024-01-01", None),
        ((2024, 2, 30), "2024-01-01", None),
    ]
    rows = [(d, dt.date.fromisoformat(a)) for d, a, _ in cases]
    got = column(spark, rows, DATE + ", a date", S.days_until_expiry(F.col("d"), F.col("a")))
    assert got == [want for *_, want in cases]


@pytest.mark.parametrize(
    "start,as_of,want",
    [
        ("2024-01-01", "2024-02-01", 31),
        ("2024-02-01", "2024-01-01", -31),
        ("invalid-date", "2024-01-01", None),
        ("2024-2-3", "2024-01-01", None),
        (" 2024-02-03", "2024-01-01", None),
        ("2023-02-29", "2024-01-01", None),
        (None, "2024-01-01", None),
    ],
)
def test_days_since_start(spark, start, as_of, want):
    rows = [(start, dt.date.fromisoformat(as_of))]
    assert column(spark, rows, "s string, a date", S.days_since_start(F.col("s"), F.col("a"))) == [want]


def test_compliance_status(spark):
    cases = [
        ("EXPIRED", "APPROVED", True, 100, "EXPIRED"),
        ("EXPIRING_SOON", "APPROVED", True, 100, "EXPIRING"),
        ("VALID", "PENDING", True, 100, "NOT_APPROVED"),
        ("VALID", "APPROVED", False, 100, "UNEXPECTED"),
        ("VALID", "APPROVED", True, -10, "NOT_STARTED"),
        ("VALID", "APPROVED", True, 100, "COMPLIANT"),
        ("EXPIRED", "APPROVED", False, 100, "UNEXPECTED"),
        ("EXPIRED", "PENDING", True, 100, "NOT_APPROVED"),
        ("EXPIRED", "APPROVED", True, -5, "NOT_STARTED"),
        ("EXPIRED", "APPROVED", True, None, "EXPIRED"),
        ("OTHER", "APPROVED", True, None, "COMPLIANT"),
    ]
    rows = [(f"EXPIRY_STATUS_{e}", f"DOCUMENT_APPROVAL_STATUS_{a}", r, d) for e, a, r, d, _ in cases]
    expr = S.compliance_status(F.col("e"), F.col("a"), F.col("r"), F.col("d"))
    assert column(spark, rows, "e string, a string, r boolean, d long", expr) == [c[-1] for c in cases]


def test_flags(spark):
    cases = [
        ("EXPIRED", True, ["WWCC_EXPIRED"]),
        ("EXPIRING", True, ["EXPIRING_WITHIN_30_DAYS"]),
        ("UNEXPECTED", True, ["NOT_IN_REQUIRED_LIST"]),
        ("NOT_APPROVED", True, ["APPROVAL_PENDING"]),
        ("NOT_STARTED", True, ["NOT_YET_STARTED"]),
        ("COMPLIANT", True, []),
        ("COMPLIANT", False, ["NO_CREDENTIAL_NUMBER"]),
        ("EXPIRED", False, ["WWCC_EXPIRED", "NO_CREDENTIAL_NUMBER"]),
    ]
    got = column(spark, [c[:2] for c in cases], "s string, n boolean", S.compliance_flags(F.col("s"), F.col("n")))
    assert got == [c[-1] for c in cases]


def test_name_key_strips_all_control_blanks(spark):
    rows = [("\t Mary-Jane \n",), ("mary-jane",), ("",)]
    assert column(spark, rows, "n string", S.name_key(F.col("n"))) == ["mary-jane", "mary-jane", ""]


def test_fingerprint_reads_null_as_empty_and_keeps_fields_apart(spark):
    rows = [("a", None), ("a", ""), ("a|b", "c"), ("a", "b|c")]
    got = column(spark, rows, "x string, y string", S.fingerprint([("x", F.col("x")), ("y", F.col("y"))]))
    assert got[0] == got[1]
    assert got[2] != got[3]


def test_keys(spark):
    row = spark.range(1).select(
        S.last_notification_key(F.lit("user123"), F.lit("EXPIRED")), S.sent_key(F.lit("id-1")), S.credential_key(F.lit("u"), F.lit("d"))
    ).first()
    assert tuple(row) == ("notification:last:user123:EXPIRED", "notification:sent:id-1", "sc:credential:u:d")


def test_manager_name(spark):
    got = column(spark, [("john.doe@example.com",), ("nobody",)], "m string", S.manager_display_name(F.col("m")))
    assert got == ["john.doe", "Manager"]


def test_plain_body(spark):
    rows = [("Ann Lee", "EXPIRED", "HIGH", "W1", "2024-01-01", -5), ("", "MISSING", "HIGH", None, None, None)]
    schema = "u string, i string, p string, n string, e string, d long"
    full, bare = column(spark, rows, schema, S.plain_body(*[F.col(c) for c in "uipned"]))
    assert full.startswith("Dear Ann Lee,\n")
    assert "WWCC Number: W1\nExpiry Date: 2024-01-01\nDays until expiry: -5\n" in full
    assert bare.startswith("Dear ,")
    assert "WWCC Number: Not provided\nExpiry Date: Not provided\n\n\nPlease" in bare
    assert "Days until" not in bare


def test_colours(spark):
    days = [(-5,), (5,), (7,), (14,), (20,), (30,), (60,), (None,)]
    want = ["#dc3545", "#fd7e14", "#fd7e14", "#ffc107", "#ffc107", "#28a745", "#28a745", "#28a745"]
    assert column(spark, days, "d long", S.days_colour(F.col("d"))) == want
    kinds = [("EXPIRED",), ("MISSING",), ("EXPIRING",), ("NOT_APPROVED",), ("OTHER",)]
    got = column(spark, kinds, "k string", S.issue_text(F.col("k")))
    assert [(g["background"], g["foreground"]) for g in got] == [
        ("#dc3545", "#ffffff"),
        ("#dc3545", "#ffffff"),
        ("#fd7e14", "#ffffff"),
        ("#ffc107", "#212529"),
        ("#6c757d", "#ffffff"),
    ]


def test_schedule(spark):
    days = column(spark, [("monday",), ("Sunday",), ("INVALID",)], "w string", S.weekday_number(F.col("w")))
    assert days == [0, 6, 0]
    texts = [("14:30",), ("23:59",), ("invalid",), ("25:00",), ("09:00:30",), ("9:00",)]
    assert column(spark, texts, "t string", S.clock_seconds(F.col("t"))) == [52200, 86340, 32400, 32400, 32430, 32400]


@pytest.mark.parametrize(
    "local,last,want",
    [
        ("2024-12-23 08:57", None, False),
        ("2024-12-23 08:58", None, True),
        ("2024-12-23 09:00", None, True),
        ("2024-12-23 09:03", None, True),
        ("2024-12-23 09:04", None, False),
        ("2024-12-24 09:00", None, False),
        ("2024-12-23 09:00", "2024-12-23", False),
        ("2024-12-23 09:00", "2024-12-22", True),
    ],
)
def test_digest_due(spark, local, last, want):
    utc = dt.datetime.fromisoformat(local) - dt.timedelta(hours=11)
    expr = P.digest_due(F.col("t"), "monday", "09:00", "Australia/Sydney", F.col("last"))
    assert column(spark, [(utc, last)], "t timestamp_ntz, last string", expr) == [want]


def test_digest_due_follows_daylight_saving(spark):
    winter = dt.datetime(2024, 7, 1, 9, 0) - dt.timedelta(hours=10)
    expr = P.digest_due(F.col("t"), "MONDAY", "09:00", "Australia/Sydney")
    assert column(spark, [(winter,), (winter - dt.timedelta(hours=1),)], "t timestamp_ntz", expr) == [True, False]


def test_filters(spark):
    names = ["Working With Children Check", "Children's Services Credential", "Driver License", "First Aid Certificate"]
    got = column(spark, [(n,) for n in names], "n string", P.is_children_check(F.col("n")))
    assert got == [True, True, False, False]
    kinds = ["EXPIRED", "EXPIRING", "MISSING", "NOT_APPROVED", "COMPLIANT", "UNEXPECTED", "NOT_STARTED"]
    assert column(spark, [(k,) for k in kinds], "k string", P.should_notify(F.col("k"))) == [True] * 4 + [False] * 3
    assert column(spark, [(k,) for k in kinds], "k string", P.is_non_compliant(F.col("k"))) == [True] * 4 + [False, True, True]
