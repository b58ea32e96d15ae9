"""The digest gate with its run log, and the day-long memory of statuses."""

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestal.operators import notify
from attestal.plans import flows
from attestal.sources.config import settings_from
from attestal.sources.published import BatchLog

DAY = 86_400_000_000
SLOT = {"enabled": True, "day_of_week": "MONDAY", "time": "09:00", "timezone": "UTC"}


def _runs(spark, times, logged=(), **changes):
    rows = [(i, datetime.datetime.fromisoformat(t)) for i, t in enumerate(times)]
    checks = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
    log = spark.createDataFrame([(d,) for d in logged], "localDate string")
    found = flows.digest_runs(checks, settings_from({"digest": SLOT | changes}), log, F.col("ts"), ["ts", "id"])
    return sorted((r.localDate, r.id) for r in found.collect())


def test_digest_runs(spark):
    times = ["2024-01-01T08:57:59", "2024-01-01T09:01:00", "2024-01-01T08:58:00", "2024-01-02T09:00:00", "2024-01-08T09:03:00"]
    assert _runs(spark, times) == [("2024-01-01", 2), ("2024-01-08", 4)]
    assert _runs(spark, times, ["2024-01-01", "2024-01-01"]) == [("2024-01-08", 4)]
    assert _runs(spark, times, enabled=False) == []
    assert _runs(spark, []) == []


def test_digests_go_out_once_a_day(spark, tmp_path):
    """A day is started by one batch, also where nobody has anything to read, and a repeated batch starts the same days."""
    log = BatchLog(str(tmp_path / "runs"), T.StructType.fromDDL("localDate string"))
    people = "userId string, compliance_status string, department string"
    latest = spark.createDataFrame([("u1", "EXPIRED", "IT"), ("u2", "COMPLIANT", "IT")], people)
    settings = settings_from({"digest": SLOT})

    def run(number, times, status=latest):
        rows = [(i, datetime.datetime.fromisoformat(t)) for i, t in enumerate(times)]
        checks = spark.createDataFrame(rows, "id int, ts timestamp_ntz")
        found = flows.run_digests(checks, status, settings, log, number, F.col("ts"), ["ts", "id"])
        return sorted((r.summaryDate, r.totalIssues) for r in found.collect())

    assert run(0, ["2024-01-01T07:00:00"]) == []
    assert run(1, ["2024-01-01T09:00:00", "2024-01-01T09:01:00"]) == [("2024-01-01", 1)]
    assert run(1, ["2024-01-01T09:00:00", "2024-01-01T09:01:00"]) == [("2024-01-01", 1)]
    assert run(2, ["2024-01-01T09:02:00", "2024-01-08T09:02:00"], latest.limit(0)) == []
    assert run(3, ["2024-01-08T09:02:30", "2024-01-15T09:00:00"]) == [("2024-01-15", 1)]
    assert sorted(r.localDate for r in log.read(spark).collect()) == ["2024-01-01", "2024-01-08", "2024-01-15"]


def test_body_falls_back_to_plain_text(spark):
    rows = [("n1", "Ada", "EXPIRED", True), ("n2", None, "EXPIRED", True), ("n3", "Ada", None, True), ("n4", "Ada", "EXPIRED", False)]
    commands = spark.createDataFrame(rows, "notificationId string, userName string, issueType string, isHtml boolean").selectExpr(
        "*", "'HIGH' AS priority", "'t' AS createdAt",
        "named_struct('wwccNumber', cast(null as string), 'expiryDate', cast(null as string), 'daysUntilExpiry', 3L) AS data",
    )
    bodies = {r.notificationId: r.body for r in notify.with_body(commands).collect()}
    assert bodies["n1"].startswith("<!DOCTYPE html>") and bodies["n4"].startswith("Dear Ada,")
    assert all(bodies[n] and "<" not in bodies[n] and "Days until expiry: 3" in bodies[n] for n in ("n2", "n3"))


def test_status_changes_ignore_processing_time_and_forget_after_a_day(spark):
    rows = [
        (0, 0, "EXPIRED", "a"),
        (1, DAY - 1, "EXPIRED", "b"),
        (2, DAY, "EXPIRED", "c"),
        (3, DAY + 1, None, "d"),
        (4, DAY + 2, None, "e"),
        (5, DAY + 3, "EXPIRED", "f"),
    ]
    columns = "id int, t long, compliance_status string, processedAt string"
    status = spark.createDataFrame(rows, columns).withColumn("userId", F.lit("u"))
    found = flows.status_changes(status, "t", ["id"])
    assert found.columns == status.columns
    assert sorted(r.id for r in found.collect()) == [0, 2, 3, 5]
