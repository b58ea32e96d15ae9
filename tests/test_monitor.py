"""Counts, lag, rates, liveness, test logs."""

import datetime as dt

from pyspark.sql import functions as F

from attestal.operators import monitor as M

T0 = dt.datetime(2024, 1, 1, 12, 0)


def log(spark):
    rows = [("raw", p, o, T0 + dt.timedelta(seconds=20 * o)) for p in (0, 1) for o in range(5)] + [("status", 0, 0, T0)]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, ts timestamp_ntz")


def test_counts_and_reconcile(spark):
    counts = M.topic_counts(log(spark))
    assert {r["topic"]: r["messages"] for r in counts.collect()} == {"raw": 10, "status": 1}
    checked = M.reconcile(counts, {"raw": 10, "issues": 4})
    assert {r["topic"]: r["result"] for r in checked.collect()} == {"raw": "OK", "issues": "FAIL", "status": "INFO"}
    assert M.failure_total(checked).first()["failures"] == 1


def test_lag_levels(spark):
    df = spark.createDataFrame([(n,) for n in (0, 9, 10, 99, 100)], "n long")
    assert [r[0] for r in df.select(M.lag_level(F.col("n"))).collect()] == ["ok", "ok", "warn", "warn", "fail"]


def test_consumer_lag_by_group_pattern(spark):
    committed = spark.createDataFrame(
        [("reader-1", "raw", 0, 5), ("reader-1", "raw", 1, 2), ("other", "raw", 0, 0)],
        "consumer_group string, topic string, partition int, committed long",
    )
    got = M.consumer_lag(log(spark), committed, "reader.*").collect()
    assert [(r["consumer_group"], r["lag"], r["level"]) for r in got] == [("reader-1", 3, "ok")]


def test_rate_and_liveness(spark):
    rate = {(r["topic"], r["minute"].minute): r["messages"] for r in M.message_rate(log(spark)).collect()}
    assert rate == {("raw", 0): 6, ("raw", 1): 4, ("status", 0): 1}
    beats = spark.createDataFrame([("a", T0), ("b", T0 - dt.timedelta(hours=1))], "consumer_group string, ts timestamp_ntz")
    got = {r["consumer_group"]: r["alive"] for r in M.liveness(beats, F.lit(T0).cast("timestamp_ntz")).collect()}
    assert got == {"a": True, "b": False}


def test_log_formats(spark):
    logs = {
        "summary": ["x 3", "Tests: succeeded 33, failed 2, canceled 0"],
        "total": ["Total number of tests run: 10", "it failed 1 time"],
        "zeroes": ["Tests: succeeded 0, failed 0", "Total number of tests run: 4"],
        "words": ["12 passed", "3 errors"],
        "first": ["Tests: succeeded 1, failed 0", "Tests: succeeded 9, failed 9"],
        "none": ["No tests found"],
    }
    rows = [(k, i, line) for k, lines in logs.items() for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "run string, n int, line string").repartition(4)
    got = {r["run"]: (r["passed"], r["failed"]) for r in M.parse_test_logs(df, ["run"], "n", "line").collect()}
    assert got == {"summary": (33, 2), "total": (9, 1), "zeroes": (4, 0), "words": (12, 3), "first": (1, 0), "none": (0, 0)}


def test_log_panels(spark):
    rows = [("poller", "x ERROR y", 1), ("poller", "fine", 2), ("db", "ERROR", 3), ("router", "WARN", 4)]
    df = spark.createDataFrame(rows, "container string, line string, at int")
    assert sorted(r["at"] for r in M.log_errors(df, ["poller", "router"]).collect()) == [1, 4]
    assert [r["at"] for r in M.recent_activity(df, ["at"], 2).collect()] == [4, 3]


def test_sample_is_the_first_message(spark):
    got = {r["topic"]: (r["partition"], r["offset"]) for r in M.topic_sample(log(spark)).collect()}
    assert got == {"raw": (0, 0), "status": (0, 0)}


def test_poll_counters(spark):
    df = spark.createDataFrame([(1, True), (1, False), (1, False), (2, True)], "p int, changed boolean")
    assert {r["poll"]: (r["changed"], r["unchanged"]) for r in M.poll_counters(df, F.col("p")).collect()} == {1: (1, 2), 2: (1, 0)}
