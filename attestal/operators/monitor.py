"""Pipeline health: topic counts, lag, rates, liveness, test and log reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal import constants as K
from attestal.functions.predicates import severity_lines


def poll_counters(marked: DataFrame, poll: Column, changed: str = "changed") -> DataFrame:
    """New-or-changed and unchanged rows of each poll."""
    return marked.groupBy(poll.alias("poll")).agg(
        F.count_if(F.col(changed)).alias("changed"), F.count_if(~F.col(changed)).alias("unchanged")
    )


def end_offsets(log: DataFrame) -> DataFrame:
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))


def topic_counts(log: DataFrame) -> DataFrame:
    """Messages per topic, by end offsets."""
    return end_offsets(log).groupBy("topic").agg(F.sum("end_offset").alias("messages"))


def reconcile(counts: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """Expected against actual counts; topics without an expectation are INFO."""
    spark = counts.sparkSession
    table = spark.createDataFrame(list(expected.items()), "topic string, expected long")
    joined = table.join(counts, "topic", "full").select(
        "topic", "expected", F.coalesce("messages", F.lit(0)).alias("actual")
    )
    verdict = (
        F.when(F.col("expected").isNull(), "INFO").when(F.col("expected") == F.col("actual"), "OK").otherwise("FAIL")
    )
    return joined.withColumn("result", verdict)


def failure_total(reconciled: DataFrame) -> DataFrame:
    return reconciled.agg(F.count_if(F.col("result") == "FAIL").alias("failures"))


def lag_level(lag: Column) -> Column:
    return F.when(lag < K.LAG_WARN, "ok").when(lag < K.LAG_FAIL, "warn").otherwise("fail")


def consumer_lag(log: DataFrame, committed: DataFrame, group_pattern: str = ".*") -> DataFrame:
    """Records not yet read by each consumer group whose whole name matches."""
    groups = committed.filter(F.col("consumer_group").rlike(f"^(?:{group_pattern})$"))
    lag = (F.col("end_offset") - F.col("committed")).cast("long")
    return (
        groups.join(end_offsets(log), ["topic", "partition"])
        .groupBy("consumer_group")
        .agg(F.sum(F.greatest(lag, F.lit(0))).alias("lag"))
        .withColumn("level", lag_level(F.col("lag")))
    )


def message_rate(log: DataFrame, ts: str = "ts", width: str = "1 minute") -> DataFrame:
    """Messages per topic and minute."""
    return log.groupBy("topic", F.window(ts, width).alias("w")).agg(F.count(F.lit(1)).alias("messages")).select(
        "topic", F.col("w.start").alias("minute"), "messages"
    )


def liveness(heartbeats: DataFrame, since: Column, ts: str = "ts") -> DataFrame:
    """Whether each group showed a member at or after ``since``."""
    return heartbeats.groupBy("consumer_group").agg(
        F.count_if(F.col(ts) >= since).alias("members"), (F.count_if(F.col(ts) >= since) > 0).alias("alive")
    )


def test_totals(metrics: DataFrame) -> DataFrame:
    """Passed and failed tests per service, with the latest run of each."""
    return metrics.groupBy("service").agg(
        F.sum(F.when(F.col("status") == "passed", F.col("tests")).otherwise(0)).alias("passed"),
        F.sum(F.when(F.col("status") == "failed", F.col("tests")).otherwise(0)).alias("failed"),
        F.max("run_ts").alias("last_run_ts"),
        F.max_by("duration_s", F.struct("run_ts", "duration_s")).alias("last_duration_s"),
    )


def test_grand_total(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("status").agg(F.sum("tests").alias("tests"))


# --- test logs ---------------------------------------------------------------


def _number(text: Column, pattern: str) -> Column:
    """First integer the pattern captures, null if there is none."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("long")


def parse_test_logs(lines: DataFrame, keys: Sequence[str], line_no: str, line: str) -> DataFrame:
    """Passed and failed test counts per log.

    Tried in order, the next one only while both counts are still zero: the
    summary line, the total line less failures, any line that says passed or
    failed. Each step reads the first line that matches.
    """
    text = F.col(line)

    def first(matches: Column, value: Column) -> Column:
        """Value on the first matching line; two numbers of state, so it hashes."""
        return F.min_by(value, F.when(matches, F.col(line_no).cast("long")))

    summary = text.contains("Tests: succeeded")
    totals = text.rlike("(?i)Total number of tests run:")
    any_number = _number(text, "([0-9]+)")
    found = lines.groupBy(*keys).agg(
        first(summary, _number(text, "succeeded ([0-9]+)")).alias("s_pass"),
        first(summary, _number(text, "failed ([0-9]+)")).alias("s_fail"),
        F.max(totals).alias("has_total"),
        first(totals, any_number).alias("t_all"),
        first(text.rlike("(?i)failed [0-9]"), _number(text, "failed ([0-9]+)")).alias("t_fail"),
        first(text.rlike("(?i)passed|succeeded") & any_number.isNotNull(), any_number).alias("g_pass"),
        first(text.rlike("(?i)failed|errors") & any_number.isNotNull(), any_number).alias("g_fail"),
    )

    def n(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("long"))

    def pair(passed: Column, failed: Column) -> Column:
        return F.struct(passed.alias("passed"), failed.alias("failed"))

    zero = F.lit(0).cast("long")
    by_summary = pair(n("s_pass"), n("s_fail"))
    by_total = F.when(F.col("has_total"), pair(n("t_all") - n("t_fail"), n("t_fail"))).otherwise(pair(zero, zero))
    by_word = pair(n("g_pass"), n("g_fail"))

    def empty(result: Column) -> Column:
        return (result["passed"] == 0) & (result["failed"] == 0)

    chosen = F.when(~empty(by_summary), by_summary).when(~empty(by_total), by_total).otherwise(by_word)
    return found.withColumn("__r", chosen).select(*keys, "__r.passed", "__r.failed")


# --- logs and samples ---------------------------------------------------------


def log_errors(logs: DataFrame, containers: Sequence[str]) -> DataFrame:
    return logs.filter(severity_lines(F.col("container"), F.col("line"), containers))


def recent_activity(logs: DataFrame, order: Sequence[str], limit: int) -> DataFrame:
    """Newest rows of an activity panel; the limit is the panel's size."""
    return logs.orderBy(*[F.col(c).desc() for c in order]).limit(limit)


def topic_sample(log: DataFrame) -> DataFrame:
    """The first message of every topic."""
    row = F.struct(*log.columns)
    return log.groupBy("topic").agg(F.min_by(row, F.struct("ts", "partition", "offset")).alias("r")).select("r.*")
