"""End-to-end compositions of the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal import constants as K
from attestal import schemas
from attestal.functions import scalar as S
from attestal.functions.predicates import digest_due, local_time, should_notify
from attestal.operators import classify, dedup, digest, notify
from attestal.operators.throttle import HOT_ROWS
from attestal.sources.config import Settings, managers_table
from attestal.sources.published import BatchLog


def compliance(credentials: DataFrame, required: DataFrame, as_of: Column, processed_at: Column) -> DataFrame:
    """Status rows of all children-check credentials and of people without one."""
    return classify.all_statuses(classify.children_checks(credentials), required, as_of, processed_at)


def compliance_counts(status: DataFrame) -> DataFrame:
    """People by department and status."""
    return status.groupBy(F.coalesce("department", F.lit(K.UNKNOWN_DEPARTMENT)).alias("department"), "compliance_status").agg(
        F.count(F.lit(1)).alias("people")
    )


def status_changes(status: DataFrame, time_us: str, tie: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Status rows that tell something new about their person, and unchanged ones a day after they last went out.

    The fingerprint leaves out the processing time, which differs on every run.
    """
    told = [f.name for f in schemas.STATUS.fields if f.name != "processedAt" and f.name in status.columns]
    marked = status.withColumn("__told", S.fingerprint([(c, F.col(c)) for c in told]))
    rows = dedup.change_filter_ttl(marked, ["userId"], time_us, tie, "__told", K.STATUS_TTL_S, hot_rows=hot_rows)
    return rows.drop("__told")


def notifications(
    status: DataFrame, settings: Settings, time_us: str, tie: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Alert commands that pass the frequency rules of their own record."""
    due = dedup.cooldown_by_rules(
        status.filter(should_notify(F.col("compliance_status"))),
        ["userId", "compliance_status"],
        time_us,
        tie,
        settings.frequency_rules,
        F.col("daysUntilExpiry"),
        hot_rows=hot_rows,
    )
    return notify.alert_commands(due, settings)


def digests(latest: DataFrame, settings: Settings, summary_date: str) -> DataFrame:
    """One digest row per manager over everyone's latest status (``dedup.latest_per_key``)."""
    managers = managers_table(latest.sparkSession, settings)
    return digest.manager_digest(digest.department_summary(latest), managers, settings.default_manager, summary_date)


def digest_runs(checks: DataFrame, settings: Settings, run_log: DataFrame, utc: Column, order: Sequence[str]) -> DataFrame:
    """Checks that start a digest, with their ``localDate``: the first due one of each local day not in the run log.

    No row where digests are switched off. The rows are to be appended to the
    run log, also for a day on which no manager has anything to read.
    """
    plan = settings.digest
    due = F.lit(plan.enabled) & digest_due(utc, plan.day_of_week, plan.time, plan.timezone)
    dated = checks.filter(due).withColumn("localDate", F.to_date(local_time(utc, plan.timezone)).cast("string"))
    fresh = dated.join(run_log.select("localDate"), "localDate", "left_anti")
    return dedup.first_per_key(fresh, ["localDate"], order)


def run_digests(
    checks: DataFrame, latest: DataFrame, settings: Settings, log: BatchLog, number: int, utc: Column, order: Sequence[str]
) -> DataFrame:
    """Digests of the days that the checks of a batch start, and of no others; none where no check is due.

    The days are in the run log before anything goes out, also days on which no
    manager has anything to read, so none is started twice. The same batch,
    repeated, starts the same days. One date for each started day comes to the driver.
    """
    spark = checks.sparkSession
    runs = digest_runs(checks, settings, log.read(spark, number), utc, order)
    log.append(runs, number)
    started = log.read(spark, number + 1).join(log.read(spark, number), "localDate", "left_anti")
    days = sorted(r["localDate"] for r in started.select("localDate").distinct().collect())
    none = digests(latest, settings, "").limit(0)
    return reduce(DataFrame.unionByName, [digests(latest, settings, day) for day in days], none)


def deliveries(commands: DataFrame, failures: DataFrame, time_us: str, tie: Sequence[str], sent_at: Column) -> DataFrame:
    """Delivery events of commands, each id processed once."""
    return notify.delivery_events(dedup.once_per_id(commands, "notificationId", time_us, tie), failures, sent_at)


def open_notifiable(latest: DataFrame) -> DataFrame:
    """Everyone whose latest status calls for a notification: the open issues."""
    return latest.filter(should_notify(F.col("compliance_status")))
