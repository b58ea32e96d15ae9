"""Frequency rules (first match wins) and the rules document (all matches count).

Both tables are configuration read once on the driver, so they become Column
expressions: no join, no row multiplied by the number of rules.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from attestal import constants as K
from attestal.functions.predicates import FrequencyRule, condition_holds

DEFAULT_INTERVAL_HOURS = 24


def first_rule(rules: Sequence[FrequencyRule], days: Column) -> Column:
    """``struct<ord,name,interval_hours>`` of the first rule that holds, else null."""
    found = F.lit(None)
    for ordinal, rule in reversed(list(enumerate(rules))):
        row = F.struct(
            F.lit(ordinal).alias("ord"),
            F.lit(rule.name).alias("name"),
            F.lit(rule.interval_hours).alias("interval_hours"),
        )
        found = F.when(condition_holds(rule.condition, days), row).otherwise(found)
    return found.cast("struct<ord:int,name:string,interval_hours:int>")


def interval_seconds(rules: Sequence[FrequencyRule], days: Column, default_hours: int = DEFAULT_INTERVAL_HOURS) -> Column:
    """Notification interval of the first rule that holds."""
    hours = F.lit(default_hours)
    for rule in reversed(list(rules)):
        hours = F.when(condition_holds(rule.condition, days), F.lit(rule.interval_hours)).otherwise(hours)
    return (hours * 3600).cast("long")


def rule_condition(conditions: Row | Mapping) -> Column:
    """Every condition given must hold; an unknown value fails a condition."""
    get = conditions.asDict().get if isinstance(conditions, Row) else conditions.get
    tests = [F.lit(True)]
    if get("compliance_statuses") is not None:
        tests.append(F.col("compliance_status").isin(*get("compliance_statuses")))
    if get("flags_any") is not None:
        wanted = F.array(*[F.lit(f) for f in get("flags_any")]).cast("array<string>")
        tests.append(F.arrays_overlap(F.col("flags"), wanted))
    if get("flags_all") is not None:
        wanted = F.array(*[F.lit(f) for f in get("flags_all")]).cast("array<string>")
        tests.append(F.size(F.array_except(wanted, F.col("flags"))) == 0)
    if get("days_until_expiry_less_than") is not None:
        tests.append(F.col("daysUntilExpiry") < get("days_until_expiry_less_than"))
    if get("days_since_start_greater_than") is not None:
        tests.append(F.col("daysSinceStart") > get("days_since_start_greater_than"))
    holds = tests[0]
    for test in tests[1:]:
        holds = holds & F.coalesce(test, F.lit(False))
    return holds


#: What a rule that holds adds to a row.
HIT = (
    "struct<ruleId:string,rulePriority:string,ruleIssueType:string,ruleTemplate:string,"
    "notifyEmployee:boolean,notifyManager:boolean,notifyComplianceTeam:boolean>"
)


def evaluate_rules(status: DataFrame, rules: Iterable[Row]) -> DataFrame:
    """One row per status row and enabled rule that holds; no rows where no rule is enabled."""
    hits = []
    for rule in rules:
        if not rule["enabled"]:
            continue
        note = rule["notification"]
        hit = F.struct(
            F.lit(rule["ruleId"]).alias("ruleId"),
            F.lit(note["priority"]).alias("rulePriority"),
            F.lit(note["issue_type"]).alias("ruleIssueType"),
            F.lit(note["template"]).alias("ruleTemplate"),
            F.lit(note["notify_employee"]).alias("notifyEmployee"),
            F.lit(note["notify_manager"]).alias("notifyManager"),
            F.lit(note["notify_compliance_team"]).alias("notifyComplianceTeam"),
        )
        hits.append(F.when(rule_condition(rule["conditions"]), hit))
    found = F.array_compact(F.array(*hits)) if hits else F.array()
    return status.withColumn("__hit", F.explode(found.cast(f"array<{HIT}>"))).select(*status.columns, "__hit.*")


def with_manager(df: DataFrame, managers: DataFrame, default_manager: str, out: str = "manager") -> DataFrame:
    """Left join on department; unknown departments go to the default manager."""
    table = managers.select("department", F.col("manager").alias(out))
    return df.join(table, "department", "left").withColumn(out, F.coalesce(out, F.lit(default_manager)))


def rule_recipients(matches: DataFrame, managers: DataFrame, default_manager: str, compliance_email: str) -> DataFrame:
    """One row per rule match and address it notifies."""

    def address(wanted: str, role: str, value: Column) -> Column:
        pair = F.struct(F.lit(role).alias("role"), value.alias("recipient"))
        return F.when(F.col(wanted) & value.isNotNull(), pair)

    named = matches.withColumn("department", F.coalesce("department", F.lit(K.UNKNOWN_DEPARTMENT)))
    fan_out = F.array_compact(
        F.array(
            address("notifyEmployee", "employee", F.col("email")),
            address("notifyManager", "manager", F.col("manager")),
            address("notifyComplianceTeam", "compliance_team", F.lit(compliance_email)),
        )
    )
    joined = with_manager(named, managers, default_manager).withColumn("__to", F.explode(fan_out))
    return joined.select("userId", "compliance_status", "ruleId", "rulePriority", "__to.*")
