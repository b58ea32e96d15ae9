"""Frequency conditions, intervals, the rules document and settings."""

import pytest
from pyspark.sql import functions as F

from attestal.functions.predicates import FrequencyRule, condition_holds, parse_condition
from attestal.operators import rules as R
from attestal.sources import readers
from attestal.sources.config import (
    SAMPLE_RULES,
    SAMPLE_SETTINGS,
    Settings,
    invalid_rules,
    load_settings,
    settings_from,
)

RULES = [
    FrequencyRule("past", "days_until_expiry < 0", 24),
    FrequencyRule("week", "days_until_expiry <= 7", 24),
    FrequencyRule("fortnight", "days_until_expiry <= 14", 72),
    FrequencyRule("rest", "always", 168),
]


def evaluate(spark, days, expr):
    return [r[0] for r in spark.createDataFrame([(d,) for d in days], "d long").select(expr).collect()]


@pytest.mark.parametrize(
    "text,days,want",
    [
        ("always", [5, None], [True, True]),
        ("days_until_expiry < 0", [-5, 0, 5, None], [True, False, False, False]),
        ("days_until_expiry <= 7", [5, 7, 8, None], [True, True, False, False]),
        ("days_until_expiry >= 7", [6, 7, None], [False, True, False]),
        ("days_until_expiry > 7", [7, 8, None], [False, True, False]),
        ("days_until_expiry == 7", [7], [False]),
        ("days_until_expiry <= soon", [7], [False]),
        ("something else", [7], [False]),
    ],
)
def test_condition(spark, text, days, want):
    assert evaluate(spark, days, condition_holds(text, F.col("d"))) == want


def test_parse_takes_the_last_operand():
    assert parse_condition("days_until_expiry <= 3 <= 9").bound == 9
    assert parse_condition("days_until_expiry <=-2 ").bound == -2


def test_interval(spark):
    got = evaluate(spark, [-5, 5, 10, 30, None], R.interval_seconds(RULES, F.col("d")))
    assert got == [86400, 86400, 259200, 604800, 604800]
    assert evaluate(spark, [3], R.interval_seconds([], F.col("d"))) == [86400]


def test_first_rule_wins(spark):
    got = evaluate(spark, [-5, 5, 10, None], R.first_rule(RULES, F.col("d")))
    assert [(g["ord"], g["name"]) for g in got] == [(0, "past"), (1, "week"), (2, "fortnight"), (3, "rest")]
    assert evaluate(spark, [5], R.first_rule(RULES[:1], F.col("d"))) == [None]


def status_rows(spark):
    rows = [
        ("u1", "EXPIRED", ["WWCC_EXPIRED", "NO_CREDENTIAL_NUMBER"], -3, 10, "a@example.org", "BUILDING"),
        ("u2", "EXPIRING", ["EXPIRING_WITHIN_30_DAYS"], 6, 10, "b@example.org", "MACHINERY"),
        ("u3", "EXPIRING", ["EXPIRING_WITHIN_30_DAYS"], None, 10, None, None),
        ("u4", "MISSING", ["NO_CREDENTIAL_FOUND", "MISSING_REQUIRED_WWCC"], None, 0, "d@example.org", "BUILDING"),
        ("u5", "MISSING", ["NO_CREDENTIAL_FOUND"], None, 1, "e@example.org", "BUILDING"),
        ("u6", "COMPLIANT", ["NO_CREDENTIAL_NUMBER"], 90, 10, "f@example.org", "BUILDING"),
    ]
    schema = (
        "userId string, compliance_status string, flags array<string>, daysUntilExpiry long, daysSinceStart long,"
        " email string, department string"
    )
    return spark.createDataFrame(rows, schema)


def test_rules_document(spark):
    hits = R.evaluate_rules(status_rows(spark), readers.load_rules(spark, SAMPLE_RULES))
    got = sorted((r["userId"], r["ruleId"]) for r in hits.collect())
    assert got == [("u1", "unnumbered-lapse"), ("u2", "plan-renewal"), ("u2", "ten-days-left")]


def test_no_enabled_rule_gives_no_rows(spark):
    off = [r for r in readers.load_rules(spark, SAMPLE_RULES) if not r["enabled"]]
    for rules in (off, []):
        hits = R.evaluate_rules(status_rows(spark), rules)
        assert hits.count() == 0 and {"ruleId", "notifyManager"} <= set(hits.columns)


def test_whole_range_of_thresholds():
    from attestal.functions.predicates import parse_condition

    assert parse_condition("days_until_expiry < 2147483647").bound == 2147483647
    assert parse_condition("days_until_expiry < 2147483648") is None


def test_rule_recipients(spark):
    hits = R.evaluate_rules(status_rows(spark), readers.load_rules(spark, SAMPLE_RULES))
    managers = spark.createDataFrame([("BUILDING", "boss@example.org")], "department string, manager string")
    got = R.rule_recipients(hits, managers, "hr@example.org", "team@example.org").collect()
    pairs = sorted((r["userId"], r["ruleId"], r["role"], r["recipient"]) for r in got if r["userId"] in ("u1", "u2"))
    assert pairs == [
        ("u1", "unnumbered-lapse", "compliance_team", "team@example.org"),
        ("u1", "unnumbered-lapse", "manager", "boss@example.org"),
        ("u2", "plan-renewal", "employee", "b@example.org"),
        ("u2", "ten-days-left", "compliance_team", "team@example.org"),
        ("u2", "ten-days-left", "employee", "b@example.org"),
    ]


def test_rules_table_scan(spark):
    table = readers.read_rules(spark, SAMPLE_RULES)
    assert table.filter("enabled").count() == 7
    assert table.first()["default_compliance_email"] == "compliance@example.org"


def test_settings_defaults(tmp_path):
    plan = load_settings(str(tmp_path / "absent.yaml"))
    assert plan == Settings()
    assert plan.issue_types["EXPIRED"].priority == "HIGH"
    assert (plan.digest.enabled, plan.digest.day_of_week, plan.digest.time) == (False, "MONDAY", "09:00")


def test_settings_partial_document():
    plan = settings_from({"settings": {"override_recipient": None}, "issue_types": {"X": {}}, "frequency_rules": [{}]})
    assert plan.override_recipient is None
    assert (plan.issue_types["X"].priority, plan.issue_types["X"].template) == ("MEDIUM", "individual-alert.html")
    rule = plan.frequency_rules[0]
    assert (rule.name, rule.condition, rule.interval_hours) == ("", "always", 24)
    assert plan.default_manager == "" and plan.cc_recipients == ()


def test_sample_settings():
    plan = load_settings(SAMPLE_SETTINGS)
    assert len(plan.frequency_rules) == 6 and invalid_rules(plan) == []
    assert plan.digest.enabled


def test_bad_rules_are_reported():
    plan = settings_from({"frequency_rules": [{"condition": "days_until_expiry <= soon"}, {"condition": "always"}]})
    assert [r.condition for r in invalid_rules(plan)] == ["days_until_expiry <= soon"]
