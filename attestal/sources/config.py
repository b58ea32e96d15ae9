"""Notification settings: one YAML file, read once on the driver."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from attestal import constants as K
from attestal.functions.predicates import FrequencyRule, parse_condition

CONF = Path(__file__).resolve().parent.parent / "conf"
SAMPLE_SETTINGS = str(CONF / "settings.yaml")
SAMPLE_RULES = str(CONF / "rules.json")


@dataclass(frozen=True)
class IssueType:
    priority: str = K.PRIORITY_MEDIUM
    template: str = "individual-alert.html"


@dataclass(frozen=True)
class DigestSchedule:
    enabled: bool = False
    day_of_week: str = "MONDAY"
    time: str = "09:00"
    timezone: str = "Australia/Sydney"


def _default_issue_types() -> dict[str, IssueType]:
    high, medium = IssueType(K.PRIORITY_HIGH, K.ALERT_TEMPLATE), IssueType(K.PRIORITY_MEDIUM, K.ALERT_TEMPLATE)
    return {K.EXPIRED: high, K.EXPIRING: medium, K.MISSING: high, K.NOT_APPROVED: medium}


@dataclass(frozen=True)
class Settings:
    """All settings; a fresh instance holds the defaults used without a file.

    ``dedup_ttl_hours`` is carried for completeness: the memory of a sent
    notification lives ``constants.COOLDOWN_TTL_S`` whatever it says.
    """

    dedup_ttl_hours: int = 24
    override_recipient: str | None = None
    cc_recipients: tuple[str, ...] = ()
    issue_types: Mapping[str, IssueType] = field(default_factory=_default_issue_types)
    frequency_rules: tuple[FrequencyRule, ...] = ()
    department_managers: Mapping[str, str] = field(default_factory=dict)
    default_manager: str = ""
    digest: DigestSchedule = DigestSchedule()


def settings_from(data: Mapping) -> Settings:
    """Settings of a parsed document, defaults where a key is absent."""
    general = data.get("settings") or {}
    override = general.get("override_recipient")
    digest = data.get("digest") or {}
    base, plan = Settings(), DigestSchedule()
    return Settings(
        dedup_ttl_hours=int(general.get("dedup_ttl_hours", base.dedup_ttl_hours)),
        override_recipient=None if override is None else str(override),
        cc_recipients=tuple(data.get("cc_recipients") or ()),
        issue_types={
            name: IssueType(str(row.get("priority", IssueType.priority)), str(row.get("template", IssueType.template)))
            for name, row in (data.get("issue_types") or {}).items()
        },
        frequency_rules=tuple(
            FrequencyRule(str(r.get("name", "")), str(r.get("condition", "always")), int(r.get("interval_hours", 24)))
            for r in data.get("frequency_rules") or ()
        ),
        department_managers=dict(data.get("department_managers") or {}),
        default_manager=str(data.get("default_manager", "")),
        digest=DigestSchedule(
            enabled=bool(digest.get("enabled", plan.enabled)),
            day_of_week=str(digest.get("day_of_week", plan.day_of_week)),
            time=str(digest.get("time", plan.time)),
            timezone=str(digest.get("timezone", plan.timezone)),
        ),
    )


def load_settings(path: str) -> Settings:
    """Settings of a YAML file; all defaults when there is no such file."""
    file = Path(path)
    if not file.exists():
        return Settings()
    import yaml

    return settings_from(yaml.safe_load(file.read_text(encoding="utf-8")) or {})


def invalid_rules(settings: Settings) -> list[FrequencyRule]:
    """Frequency rules that can never match because they do not parse."""
    return [r for r in settings.frequency_rules if parse_condition(r.condition) is None]


def managers_table(spark: SparkSession, settings: Settings) -> DataFrame:
    return spark.createDataFrame(list(settings.department_managers.items()), "department string, manager string")


def issue_types_table(spark: SparkSession, settings: Settings) -> DataFrame:
    rows = [(name, t.priority, t.template) for name, t in settings.issue_types.items()]
    return spark.createDataFrame(rows, "issueType string, priority string, template string")


def rules_table(spark: SparkSession, settings: Settings) -> DataFrame:
    rows = [(i, r.name, r.condition, r.interval_hours) for i, r in enumerate(settings.frequency_rules)]
    return spark.createDataFrame(rows, "ord int, name string, condition string, interval_hours int")
