"""Notification commands and delivery events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal import constants as K
from attestal import schemas
from attestal.functions import render
from attestal.functions import scalar as S
from attestal.sources.config import Settings

_COMMAND = [f.name for f in schemas.COMMAND.fields]


def notification_id(*parts: Column) -> Column:
    """Deterministic id, so that a rerun names the same command the same."""
    return F.md5(F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])))


def recipients(address: Column, override: str | None) -> Column:
    if override is not None:
        return F.array(F.lit(override))
    return F.array_compact(F.array(address))


def copies(addresses: Sequence[str]) -> Column:
    """The carbon-copy list, null when there is none."""
    if not addresses:
        return F.lit(None).cast("array<string>")
    return F.array(*[F.lit(a) for a in addresses])


def priority_of(status: Column, settings: Settings) -> Column:
    value = F.lit(K.PRIORITY_MEDIUM)
    for name, issue in settings.issue_types.items():
        value = F.when(status == name, issue.priority).otherwise(value)
    return value


def template_of(status: Column, settings: Settings) -> Column:
    value = F.lit(K.ALERT_TEMPLATE)
    for name, issue in settings.issue_types.items():
        value = F.when(status == name, issue.template).otherwise(value)
    return value


def alert_commands(status: DataFrame, settings: Settings, created_at: str = "processedAt") -> DataFrame:
    """One command per status row that is to be notified."""
    kind = F.col("compliance_status")
    name = S.full_name(F.col("firstName"), F.col("lastName"))
    return status.select(
        notification_id(F.col("userId"), kind, F.col(created_at)).alias("notificationId"),
        "userId",
        name.alias("userName"),
        recipients(F.col("email"), settings.override_recipient).alias("to"),
        copies(settings.cc_recipients).alias("cc"),
        F.lit(None).cast("array<string>").alias("bcc"),
        F.concat(F.lit(K.ALERT_SUBJECT), kind, F.lit(" - "), name).alias("subject"),
        kind.alias("issueType"),
        priority_of(kind, settings).alias("priority"),
        template_of(kind, settings).alias("template"),
        F.lit(True).alias("isHtml"),
        F.struct("wwccNumber", "expiryDate", "daysUntilExpiry").alias("data"),
        F.col(created_at).alias("createdAt"),
    )


def digest_commands(digests: DataFrame, settings: Settings, created_at: Column) -> DataFrame:
    """One command per manager digest."""
    empty = F.lit(None).cast("string")
    return digests.select(
        notification_id(F.lit(K.DIGEST_USER), F.col("manager"), created_at).alias("notificationId"),
        F.lit(K.DIGEST_USER).alias("userId"),
        F.concat("department", F.lit(" Manager")).alias("userName"),
        recipients(F.col("manager"), settings.override_recipient).alias("to"),
        F.lit(None).cast("array<string>").alias("cc"),
        F.lit(None).cast("array<string>").alias("bcc"),
        F.concat(F.lit(K.DIGEST_SUBJECT), "department", F.lit(" ("), F.col("totalIssues").cast("string"), F.lit(" issues)")).alias("subject"),
        F.lit(K.DIGEST_ISSUE).alias("issueType"),
        F.when(F.col("totalExpired") > 0, K.PRIORITY_HIGH).otherwise(K.PRIORITY_MEDIUM).alias("priority"),
        F.lit(K.DIGEST_TEMPLATE).alias("template"),
        F.lit(True).alias("isHtml"),
        F.struct(empty.alias("wwccNumber"), empty.alias("expiryDate"), F.lit(None).cast("long").alias("daysUntilExpiry")).alias("data"),
        created_at.alias("createdAt"),
    )


def unsent(commands: DataFrame, sent: DataFrame) -> DataFrame:
    """Commands whose id has no delivery event yet."""
    return commands.join(sent.select("notificationId").distinct(), "notificationId", "left_anti").select(*commands.columns)


def delivery_events(commands: DataFrame, failures: DataFrame, sent_at: Column) -> DataFrame:
    """One event per command; ``failures`` holds (notificationId, errorMessage)."""
    errors = failures.groupBy("notificationId").agg(F.min("errorMessage").alias("errorMessage"), F.lit(True).alias("failed"))
    return commands.join(errors, "notificationId", "left").select(
        "notificationId",
        "userId",
        F.coalesce(F.get("to", F.lit(0)), F.lit("")).alias("email"),
        "issueType",
        sent_at.alias("sentAt"),
        F.col("failed").isNull().alias("success"),
        "errorMessage",
    )


def failed(commands: DataFrame, events: DataFrame) -> DataFrame:
    """Commands with a failure event and no success: what a retry would send."""
    outcome = events.groupBy("notificationId").agg(F.bool_or("success").alias("sent")).filter("NOT sent")
    return commands.join(outcome.select("notificationId"), "notificationId", "left_semi").select(*commands.columns)


def with_body(commands: DataFrame, organisation: str = "") -> DataFrame:
    """Adds ``body``: HTML where asked for and renderable, else plain text."""
    number, expiry, days = (F.col(f"data.{c}") for c in ("wwccNumber", "expiryDate", "daysUntilExpiry"))
    html = render.alert_html(F.col("userName"), F.col("issueType"), number, expiry, days, F.col("createdAt"), organisation)
    plain = S.plain_body(F.col("userName"), F.col("issueType"), F.col("priority"), number, expiry, days)
    return commands.withColumn("body", F.coalesce(F.when(F.col("isHtml"), html), plain))
