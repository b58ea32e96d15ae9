"""From credentials and required people to one status row per credential."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestal import constants as K
from attestal import schemas
from attestal.functions import scalar as S
from attestal.functions.predicates import is_children_check
from attestal.operators.asof import LINE_ROWS, as_of_join

NAME_KEYS = ["first_key", "last_key"]
_PERSON = [f.name for f in schemas.REQUIRED_PERSON.fields]
_EVER = -(2**63)
#: Tasks that the people of one name are spread over.
_SPREAD = 64
_STATUS = [f.name for f in schemas.STATUS.fields]


def flatten_credentials(documents: DataFrame, polled_at: Column | str | None = None) -> DataFrame:
    """Columns of nested credential documents that later steps read."""
    at = F.lit(polled_at) if isinstance(polled_at, str) or polled_at is None else polled_at
    return documents.select(
        F.col("subject_user_id").alias("userId"),
        F.col("document_id").alias("documentId"),
        F.col("document_version_id").alias("versionId"),
        F.col("subject_user.first_name").alias("firstName"),
        F.col("subject_user.last_name").alias("lastName"),
        F.col("document_type.name").alias("typeName"),
        F.col("attributes.expiry_period_end_date").alias("expiry"),
        F.col("attributes.credential_number").alias("wwccNumber"),
        F.col("metadata.expiry_status").alias("expiryStatus"),
        F.col("metadata.approval.status").alias("approvalStatus"),
        at.cast("string").alias("polledAt"),
    )


def children_checks(credentials: DataFrame) -> DataFrame:
    return credentials.filter(is_children_check(F.col("typeName")))


def with_name_keys(people: DataFrame) -> DataFrame:
    return people.withColumns({"first_key": S.name_key(F.col("firstName")), "last_key": S.name_key(F.col("lastName"))})


def unique_people(required: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One person per normalised name (and ``by``): the one with the smallest address.

    The aggregate sorts its rows, so they are spread first, those of one name
    over up to ``_SPREAD`` tasks, which combine them before they meet.
    """
    rest = [c for c in _PERSON if c != "email"]
    return (
        with_name_keys(required)
        .repartition(*by, *NAME_KEYS, F.pmod(F.hash("email"), F.lit(_SPREAD)))
        .groupBy(*by, *NAME_KEYS)
        .agg(F.min(F.struct("email", *rest)).alias("p"))
        .select(*by, *NAME_KEYS, "p.*")
    )


def match_people(credentials: DataFrame, required: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Left join by normalised name (and ``by``); ``matched`` tells whether there was one.

    No broadcast hint: the list has no bound. Adaptive execution broadcasts it
    when it turns out small and splits a name that holds many credentials.
    """
    people = unique_people(required, by).select(
        *by, *NAME_KEYS, "email", "department", "position", "startDate", F.lit(True).alias("matched")
    )
    return (
        with_name_keys(credentials)
        .join(people, [*by, *NAME_KEYS], "left")
        .withColumn("matched", F.coalesce("matched", F.lit(False)))
        .drop(*NAME_KEYS)
    )


def classify(credentials: DataFrame, required: DataFrame, as_of: Column, processed_at: Column, by: Sequence[str] = ()) -> DataFrame:
    """Status row of every credential, with the columns ``by`` that list and credential must share besides the name."""
    since_start = S.days_since_start(F.col("startDate"), as_of)
    rows = match_people(credentials, required, by).withColumn("daysSinceStart", since_start)
    status = S.compliance_status(F.col("expiryStatus"), F.col("approvalStatus"), F.col("matched"), F.col("daysSinceStart"))
    return rows.withColumns(
        {
            "expiryDate": S.expiry_text(F.col("expiry")),
            "daysUntilExpiry": S.days_until_expiry(F.col("expiry"), as_of),
            "safetyculture_status": F.col("expiryStatus"),
            "approval_status": F.col("approvalStatus"),
            "compliance_status": status,
            "flags": S.compliance_flags(status, F.col("wwccNumber").isNotNull()),
            "processedAt": processed_at,
        }
    ).select(*_STATUS, *by)


def classify_as_of(
    credentials: DataFrame, lists: DataFrame, time_us: str, since_us: str, as_of: Column, processed_at: Column, max_rows: int = LINE_ROWS
) -> DataFrame:
    """Status row of every credential by the list that held at its time, with ``list_version``.

    ``lists`` has the people of every ``list_version`` and the time ``since_us`` it
    was published. Credentials from before the first list wait for it and are
    judged by it; while there is no list there are no rows. A replay gives the
    same rows, whatever lists have been published since.
    """
    versions = lists.groupBy("list_version").agg(F.min(since_us).alias(since_us))
    # one row a list: the first one holds from ever
    in_line = F.row_number().over(Window.orderBy(since_us, "list_version"))
    versions = versions.withColumn(since_us, F.when(in_line == 1, _EVER).otherwise(F.col(since_us)))
    timed = credentials.withColumn(time_us, F.coalesce(time_us, F.lit(_EVER)))
    ready = as_of_join(timed, versions, [], time_us, since_us, ["list_version"], max_rows).filter("list_version IS NOT NULL")
    return classify(ready, lists.drop(since_us), as_of, processed_at, ["list_version"])


def missing_people(required: DataFrame, credentials: DataFrame, as_of: Column, processed_at: Column) -> DataFrame:
    """A MISSING status row for everyone who must hold a credential and has none.

    Any credential counts, approved or not. Names seen are made distinct before
    the join, so a name with many credentials weighs one row.
    """
    seen = with_name_keys(credentials).select(*NAME_KEYS).distinct()
    absent = unique_people(required.filter("requiresWwcc")).join(seen, NAME_KEYS, "left_anti")
    text = F.lit(None).cast("string")
    return absent.select(
        S.synthetic_user_id(F.col("email")).alias("userId"),
        "firstName",
        "lastName",
        "email",
        "department",
        "position",
        "startDate",
        text.alias("wwccNumber"),
        text.alias("expiryDate"),
        F.lit(None).cast("long").alias("daysUntilExpiry"),
        S.days_since_start(F.col("startDate"), as_of).alias("daysSinceStart"),
        F.lit(K.EXPIRY_UNKNOWN).alias("safetyculture_status"),
        F.lit(K.APPROVAL_UNKNOWN).alias("approval_status"),
        F.lit(K.MISSING).alias("compliance_status"),
        F.array(*[F.lit(f) for f in K.MISSING_FLAGS]).alias("flags"),
        processed_at.alias("processedAt"),
    )


def all_statuses(credentials: DataFrame, required: DataFrame, as_of: Column, processed_at: Column) -> DataFrame:
    """Status rows of credentials and of people without one."""
    return classify(credentials, required, as_of, processed_at).unionByName(
        missing_people(required, credentials, as_of, processed_at)
    )
