"""The driver's tables read as compliance data.

Every function covers its whole source table: columns are derived from values,
no rows are left out. ``oracle.py`` states the same derivations in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestal import constants as K
from attestal import schemas
from attestal.functions import scalar as S
from attestal.operators import cells
from attestal.sources.config import SAMPLE_SETTINGS, Settings, load_settings

AS_OF_TEXT = "1998-07-01"
PROCESSED_AT = "1998-07-01T00:00:00Z"
ZONE = "Australia/Sydney"
SUMMARY_DATE = "2024-02-01"

STATUS_OF_EVENT = {
    "error": K.EXPIRED,
    "view": K.EXPIRING,
    "click": K.NOT_APPROVED,
    "signup": K.MISSING,
    "purchase": K.COMPLIANT,
}


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("date")


def settings() -> Settings:
    return load_settings(SAMPLE_SETTINGS)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def choose(column: Column, values: dict[str, str], other: str | None = None) -> Column:
    result = F.lit(other)
    for key, value in values.items():
        result = F.when(column == key, value).otherwise(result)
    return result


# --- people and credentials ---------------------------------------------------


def required_people(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.concat(F.lit("u"), _text("c_custkey"), F.lit("@example.org")).alias("email"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("firstName"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("lastName"),
        F.col("c_mktsegment").alias("department"),
        F.concat(F.lit("P"), _text("c_nationkey")).alias("position"),
        (F.col("c_nationkey") != 3).alias("requiresWwcc"),
        _text(F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2200).cast("int"))).alias("startDate"),
    )


def credentials_of(orders: DataFrame) -> DataFrame:
    """Credential columns of an orders frame, batch or stream."""
    price, day = F.col("o_totalprice"), F.col("o_orderdate")
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    high = (F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P")
    impossible = (price >= 20000) & (price < 40000)
    month = F.when(impossible, 2).otherwise(F.month(day)).cast("int")
    dom = F.when(impossible, 30).otherwise(F.dayofmonth(day)).cast("int")
    return orders.select(
        _text("o_custkey").alias("userId"),
        _text("o_orderkey").alias("documentId"),
        F.concat(_text("o_orderkey"), F.lit("-1")).alias("versionId"),
        F.lit("  CUSTOMER ").alias("firstName"),
        F.concat(F.lpad(_text("o_custkey"), 9, "0"), F.when(price > 400000, "X").otherwise(" ")).alias("lastName"),
        F.when(urgent, "Working With Children Check")
        .when(high, "Children's Services Credential")
        .when(F.col("o_orderpriority") == "5-LOW", "First Aid Certificate")
        .otherwise("Driver License")
        .alias("typeName"),
        F.when(price >= 20000, F.struct(F.year(day).cast("int").alias("year"), month.alias("month"), dom.alias("day"))).alias("expiry"),
        F.when(price >= 60000, F.concat(F.lit("WWC"), _text("o_orderkey"))).alias("wwccNumber"),
        F.when(day < F.lit(AS_OF_TEXT).cast("date"), K.EXPIRY_EXPIRED)
        .when(day < F.lit("1998-07-31").cast("date"), K.EXPIRY_EXPIRING)
        .otherwise(K.EXPIRY_VALID)
        .alias("expiryStatus"),
        F.when((F.col("o_orderstatus") == "P") & (price < 250000), K.APPROVAL_PENDING)
        .otherwise(K.APPROVAL_APPROVED)
        .alias("approvalStatus"),
        F.lit(PROCESSED_AT).alias("polledAt"),
    )


def credentials(spark: SparkSession, sf: str) -> DataFrame:
    return credentials_of(table(spark, sf, "orders"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """Credentials as nested provider documents, with ``broken`` for later."""
    c = credentials_of(table(spark, sf, "orders"))
    nobody = F.struct(F.lit("a").alias("id"), F.lit("A").alias("first_name"), F.lit("B").alias("last_name"))
    return c.select(
        F.lit("org").alias("subject_org_id"),
        F.col("userId").alias("subject_user_id"),
        F.lit("type").alias("document_type_id"),
        F.col("documentId").alias("document_id"),
        F.col("versionId").alias("document_version_id"),
        F.struct(
            F.col("expiry").alias("expiry_period_end_date"), F.col("wwccNumber").alias("credential_number")
        ).alias("attributes"),
        F.struct(
            F.col("polledAt").alias("created_at"),
            nobody.alias("created_by_user"),
            F.col("polledAt").alias("last_modified"),
            nobody.alias("last_modified_by_user"),
            F.col("expiryStatus").alias("expiry_status"),
            F.struct(F.col("approvalStatus").alias("status"), F.lit("").alias("reason")).alias("approval"),
        ).alias("metadata"),
        F.struct(F.col("userId").alias("id"), F.col("firstName").alias("first_name"), F.col("lastName").alias("last_name")).alias("subject_user"),
        F.struct(F.lit("t").alias("id"), F.col("typeName").alias("name")).alias("document_type"),
    )


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """One snapshot text per order: its document, twice except for driver licences.

    Driver licences come cut off; of the two first-aid certificates the second
    lacks its type. Both kinds fail as a whole.
    """
    docs = documents(spark, sf)
    kind = F.col("document_type.name")
    changed = {
        "document_version_id": F.concat("document_id", F.lit("-2")),
        "document_type": F.when(kind != "First Aid Certificate", F.col("document_type")),
    }
    first = F.struct(*docs.columns)
    second = F.struct(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])
    versions = F.when(kind == "Driver License", F.array(first)).otherwise(F.array(first, second))
    body = F.to_json(F.struct(F.lit("").alias("next_page_token"), versions.alias("latest_document_versions")))
    text = F.when(kind == "Driver License", F.substring(body, F.lit(1), F.length(body) - 5)).otherwise(body)
    return docs.select(text.alias("value"))


def list_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Required lists as messages: version 1, version 2 with repeated names, a malformed version 3."""
    people = required_people(spark, sf).withColumn("part", F.regexp_extract("email", "^u([0-9]+)@", 1).cast("long"))
    fields = [c for c in people.columns if c != "part"]
    entry = F.struct(*fields)
    again = F.struct(*[F.concat(F.lit("new."), F.col(c)).alias(c) if c == "email" else F.col(c) for c in fields])

    def message(version: int, entries: Column) -> DataFrame:
        body = F.struct(entries.alias("requiredUsers"), F.lit(PROCESSED_AT).alias("timestamp"))
        return people.select(F.lit(version).cast("long").alias("list_version"), "part", F.to_json(body).alias("value"))

    short = F.array(F.struct("email", "firstName", "lastName", F.col("position").alias("requiredBecause")))
    twice = F.when(F.col("position") == "P5", F.array(entry, again)).otherwise(F.array(entry))
    return message(1, F.array(entry)).unionByName(message(2, twice)).unionByName(message(3, short))


def dated_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Credentials with the moment they came in, within the day of their order."""
    orders = table(spark, sf, "orders")
    day = S.epoch_micros(F.col("o_orderdate").cast("timestamp"), "timestamp")
    moments = orders.select(_text("o_orderkey").alias("documentId"), (day + F.col("o_orderkey") % 86400 * 1_000_000).alias("at_us"))
    return credentials_of(orders).join(moments, "documentId")


def dated_lists(spark: SparkSession, sf: str) -> DataFrame:
    """A list for each year from 1993 on, without another fifth of the people each time."""
    people = required_people(spark, sf).withColumn("__number", F.regexp_extract("email", "^u([0-9]+)@", 1).cast("long"))
    year = F.explode(F.sequence(F.lit(1993).cast("long"), F.lit(1998).cast("long")))
    listed = people.withColumn("list_version", year).filter(F.col("__number") % 5 != F.col("list_version") % 5)
    since = F.unix_micros(F.make_timestamp("list_version", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    position = F.concat("position", F.lit("-"), "list_version")
    return listed.withColumn("since_us", since).withColumn("position", position).drop("__number")


# --- events as status changes -------------------------------------------------


def events(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events")
    return df.withColumn("ts_us", S.epoch_micros(F.col("ts"), df.schema["ts"].dataType.simpleString()))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


_STATUS_ORDER = [f.name for f in schemas.STATUS.fields]


def status_core(ev: DataFrame) -> DataFrame:
    """Status rows of an events frame without the person's department and position.

    Carries ``event_id``, ``user_id``, ``ts`` and ``ts_us`` along.
    """
    status = choose(F.col("event_type"), STATUS_OF_EVENT)
    known = F.col("event_type") != "signup"
    days = F.when(known, F.floor("value").cast("long") - 30)
    number = F.when(known & (F.col("user_id") % 5 != 0), F.concat(F.lit("W"), _text("user_id")))
    flags = F.when(~known, F.array(*[F.lit(f) for f in K.MISSING_FLAGS])).otherwise(
        S.compliance_flags(status, number.isNotNull())
    )
    expiry_status = {"error": K.EXPIRY_EXPIRED, "view": K.EXPIRY_EXPIRING, "signup": K.EXPIRY_UNKNOWN}
    approval = {"click": K.APPROVAL_PENDING, "signup": K.APPROVAL_UNKNOWN}
    return ev.select(
        _text("user_id").alias("userId"),
        F.lit("User").alias("firstName"),
        F.lpad(_text("user_id"), 4, "0").alias("lastName"),
        F.when(F.col("user_id") % 11 != 0, F.concat(F.lit("u"), _text("user_id"), F.lit("@example.org"))).alias("email"),
        F.lit("2023-06-01").alias("startDate"),
        number.alias("wwccNumber"),
        _text(F.date_add(F.lit(SUMMARY_DATE).cast("date"), days.cast("int"))).alias("expiryDate"),
        days.alias("daysUntilExpiry"),
        F.lit(245).cast("long").alias("daysSinceStart"),
        choose(F.col("event_type"), expiry_status, K.EXPIRY_VALID).alias("safetyculture_status"),
        choose(F.col("event_type"), approval, K.APPROVAL_APPROVED).alias("approval_status"),
        status.alias("compliance_status"),
        flags.alias("flags"),
        iso(F.col("ts")).alias("processedAt"),
        "event_id",
        "user_id",
        "ts",
        "ts_us",
    )


def with_people(core: DataFrame, customers: DataFrame) -> DataFrame:
    """Department (for some) and position of each user, columns in record order."""
    people = customers.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("segment"),
        F.concat(F.lit("P"), _text("c_nationkey")).alias("position"),
    )
    rest = ["event_id", "ts", "ts_us"]
    return (
        core.join(people, "user_id", "left")
        .withColumn("department", F.when(F.col("user_id") % 7 != 0, F.col("segment")))
        .select(*_STATUS_ORDER, *rest)
    )


def status_events(spark: SparkSession, sf: str) -> DataFrame:
    return with_people(status_core(events(spark, sf)), table(spark, sf, "customer"))


def person_events(spark: SparkSession, sf: str) -> DataFrame:
    """Status rows for steps that do not read the department: no join."""
    return status_core(events(spark, sf))


def polls(spark: SparkSession, sf: str) -> DataFrame:
    """Polled snapshots: a fingerprint per (user, type) and time."""
    bucket = F.floor(F.col("value") / 100).cast("long")
    return events(spark, sf).select(
        "event_id", "user_id", "event_type", "ts", "ts_us", S.fingerprint([("bucket", bucket)]).alias("fingerprint")
    )


def command_events(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        F.concat(_text("user_id"), F.lit("-"), "event_type").alias("notificationId"), "event_id", "ts", "ts_us"
    )


def missing_detections(spark: SparkSession, sf: str) -> DataFrame:
    """Missing-person findings; a new required list arrives every ten days."""
    return events(spark, sf).filter("event_type = 'signup'").select(
        "event_id",
        F.concat(F.lit("u"), _text("user_id"), F.lit("@example.org")).alias("email"),
        F.floor(F.dayofmonth("ts") / 10).cast("long").alias("list_version"),
        "ts",
        "ts_us",
    )


# --- events as topics, logs and test runs -------------------------------------


def event_json() -> Column:
    return F.to_json(F.struct("event_id", "user_id", "event_type", "props"))


def topic_log(spark: SparkSession, sf: str) -> DataFrame:
    """Topic = event type, three partitions, dense offsets in time order."""
    rows = events(spark, sf).select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        _text("user_id").alias("key"),
        event_json().alias("value"),
        "ts",
        "ts_us",
        "event_id",
    )
    return cells.with_position(rows, ["topic", "partition"], "ts_us", ["event_id"], "offset")


COMMITTED_BEFORE = {
    "reader-live": "2024-01-30 23:55:00",
    "reader-near": "2024-01-30 12:00:00",
    "reader-slow": "2024-01-20 00:00:00",
    "other-slow": "2024-01-10 00:00:00",
}


def committed_offsets(log: DataFrame) -> DataFrame:
    """What each consumer group has read: all records before its own moment."""
    groups = F.explode(
        F.array_compact(
            F.array(
                *[
                    F.when(F.col("ts") < F.lit(at).cast("timestamp_ntz"), F.lit(group))
                    for group, at in COMMITTED_BEFORE.items()
                ]
            )
        )
    )
    return (
        log.select("topic", "partition", "offset", groups.alias("consumer_group"))
        .groupBy("consumer_group", "topic", "partition")
        .agg((F.max("offset") + 1).alias("committed"))
    )


def raw_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Event JSON, cut off where the value is below 2, without its type where it is below 4."""
    body = event_json()
    text = (
        F.when(F.col("value") < 2, F.substring(body, F.lit(1), F.length(body) - 3))
        .when(F.col("value") < 4, F.to_json(F.struct("event_id", "user_id", "props")))
        .otherwise(body)
    )
    return table(spark, sf, "events").select(text.alias("value"))


def logs(spark: SparkSession, sf: str) -> DataFrame:
    level = choose(F.col("event_type"), {"error": "[ERROR]", "signup": "[WARN]"}, "[INFO]")
    container = F.element_at(F.array(*[F.lit(c) for c in ("poller", "transformer", "router", "sender")]), (F.col("user_id") % 4 + 1).cast("int"))
    return table(spark, sf, "events").select(
        "event_id", "ts", container.alias("container"), F.concat(level, F.lit(" "), "event_type", F.lit(" of "), _text("user_id")).alias("line")
    )


def heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.concat("event_type", F.lit("-"), _text(F.col("user_id") % 40)).alias("consumer_group"), "ts"
    )


def test_metrics(spark: SparkSession, sf: str) -> DataFrame:
    n = F.floor("value").cast("long")
    return events(spark, sf).select(
        F.concat(F.lit("svc-"), _text(F.col("user_id") % 5)).alias("service"),
        F.when(F.col("event_type").isin("error", "signup"), "failed").otherwise("passed").alias("status"),
        n.alias("tests"),
        F.pmod(n, F.lit(600)).cast("long").alias("duration_s"),
        F.floor(F.col("ts_us") / 1000000).cast("long").alias("run_ts"),
    )


def test_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Three log lines per test run, in the forms the parser knows."""
    n = F.floor("value").cast("long")
    passed, failed = _text(n), _text(F.pmod(n, F.lit(4)))
    empty = F.lit("done")

    def line(**by_type: Column) -> Column:
        text = empty
        for kind, value in by_type.items():
            text = F.when(F.col("event_type") == kind, value).otherwise(text)
        return text

    total = F.concat(F.lit("Total number of tests run: "), passed)
    lines = F.array(
        F.lit("start"),
        line(
            view=F.concat(F.lit("Tests: succeeded "), passed, F.lit(", failed "), failed, F.lit(", canceled 0")),
            click=total,
            error=F.lit("Tests: succeeded 0, failed 0, canceled 0"),
            signup=F.concat(passed, F.lit(" passed")),
            purchase=F.lit("No tests found"),
        ),
        line(click=F.concat(F.lit("suite failed "), failed), error=total, signup=F.concat(failed, F.lit(" errors"))),
    )
    return table(spark, sf, "events").select("event_id", F.posexplode(lines).alias("line_no", "line"))
