"""Registered queries: one per operator, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestal import constants as K
from attestal import schemas
from attestal.functions import predicates as P
from attestal.functions import render
from attestal.functions import scalar as S
from attestal.operators import cells, classify, dedup, digest, monitor, notify, rules
from attestal.plans import flows
from attestal.plans import testmap as M
from attestal.session import work_dir
from attestal.sources import decode, readers
from attestal.sources.config import SAMPLE_RULES, issue_types_table, managers_table
from attestal.sources.published import BatchLog, KeyedTable
from attestal.sources.topiclog import TopicLog
from attestal.streaming import keyed, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_ORDER = ["ts_us", "event_id"]
_TIE = ["event_id"]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _joined(array: Column | str) -> Column:
    return F.array_join(array, ",")


def _stamp(column: Column | str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _processed() -> Column:
    return F.lit(M.PROCESSED_AT)


def _flat_status(df: DataFrame) -> DataFrame:
    return df.withColumn("flags", _joined("flags"))


# --- sources, decoding, sinks -------------------------------------------------


@query
def snapshot_explode(spark: SparkSession, sf: str) -> DataFrame:
    docs = readers.snapshot_documents(M.snapshots(spark, sf), "value")
    return classify.flatten_credentials(docs, F.col("metadata.created_at")).withColumn("expiry", S.expiry_text(F.col("expiry")))


@query
def topic_scan(spark: SparkSession, sf: str) -> DataFrame:
    return M.topic_log(spark, sf).select("topic", "partition", "offset", "key", "value")


def _topic_log(spark: SparkSession, sf: str) -> tuple[TopicLog, DataFrame]:
    """All records, appended in two batches to a log with offsets, and the records themselves."""
    log, records = TopicLog(work_dir(spark, "topic-log")), M.topic_log(spark, sf)
    second = F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    log.append(records.filter(~second), 0, "ts_us", _TIE)
    log.append(records.filter(second), 1, "ts_us", _TIE)
    return log, records


@query
def topic_read_on(spark: SparkSession, sf: str) -> DataFrame:
    """Records past the offsets that one consumer group has committed."""
    log, records = _topic_log(spark, sf)
    committed = M.committed_offsets(records).filter("consumer_group = 'reader-slow'")
    return log.scan(spark, committed).select("topic", "partition", "offset", "key", "value")


@query
def topic_end_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return _topic_log(spark, sf)[0].end_offsets(spark)


@query
def decode_valid(spark: SparkSession, sf: str) -> DataFrame:
    return decode.decode_valid(M.raw_messages(spark, sf), "value", _EVENT_SCHEMA)


@query
def decode_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    return decode.decode_quarantine(M.raw_messages(spark, sf), "value", _EVENT_SCHEMA)


_EVENT_SCHEMA = schemas._struct(event_id=schemas._L, user_id=schemas._L, event_type=schemas._S, props=schemas._S)


@query
def reference_latest(spark: SparkSession, sf: str) -> DataFrame:
    return decode.latest_required_people(M.list_messages(spark, sf), "list_version", "part", "value")


@query
def directory_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as a directory export and read back."""
    path = work_dir(spark, "directory")
    people = M.table(spark, sf, "customer").select(
        F.md5(F.col("c_custkey").cast("string")).alias("UUID"),
        F.concat(F.lit("u"), F.col("c_custkey").cast("string"), F.lit("@example.org")).alias("EMAIL"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("FIRST NAME"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("LAST NAME"),
    )
    people.write.csv(path, header=True)
    return readers.read_directory(spark, path)


@query
def config_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Events counted by the settings that apply to their issue type."""
    kinds = issue_types_table(spark, M.settings())
    counted = M.person_events(spark, sf).groupBy(F.col("compliance_status").alias("issueType")).agg(F.count(F.lit(1)).alias("records"))
    return counted.join(kinds, "issueType", "left").select(
        "issueType",
        F.coalesce("priority", F.lit(K.PRIORITY_MEDIUM)).alias("priority"),
        F.coalesce("template", F.lit(K.ALERT_TEMPLATE)).alias("template"),
        "records",
    )


@query
def keyed_json_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Status rows appended to a topic folder and scanned back."""
    store = readers.TopicStore(work_dir(spark, "topics"))
    rows = M.status_events(spark, sf).select(*[f.name for f in schemas.STATUS.fields])
    store.append(readers.keyed_json(rows, "userId"), K.TOPIC_STATUS)
    return store.scan(spark, K.TOPIC_STATUS)


@query
def delivery_events(spark: SparkSession, sf: str) -> DataFrame:
    commands = notify.alert_commands(M.person_events(spark, sf), M.settings())
    return notify.delivery_events(commands, _failures(commands), F.col("createdAt"))


def _failures(commands: DataFrame) -> DataFrame:
    """Sends that failed: those without a recipient."""
    return commands.filter(F.size("to") == 0).select("notificationId", F.lit("no recipient").alias("errorMessage"))


@query
def failed_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Commands to send again: those whose delivery event says failure."""
    commands = notify.alert_commands(M.person_events(spark, sf), M.settings())
    events = notify.delivery_events(commands, _failures(commands), F.col("createdAt"))
    return notify.failed(commands, events).select("notificationId", "userId", "issueType")


# --- filters ------------------------------------------------------------------


@query
def filter_doc_type(spark: SparkSession, sf: str) -> DataFrame:
    return classify.children_checks(M.credentials(spark, sf)).select("userId", "documentId", "typeName")


@query
def filter_notify_status(spark: SparkSession, sf: str) -> DataFrame:
    return M.person_events(spark, sf).filter(P.should_notify(F.col("compliance_status"))).select("event_id", "userId", "compliance_status")


@query
def frequency_condition(spark: SparkSession, sf: str) -> DataFrame:
    days = F.col("daysUntilExpiry")
    tests = {
        "is_always": "always",
        "lt_0": "days_until_expiry < 0",
        "le_7": "days_until_expiry <= 7",
        "gt_30": "days_until_expiry > 30",
        "ge_60": "days_until_expiry >= 60",
        "unknown_op": "days_until_expiry == 5",
        "bad_bound": "days_until_expiry <= soon",
        "other_field": "days_since_start > 5",
    }
    columns = [P.condition_holds(text, days).alias(name) for name, text in tests.items()]
    return M.person_events(spark, sf).select("event_id", days, *columns)


def _due_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Digest checks, one per event, at the Monday 09:00 slot."""
    plan = M.settings().digest
    ev = M.events(spark, sf)
    return ev.filter(P.digest_due(F.col("ts"), plan.day_of_week, plan.time, plan.timezone)).withColumn(
        "local_ts", P.local_time(F.col("ts"), plan.timezone)
    )


@query
def digest_due(spark: SparkSession, sf: str) -> DataFrame:
    return _due_checks(spark, sf).select("event_id", _stamp("local_ts").alias("local_ts"))


@query
def digest_once_per_day(spark: SparkSession, sf: str) -> DataFrame:
    """The check that sends: the first due one of each local day."""
    due = _due_checks(spark, sf).select(F.to_date("local_ts").cast("string").alias("local_date"), "ts_us", "event_id")
    return dedup.first_per_key(due, ["local_date"], _ORDER).select("local_date", "event_id")


@query
def log_errors(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.log_errors(M.logs(spark, sf), ["poller", "transformer", "router"]).select("event_id", "container", "line")


# --- projections --------------------------------------------------------------


@query
def expiry_text(spark: SparkSession, sf: str) -> DataFrame:
    return M.credentials(spark, sf).select("documentId", S.expiry_text(F.col("expiry")).alias("expiryDate"))


@query
def days_until_expiry(spark: SparkSession, sf: str) -> DataFrame:
    return M.credentials(spark, sf).select("documentId", S.days_until_expiry(F.col("expiry"), M.as_of()).alias("days"))


@query
def days_since_start(spark: SparkSession, sf: str) -> DataFrame:
    return M.required_people(spark, sf).select("email", S.days_since_start(F.col("startDate"), M.as_of()).alias("days"))


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    """Status rows of all credentials, with their document."""
    people = M.required_people(spark, sf)
    rows = classify.match_people(classify.children_checks(M.credentials(spark, sf)), people)
    since = S.days_since_start(F.col("startDate"), M.as_of())
    return rows.withColumn(
        "status", S.compliance_status(F.col("expiryStatus"), F.col("approvalStatus"), F.col("matched"), since)
    )


@query
def compliance_status(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf).select("documentId", "status")


@query
def compliance_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = S.compliance_flags(F.col("status"), F.col("wwccNumber").isNotNull())
    return _classified(spark, sf).select("documentId", _joined(flags).alias("flags"))


@query
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    docs = M.documents(spark, sf)
    return docs.select("document_id", S.credential_fingerprint(F.struct(*docs.columns)).alias("hash"))


@query
def missing_people(spark: SparkSession, sf: str) -> DataFrame:
    seen = classify.children_checks(M.credentials(spark, sf))
    return _flat_status(classify.missing_people(M.required_people(spark, sf), seen, M.as_of(), _processed()))


def _flat_commands(commands: DataFrame) -> DataFrame:
    return commands.select(
        "notificationId",
        "userId",
        "userName",
        _joined("to").alias("to"),
        _joined("cc").alias("cc"),
        "subject",
        "issueType",
        "priority",
        "template",
        "isHtml",
        F.col("data.wwccNumber").alias("wwccNumber"),
        F.col("data.expiryDate").alias("expiryDate"),
        F.col("data.daysUntilExpiry").alias("daysUntilExpiry"),
        "createdAt",
    )


@query
def notification_commands(spark: SparkSession, sf: str) -> DataFrame:
    wanted = M.person_events(spark, sf).filter(P.should_notify(F.col("compliance_status")))
    return _flat_commands(notify.alert_commands(wanted, M.settings()))


@query
def priority_lookup(spark: SparkSession, sf: str) -> DataFrame:
    kind, plan = F.col("compliance_status"), M.settings()
    return M.person_events(spark, sf).select(
        "event_id", notify.priority_of(kind, plan).alias("priority"), notify.template_of(kind, plan).alias("template")
    )


@query
def recipients(spark: SparkSession, sf: str) -> DataFrame:
    return M.person_events(spark, sf).select(
        "event_id",
        _joined(notify.recipients(F.col("email"), None)).alias("to"),
        _joined(notify.recipients(F.col("email"), "test@example.org")).alias("to_override"),
        _joined(notify.copies(["a@example.org", "b@example.org"])).alias("cc"),
        _joined(notify.copies([])).alias("cc_none"),
    )


def _command_columns(spark: SparkSession, sf: str) -> DataFrame:
    return M.person_events(spark, sf).select(
        "event_id",
        S.full_name(F.col("firstName"), F.col("lastName")).alias("userName"),
        F.col("compliance_status").alias("issueType"),
        notify.priority_of(F.col("compliance_status"), M.settings()).alias("priority"),
        "wwccNumber",
        "expiryDate",
        "daysUntilExpiry",
        "processedAt",
    )


@query
def plain_body(spark: SparkSession, sf: str) -> DataFrame:
    c = [F.col(n) for n in ("userName", "issueType", "priority", "wwccNumber", "expiryDate", "daysUntilExpiry")]
    return _command_columns(spark, sf).select("event_id", S.plain_body(*c).alias("body"))


@query
def message_fields(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("issueType")
    flags = {"isExpired": K.EXPIRED, "isExpiring": K.EXPIRING, "isMissing": K.MISSING, "isNotApproved": K.NOT_APPROVED}
    rows = _command_columns(spark, sf).withColumn("t", S.issue_text(kind))
    return rows.select(
        "event_id",
        "t.message",
        "t.action",
        "t.background",
        "t.foreground",
        S.days_colour(F.col("daysUntilExpiry")).alias("daysColor"),
        *[(kind == value).alias(name) for name, value in flags.items()],
    )


@query
def html_body(spark: SparkSession, sf: str) -> DataFrame:
    c = [F.col(n) for n in ("userName", "issueType", "wwccNumber", "expiryDate", "daysUntilExpiry", "processedAt")]
    return _command_columns(spark, sf).select("event_id", render.alert_html(*c, organisation="Example Council").alias("html"))


@query
def message_body(spark: SparkSession, sf: str) -> DataFrame:
    """Body that goes out: HTML, or plain text where the command asks for it."""
    commands = notify.alert_commands(M.person_events(spark, sf), M.settings())
    mixed = commands.withColumn("isHtml", F.col("issueType") != K.NOT_APPROVED)
    return notify.with_body(mixed, "Example Council").select("notificationId", "isHtml", F.md5("body").alias("body_md5"))


@query
def schedule_parse(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in ("monday", "Tuesday", "WEDNESDAY", "thursday", "FRIDAY", "Saturday", "sunday", "INVALID", "")])
    day = F.element_at(names, (F.col("event_id") % 9 + 1).cast("int"))
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    clock = F.concat(two(F.col("event_id") % 27), F.lit(":"), two(F.col("user_id") % 60))
    text = F.when(F.col("event_type") == "error", "invalid").otherwise(clock)
    return M.events(spark, sf).select("event_id", S.weekday_number(day).alias("weekday"), S.clock_seconds(text).alias("second_of_day"))


@query
def notify_interval(spark: SparkSession, sf: str) -> DataFrame:
    seconds = rules.interval_seconds(M.settings().frequency_rules, F.col("daysUntilExpiry"))
    return M.person_events(spark, sf).select("event_id", seconds.alias("interval_s"))


@query
def dedup_keys(spark: SparkSession, sf: str) -> DataFrame:
    return M.person_events(spark, sf).select(
        "event_id",
        S.last_notification_key(F.col("userId"), F.col("compliance_status")).alias("cooldown_key"),
        S.sent_key(F.col("event_id")).alias("sent_key"),
        S.credential_key(F.col("userId"), F.col("event_id")).alias("credential_key"),
        S.compliance_key(F.col("userId")).alias("compliance_key"),
        S.missing_key(F.coalesce("email", F.lit("none"))).alias("missing_key"),
    )


# --- joins --------------------------------------------------------------------


@query
def name_match(spark: SparkSession, sf: str) -> DataFrame:
    rows = classify.match_people(M.credentials(spark, sf), M.required_people(spark, sf))
    return rows.select("documentId", "email", "department", "position", "startDate", "matched")


@query
def first_rule(spark: SparkSession, sf: str) -> DataFrame:
    rule = rules.first_rule(M.settings().frequency_rules, F.col("daysUntilExpiry"))
    return M.person_events(spark, sf).withColumn("r", rule).select("event_id", "r.ord", "r.name", "r.interval_hours")


@query
def manager_lookup(spark: SparkSession, sf: str) -> DataFrame:
    plan = M.settings()
    rows = M.status_events(spark, sf).select("event_id", F.coalesce("department", F.lit(K.UNKNOWN_DEPARTMENT)).alias("department"))
    return rules.with_manager(rows, managers_table(spark, plan), plan.default_manager).select("event_id", "department", "manager")


def _all_statuses(spark: SparkSession, sf: str) -> DataFrame:
    return flows.compliance(M.credentials(spark, sf), M.required_people(spark, sf), M.as_of(), _processed())


@query
def rule_eval(spark: SparkSession, sf: str) -> DataFrame:
    hits = rules.evaluate_rules(_all_statuses(spark, sf), readers.load_rules(spark, SAMPLE_RULES))
    return hits.select("userId", "wwccNumber", "expiryDate", "compliance_status", "ruleId", "rulePriority", "ruleIssueType")


@query
def rule_recipients(spark: SparkSession, sf: str) -> DataFrame:
    plan = M.settings()
    hits = rules.evaluate_rules(_all_statuses(spark, sf), readers.load_rules(spark, SAMPLE_RULES))
    return rules.rule_recipients(hits, managers_table(spark, plan), plan.default_manager, "compliance@example.org")


@query
def unsent_commands(spark: SparkSession, sf: str) -> DataFrame:
    """Commands without a delivery event; errors and purchases have been delivered."""
    commands = M.command_events(spark, sf)
    sent = M.events(spark, sf).filter(F.col("event_type").isin("error", "purchase")).select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), "event_type").alias("notificationId")
    )
    return notify.unsent(commands, sent).select("event_id", "notificationId")


# --- keyed state --------------------------------------------------------------


@query
def change_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = dedup.change_filter(M.polls(spark, sf), ["user_id", "event_type"], "ts_us", _TIE, "fingerprint")
    return rows.select("event_id", "user_id", "event_type", "fingerprint")


@query
def change_filter_ttl(spark: SparkSession, sf: str) -> DataFrame:
    rows = dedup.change_filter_ttl(
        M.polls(spark, sf), ["user_id", "event_type"], "ts_us", _TIE, "fingerprint", K.CREDENTIAL_TTL_S
    )
    return rows.select("event_id", "user_id", "event_type", "fingerprint")


@query
def missing_suppressed(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.missing_suppressed(M.missing_detections(spark, sf), "ts_us", _TIE).select("event_id", "email", "list_version")


@query
def cooldown_fixed(spark: SparkSession, sf: str) -> DataFrame:
    rows = M.events(spark, sf).select("event_id", "user_id", "event_type", "ts_us")
    return dedup.cooldown(rows, ["user_id", "event_type"], "ts_us", _TIE, 86400)


def _notifiable(spark: SparkSession, sf: str) -> DataFrame:
    return (
        M.events(spark, sf)
        .withColumn("compliance_status", M.choose(F.col("event_type"), M.STATUS_OF_EVENT))
        .filter(P.should_notify(F.col("compliance_status")))
        .select(
            "event_id",
            F.col("user_id").cast("string").alias("userId"),
            "compliance_status",
            F.when(F.col("event_type") != "signup", F.floor("value").cast("long") - 30).alias("daysUntilExpiry"),
            "ts",
            "ts_us",
        )
    )


@query
def cooldown_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = dedup.cooldown_by_rules(
        _notifiable(spark, sf).drop("ts"),
        ["userId", "compliance_status"],
        "ts_us",
        _TIE,
        M.settings().frequency_rules,
        F.col("daysUntilExpiry"),
    )
    return rows.select("event_id", "userId", "compliance_status", "daysUntilExpiry")


@query
def once_per_id(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.once_per_id(M.command_events(spark, sf).drop("ts"), "notificationId", "ts_us", _TIE).select("event_id", "notificationId")


@query
def latest_status(spark: SparkSession, sf: str) -> DataFrame:
    rows = M.person_events(spark, sf).select("userId", "compliance_status", "daysUntilExpiry", "event_id", "ts_us")
    return dedup.latest_per_key(rows, ["userId"], _ORDER).select("userId", "compliance_status", "daysUntilExpiry", "event_id")


# --- aggregations -------------------------------------------------------------


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    """Latest event per user first, people joined to what is left."""
    newest = dedup.latest_per_key(M.events(spark, sf).drop("props"), ["user_id"], _ORDER)
    return M.with_people(M.status_core(newest), M.table(spark, sf, "customer"))


@query
def dept_summary(spark: SparkSession, sf: str) -> DataFrame:
    return digest.department_summary(_latest(spark, sf))


@query
def dept_issues(spark: SparkSession, sf: str) -> DataFrame:
    pages = digest.department_issues(_latest(spark, sf), page_size=20)
    names = F.transform("issues", lambda i: F.concat(i["userName"], F.lit(":"), i["complianceStatus"]))
    return pages.select("department", "page", "pages", F.array_join(names, ";").alias("issues"), "totalCount", "expiredCount")


@query
def manager_digest(spark: SparkSession, sf: str) -> DataFrame:
    plan = M.settings()
    summary = digest.department_summary(_latest(spark, sf))
    return digest.manager_digest(summary, managers_table(spark, plan), plan.default_manager, M.SUMMARY_DATE)


@query
def poll_counters(spark: SparkSession, sf: str) -> DataFrame:
    marked = dedup.mark_changes(M.polls(spark, sf), ["user_id", "event_type"], "ts_us", _TIE, "fingerprint")
    return monitor.poll_counters(marked, F.date_format("ts", "yyyy-MM-dd"))


@query
def topic_counts(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.topic_counts(M.topic_log(spark, sf))


@query
def count_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.reconcile(monitor.topic_counts(M.topic_log(spark, sf)), {"error": 2014, "view": 5, "absent": 1, "none": 0})


@query
def consumer_lag(spark: SparkSession, sf: str) -> DataFrame:
    log = M.topic_log(spark, sf)
    return monitor.consumer_lag(log, M.committed_offsets(log), "reader-.*")


@query
def message_rate(spark: SparkSession, sf: str) -> DataFrame:
    log = M.events(spark, sf).select(F.col("event_type").alias("topic"), "ts")
    return monitor.message_rate(log).withColumn("minute", _stamp("minute"))


@query
def liveness(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.liveness(M.heartbeats(spark, sf), F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"))


@query
def test_totals(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.test_totals(M.test_metrics(spark, sf))


@query
def test_status_totals(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.test_grand_total(M.test_metrics(spark, sf))


@query
def test_log_parse(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.parse_test_logs(M.test_lines(spark, sf), ["event_id"], "line_no", "line")


# --- samples, unions ----------------------------------------------------------


@query
def topic_sample(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.topic_sample(M.topic_log(spark, sf)).select("topic", "partition", "offset", "key", "value")


@query
def recent_activity(spark: SparkSession, sf: str) -> DataFrame:
    return monitor.recent_activity(M.logs(spark, sf), ["ts", "event_id"], 100).select("event_id", "container", "line")


@query
def status_union(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_status(_all_statuses(spark, sf))


@query
def command_union(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of the latest notifiable rows together with manager digests."""
    plan, latest = M.settings(), _latest(spark, sf)
    alerts = notify.alert_commands(latest.filter(P.should_notify(F.col("compliance_status"))), plan)
    weekly = digest.manager_digest(digest.department_summary(latest), managers_table(spark, plan), plan.default_manager, M.SUMMARY_DATE)
    return _flat_commands(alerts.unionByName(notify.digest_commands(weekly, plan, F.lit("2024-02-01T00:00:00Z"))))


# --- end to end ---------------------------------------------------------------


@query
def compliance_report(spark: SparkSession, sf: str) -> DataFrame:
    return flows.compliance_counts(_all_statuses(spark, sf))


@query
def status_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Status of every children-check credential by the list of its time."""
    checks = classify.children_checks(M.dated_checks(spark, sf))
    return _flat_status(classify.classify_as_of(checks, M.dated_lists(spark, sf), "at_us", "since_us", M.as_of(), _processed()))


@query
def status_changes(spark: SparkSession, sf: str) -> DataFrame:
    rows = flows.status_changes(M.person_events(spark, sf).drop("ts"), "ts_us", _TIE)
    return rows.select("event_id", "userId", "compliance_status")


@query
def digest_run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Days a digest starts on; days with a due error event count as run before."""
    before = _due_checks(spark, sf).filter("event_type = 'error'")
    before = before.select(F.to_date("local_ts").cast("string").alias("localDate")).distinct()
    checks = M.events(spark, sf).select("event_id", "ts", "ts_us")
    return flows.digest_runs(checks, M.settings(), before, F.col("ts"), _ORDER).select("localDate", "event_id")


@query
def digest_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of the days that three batches of checks start; a day the first batch started is not started again."""
    log = BatchLog(work_dir(spark, "digest_gate"), T.StructType.fromDDL("localDate string"))
    latest, checks = _latest(spark, sf), M.events(spark, sf).select("event_id", "ts", "ts_us")
    parts = [checks.filter(F.col("event_id") % 3 == i) for i in range(3)]
    found = [flows.run_digests(part, latest, M.settings(), log, i, F.col("ts"), _ORDER) for i, part in enumerate(parts)]
    return reduce(DataFrame.unionByName, found)


@query
def notification_flow(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_commands(flows.notifications(M.person_events(spark, sf).drop("ts"), M.settings(), "ts_us", _TIE))


@query
def digest_flow(spark: SparkSession, sf: str) -> DataFrame:
    return flows.digests(_latest(spark, sf), M.settings(), M.SUMMARY_DATE)


@query
def digest_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Digest content by manager and page, with the body it renders to."""
    plan = M.settings()
    pages = digest.digest_pages(_latest(spark, sf), managers_table(spark, plan), plan.default_manager, M.SUMMARY_DATE)
    totals = F.struct("totalIssues", "totalExpired", "totalExpiring", "totalMissing", "totalNotApproved")
    html = render.digest_html(
        F.col("managerName"), F.col("summaryDate"), totals, F.col("departments"), "Example Council", F.col("page"), F.col("pages")
    )
    return pages.select("manager", "page", "pages", "totalIssues", F.size("departments").alias("sections"), html.alias("html"))


@query
def delivery_flow(spark: SparkSession, sf: str) -> DataFrame:
    commands = notify.alert_commands(
        M.person_events(spark, sf).withColumn("createdAt", F.col("processedAt")), M.settings()
    )
    timed = commands.withColumns(
        {
            "notificationId": F.concat("userId", F.lit("-"), "issueType"),
            "at_us": F.unix_micros(F.to_timestamp("createdAt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX")),
        }
    ).select("notificationId", "userId", "to", "issueType", "createdAt", "at_us")
    return flows.deliveries(timed, _failures(timed), "at_us", ["createdAt"], F.col("createdAt"))


@query
def latest_person(spark: SparkSession, sf: str) -> DataFrame:
    """Latest status by address, so a stand-in id does not outlive its person."""
    rows = M.person_events(spark, sf).select("userId", "email", "compliance_status", "event_id", "ts_us")
    return dedup.latest_per_person(rows, _ORDER).select("userId", "email", "compliance_status", "event_id")


@query
def issues_view(spark: SparkSession, sf: str) -> DataFrame:
    return flows.open_notifiable(_latest(spark, sf)).select("userId", "compliance_status", "department", "event_id")


# --- streams ------------------------------------------------------------------


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream of files."""
    schema = M.table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parquet*")


def _stream_events(spark: SparkSession, sf: str) -> DataFrame:
    df = _stream(spark, sf, "events")
    return df.withColumn("ts_us", S.epoch_micros(F.col("ts"), df.schema["ts"].dataType.simpleString()))


@query
def status_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_dir(spark, "status_stream")

    def judge(batch: DataFrame, people: DataFrame) -> DataFrame:
        return classify.classify(classify.children_checks(batch), people, M.as_of(), _processed())

    rows = M.credentials_of(_stream(spark, sf, "orders"))
    streams.run(streams.status_stream(rows, lambda: M.required_people(spark, sf), judge, f"{folder}/out", f"{folder}/cp"))
    return _flat_status(spark.read.parquet(f"{folder}/out").drop("batch"))


_LANDINGS, _JITTER_US, _DELAY_S = 4, 6 * 3600 * 1_000_000, 12 * 3600


def _landings(spark: SparkSession, sf: str, path: str) -> Iterator[int]:
    """Events land in batches of files, up to six hours out of order; the last landing only tells the time."""
    df = M.events(spark, sf)
    low, high = df.agg(F.min("ts_us"), F.max("ts_us")).first()
    tick = F.lit(False).alias("tick")
    arrival = F.col("ts_us") + F.pmod(F.xxhash64("event_id"), F.lit(_JITTER_US)) - F.lit(low)
    batch = F.floor(arrival * _LANDINGS / F.lit(high - low + _JITTER_US)).cast("int")
    for number in range(_LANDINGS):
        df.filter(batch == number).select("*", tick).write.mode("append").parquet(path)
        yield number
    last = spark.range(1).select(
        *[F.lit(high + 100 * 86400 * 1_000_000 if c == "ts_us" else None).cast(df.schema[c].dataType).alias(c) for c in df.columns],
        F.lit(True).alias("tick"),
    )
    last.write.mode("append").parquet(path)
    yield _LANDINGS


def _throttled_events(
    spark: SparkSession, sf: str, name: str, shape: Callable[[DataFrame], DataFrame], keys: Sequence[str], wait: Column | int,
    longest: int, fingerprint: str | None = None,
) -> DataFrame:
    """What keyed state lets pass of the events, landing by landing; each run takes up where the last one stopped."""
    folder = work_dir(spark, name)
    schema = M.events(spark, sf).schema.add("tick", "boolean")
    for _ in _landings(spark, sf, f"{folder}/in"):
        rows = shape(spark.readStream.schema(schema).parquet(f"{folder}/in"))
        kept = keyed.throttled(rows, keys, "ts_us", _TIE, wait, longest, _DELAY_S, fingerprint, tick="tick")
        with streams.rocksdb(spark):
            streams.run(streams.append_files(kept, f"{folder}/out", f"{folder}/cp"))
    return spark.read.schema(kept.schema).parquet(f"{folder}/out").filter("NOT late").drop("late", "tick")


@query
def notification_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Alert commands of a status stream, under the frequency rules."""
    wait = dedup.cooldown_wait(rules.interval_seconds(M.settings().frequency_rules, F.col("daysUntilExpiry")))

    def shape(events: DataFrame) -> DataFrame:
        status = M.status_core(events).drop("ts", "user_id").withColumn("tick", F.col("event_id").isNull())
        return status.filter(P.should_notify(F.col("compliance_status")) | F.col("tick"))

    longest = K.COOLDOWN_TTL_S * 1_000_000
    kept = _throttled_events(spark, sf, "notification_stream", shape, ["userId", "compliance_status"], wait, longest)
    return _flat_commands(notify.alert_commands(kept, M.settings()))


@query
def cooldown_stream(spark: SparkSession, sf: str) -> DataFrame:
    wait = 86400 * 1_000_000

    def shape(events: DataFrame) -> DataFrame:
        return events.select("event_id", "user_id", "event_type", "ts_us", "tick")

    return _throttled_events(spark, sf, "cooldown_stream", shape, ["user_id", "event_type"], wait, wait)


@query
def change_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The change filter with lifetime, continuously."""
    bucket = F.floor(F.col("value") / 100).cast("long")
    wait = K.CREDENTIAL_TTL_S * 1_000_000 - 1

    def shape(events: DataFrame) -> DataFrame:
        return events.select("event_id", "user_id", "event_type", "ts_us", S.fingerprint([("bucket", bucket)]).alias("fingerprint"), "tick")

    return _throttled_events(spark, sf, "change_stream", shape, ["user_id", "event_type"], wait, wait, "fingerprint").drop("ts_us")


@query
def once_per_id_stream(spark: SparkSession, sf: str) -> DataFrame:
    wait = K.COMMAND_TTL_S * 1_000_000 - 1

    def shape(events: DataFrame) -> DataFrame:
        name = F.concat(F.col("user_id").cast("string"), F.lit("-"), "event_type")
        return events.select(name.alias("notificationId"), "event_id", "ts_us", "tick")

    kept = _throttled_events(spark, sf, "once_per_id_stream", shape, ["notificationId"], wait, wait)
    return kept.select("event_id", "notificationId")


@query
def redelivery_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Event ids delivered twice, passed once."""
    folder = work_dir(spark, "redelivery_stream")
    twice = _stream_events(spark, sf).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        F.col("event_id").cast("string").alias("notificationId"), F.col("ts").cast("timestamp").alias("at")
    )
    once = streams.drop_redeliveries(twice, "notificationId", "at").select("notificationId")
    streams.run(streams.append_files(once, f"{folder}/out", f"{folder}/cp"))
    return spark.read.schema(once.schema).parquet(f"{folder}/out")


@query
def latest_status_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_dir(spark, "latest_status_stream")
    schema = T.StructType.fromDDL("userId string, compliance_status string, event_id long, ts_us long")
    table = KeyedTable(f"{folder}/latest", schema, ["userId"])
    events = M.events(spark, sf).schema.add("tick", "boolean")
    for _ in _landings(spark, sf, f"{folder}/in"):
        status = M.choose(F.col("event_type"), M.STATUS_OF_EVENT).alias("compliance_status")
        rows = spark.readStream.schema(events).parquet(f"{folder}/in").filter("NOT tick")
        rows = rows.select(F.col("user_id").cast("string").alias("userId"), status, "event_id", "ts_us")
        streams.run(streams.latest_table(rows, table, _ORDER, f"{folder}/cp"))
    return table.read(spark).select("userId", "compliance_status", "event_id")


@query
def digest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Manager digests from counts that each landing of events only corrects."""
    folder, plan = work_dir(spark, "digest_incremental"), M.settings()
    people = KeyedTable(f"{folder}/people", T.StructType.fromDDL("userId string, compliance_status string, department string, event_id long, ts_us long"), ["userId"])
    names = ("totalCount", "expiredCount", "expiringCount", "missingCount", "notApprovedCount")
    counts = KeyedTable(f"{folder}/counts", T.StructType.fromDDL("department string, " + ", ".join(f"{n} long" for n in names)), ["department"], 4)
    schema = M.events(spark, sf).schema.add("tick", "boolean")
    for _ in _landings(spark, sf, f"{folder}/in"):
        arrived = spark.readStream.schema(schema).parquet(f"{folder}/in").filter("NOT tick").drop("tick")
        rows = M.with_people(M.status_core(arrived), M.table(spark, sf, "customer")).select(*people.schema.names)
        streams.run(streams.summary_tables(rows, people, counts, _ORDER, f"{folder}/cp"))
    summary = counts.read(spark).filter("totalCount > 0")
    return digest.manager_digest(summary, managers_table(spark, plan), plan.default_manager, M.SUMMARY_DATE)


@query
def message_rate_stream(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_dir(spark, "message_rate_stream")
    rows = _stream(spark, sf, "events").select(F.col("event_type").alias("topic"), F.col("ts").cast("timestamp").alias("at"))
    rate = streams.message_rate_stream(rows, "at")
    streams.run(streams.per_batch(rate, lambda b: b, f"{folder}/out", f"{folder}/cp", mode="update"))
    counts = spark.read.parquet(f"{folder}/out").groupBy("topic", "minute").agg(F.max("messages").alias("messages"))
    return counts.withColumn("minute", _stamp("minute"))
