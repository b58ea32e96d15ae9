"""The five-person scenario and the parts it is made of."""

import json

import pytest
from pyspark.sql import functions as F

from attestal import schemas
from attestal.functions import render
from attestal.operators import classify, dedup, digest, notify
from attestal.plans import flows
from attestal.sources import decode, readers
from attestal.sources.config import IssueType, Settings

AS_OF = "2024-12-01"


def document(user, first, last, status, approval, date, number="W1", kind="Working With Children Check", **extra):
    person = {"id": user, "first_name": first, "last_name": last}
    attributes = {"credential_number": number}
    if date:
        attributes["expiry_period_end_date"] = dict(zip(("year", "month", "day"), date, strict=True))
    doc = {
        "subject_org_id": "o",
        "subject_user_id": user,
        "document_type_id": "t",
        "document_id": f"d-{user}",
        "document_version_id": "1",
        "attributes": attributes,
        "metadata": {
            "created_at": "x",
            "created_by_user": person,
            "last_modified": "x",
            "last_modified_by_user": person,
            "expiry_status": f"EXPIRY_STATUS_{status}",
            "approval": {"status": f"DOCUMENT_APPROVAL_STATUS_{approval}", "reason": ""},
        },
        "subject_user": person,
        "document_type": {"id": "t", "name": kind},
    }
    return {**doc, **extra}


FIVE = [
    document("u1", "Ada", "One", "EXPIRED", "APPROVED", (2024, 11, 1)),
    document("u2", " BEN", "two ", "EXPIRING_SOON", "APPROVED", (2024, 12, 20)),
    document("u4", "Di", "Four", "VALID", "APPROVED", (2026, 12, 31)),
    document("u5", "Ed", "Five", "VALID", "PENDING", (2026, 12, 31)),
    document("u9", "Ed", "Five", "VALID", "APPROVED", (2026, 12, 31), kind="Driver License"),
]
PEOPLE = [
    ("one@example.org", "Ada", "One", "IT Services", "P", True, "2020-01-01"),
    ("two@example.org", "Ben", "Two", "Community Services", "P", True, "2020-01-01"),
    ("three@example.org", "Cy", "Three", "Youth Programs", "P", True, "2020-01-01"),
    ("four@example.org", "Di", "Four", "Recreation", "P", True, "2020-01-01"),
    ("five@example.org", "Ed", "Five", "Education", "P", True, "2020-01-01"),
    ("six@example.org", "Flo", "Six", "Education", "P", False, "2020-01-01"),
]


@pytest.fixture()
def snapshot_dir(tmp_path):
    pages = [FIVE[:3], FIVE[3:]]
    for i, page in enumerate(pages):
        text = json.dumps({"next_page_token": "", "latest_document_versions": page}, indent=2)
        (tmp_path / f"page{i}.json").write_text(text)
    (tmp_path / "broken.json").write_text("{ invalid json }")
    half = [document("x1", "A", "B", "VALID", "APPROVED", None), document("x2", None, "B", "VALID", "APPROVED", None)]
    (tmp_path / "half.json").write_text(json.dumps({"next_page_token": "", "latest_document_versions": half}))
    (tmp_path / "empty.json").write_text(json.dumps({"next_page_token": "", "latest_document_versions": []}))
    return str(tmp_path)


def people(spark):
    return spark.createDataFrame(PEOPLE, schemas.REQUIRED_PERSON)


def statuses(spark, path):
    creds = classify.flatten_credentials(readers.read_snapshots(spark, path), "2024-12-01T00:00:00Z")
    return flows.compliance(creds, people(spark), F.lit(AS_OF).cast("date"), F.lit("2024-12-01T00:00:00Z"))


def test_snapshot_fails_as_a_whole(spark, snapshot_dir):
    assert {r["subject_user_id"] for r in readers.read_snapshots(spark, snapshot_dir).collect()} == {"u1", "u2", "u4", "u5", "u9"}


def test_five_people(spark, snapshot_dir):
    got = {r["lastName"].strip().lower(): (r["compliance_status"], r["daysUntilExpiry"]) for r in statuses(spark, snapshot_dir).collect()}
    assert got == {
        "one": ("EXPIRED", -30),
        "two": ("EXPIRING", 19),
        "three": ("MISSING", None),
        "four": ("COMPLIANT", 760),
        "five": ("NOT_APPROVED", 760),
    }


def test_status_record_shape(spark, snapshot_dir):
    df = statuses(spark, snapshot_dir)
    assert df.schema.simpleString() == schemas.STATUS.simpleString()
    text = readers.keyed_json(df, "userId").filter("key = 'u4'").first()["value"]
    assert json.loads(text)["flags"] == [] and list(json.loads(text)) == [f.name for f in schemas.STATUS]
    back = decode.decode_valid(readers.keyed_json(df, "userId"), "value", schemas.STATUS, decode.OPTIONAL_IN_STATUS)
    assert back.count() == 5


def test_commands_once_then_none(spark, snapshot_dir):
    plan = Settings(cc_recipients=("cc@example.org",))
    status = statuses(spark, snapshot_dir)
    first = flows.notifications(status.withColumn("t", F.lit(0).cast("long")), plan, "t", ["userId"])
    assert first.count() == 4
    again = status.withColumn("t", F.explode(F.array(F.lit(0).cast("long"), F.lit(60_000_000).cast("long"))))
    assert flows.notifications(again, plan, "t", ["userId"]).count() == 4
    row = first.filter("issueType = 'MISSING'").first()
    assert (row["to"], row["cc"], row["bcc"], row["priority"]) == (["three@example.org"], ["cc@example.org"], None, "HIGH")
    assert row["subject"] == "WWCC Compliance Alert: MISSING - Cy Three"
    assert first.schema.simpleString() == schemas.COMMAND.simpleString()


def test_priority_and_recipient_options(spark):
    plan = Settings(issue_types={"EXPIRED": IssueType("HIGH", "x.html")}, override_recipient="test@example.org")
    df = spark.createDataFrame([("EXPIRED", "a@example.org"), ("OTHER", None)], "s string, e string")
    got = df.select(
        notify.priority_of(F.col("s"), plan), notify.template_of(F.col("s"), plan), notify.recipients(F.col("e"), plan.override_recipient)
    ).collect()
    assert [tuple(r) for r in got] == [
        ("HIGH", "x.html", ["test@example.org"]),
        ("MEDIUM", "wwcc-individual-alert.html", ["test@example.org"]),
    ]
    assert [r[0] for r in df.select(notify.recipients(F.col("e"), None)).collect()] == [["a@example.org"], []]


def test_delivery_events(spark, snapshot_dir):
    plan = Settings()
    commands = notify.alert_commands(statuses(spark, snapshot_dir).filter("compliance_status <> 'COMPLIANT'"), plan)
    bad = commands.filter("userId = 'u1'").select("notificationId", F.lit("refused").alias("errorMessage"))
    events = {r["userId"]: r for r in notify.delivery_events(commands, bad, F.lit("now")).collect()}
    assert (events["u1"]["success"], events["u1"]["errorMessage"]) == (False, "refused")
    assert (events["u2"]["success"], events["u2"]["errorMessage"], events["u2"]["email"]) == (True, None, "two@example.org")
    assert notify.unsent(commands, bad).count() == commands.count() - 1


def test_body_and_retry(spark, snapshot_dir):
    commands = notify.alert_commands(statuses(spark, snapshot_dir), Settings())
    mixed = commands.withColumn("isHtml", F.col("userId") != "u1")
    bodies = {r["userId"]: r["body"] for r in notify.with_body(mixed).collect()}
    assert bodies["u1"].startswith("Dear Ada One,") and bodies["u2"].startswith("<!DOCTYPE html>")
    bad = commands.filter("userId = 'u1'").select("notificationId", F.lit("refused").alias("errorMessage"))
    events = notify.delivery_events(commands, bad, F.lit("now"))
    assert [r["userId"] for r in notify.failed(commands, events).collect()] == ["u1"]


def test_latest_by_person_replaces_the_missing_row(spark):
    rows = [("stand-in", "a@example.org", 1), ("u1", "a@example.org", 2), ("u2", None, 1)]
    df = spark.createDataFrame(rows, "userId string, email string, t long")
    assert sorted(r["userId"] for r in dedup.latest_per_person(df, ["t"]).collect()) == ["u1", "u2"]
    assert dedup.latest_per_key(df, ["userId"], ["t"]).count() == 3


def issues(spark):
    rows = [
        ("a", "IT", "EXPIRED"),
        ("b", "IT", "EXPIRED"),
        ("c", "IT", "EXPIRING"),
        ("d", "IT", "MISSING"),
        ("e", "IT", "NOT_APPROVED"),
        ("f", "HR", "MISSING"),
        ("g", None, "UNEXPECTED"),
        ("h", "HR", "COMPLIANT"),
    ]
    return spark.createDataFrame(rows, "userId string, department string, compliance_status string").select(
        "*",
        F.lit("F").alias("firstName"),
        F.col("userId").alias("lastName"),
        F.lit(None).cast("string").alias("email"),
        F.lit("Boss & Co").alias("position"),
        F.lit(None).cast("string").alias("wwccNumber"),
        F.lit(None).cast("string").alias("expiryDate"),
        F.lit(3).cast("long").alias("daysUntilExpiry"),
    )


def test_department_summary(spark):
    got = {r["department"]: tuple(r)[1:] for r in digest.department_summary(issues(spark)).collect()}
    assert got == {"IT": (5, 2, 1, 1, 1), "HR": (1, 0, 0, 1, 0), "Unknown": (1, 0, 0, 0, 0)}
    assert digest.department_summary(issues(spark).filter("compliance_status = 'COMPLIANT'")).count() == 0
    other = {r["department"]: r["otherCount"] for r in digest.department_summary(issues(spark), other=True).collect()}
    assert other == {"IT": 0, "HR": 0, "Unknown": 1}


def test_manager_digest_and_command(spark):
    managers = spark.createDataFrame([("IT", "john.doe@example.com"), ("HR", "john.doe@example.com")], "department string, manager string")
    rows = digest.manager_digest(digest.department_summary(issues(spark)), managers, "nobody", "2024-02-01")
    got = {r["manager"]: r for r in rows.collect()}
    john, other = got["john.doe@example.com"], got["nobody"]
    assert (john["totalIssues"], john["totalExpired"], john["totalExpiring"], john["totalMissing"], john["totalNotApproved"]) == (6, 2, 1, 2, 1)
    assert (john["department"], john["managerName"], john["priority"]) == ("HR", "john.doe", "HIGH")
    assert (other["managerName"], other["priority"], other["totalIssues"]) == ("Manager", "MEDIUM", 1)
    commands = {r["userName"]: r for r in notify.digest_commands(rows, Settings(), F.lit("now")).collect()}
    assert commands["HR Manager"]["subject"] == "Weekly WWCC Compliance Digest - HR (6 issues)"
    assert commands["HR Manager"]["to"] == ["john.doe@example.com"]
    over = notify.digest_commands(rows, Settings(override_recipient="t@example.org"), F.lit("now"))
    assert {tuple(r["to"]) for r in over.collect()} == {("t@example.org",)}


@pytest.mark.parametrize("size", [500, 2])
def test_digest_pages_lose_nothing(spark, size):
    managers = spark.createDataFrame([("IT", "m@example.org")], "department string, manager string")
    pages = digest.digest_pages(issues(spark), managers, "hr@example.org", "2024-02-01", size)
    listed = pages.select("manager", F.explode("departments").alias("d")).select("manager", F.explode("d.issues").alias("i"))
    assert sorted(r["userId"] for r in listed.select("i.userId").collect()) == list("abcdefg")
    assert {r["totalIssues"] for r in pages.filter("manager = 'm@example.org'").collect()} == {5}
    whole = {r["department"]: r["totalCount"] for r in digest.department_summary(issues(spark)).collect()}
    assert all(d["totalCount"] == whole[d["department"]] for r in pages.collect() for d in r["departments"])
    if size == 500:
        assert {r["pages"] for r in pages.collect()} == {1}
        by_dept = digest.department_issues(issues(spark)).filter("department = 'IT'").first()
        assert [i["userId"] for i in by_dept["issues"]] == list("abcde")


def test_html(spark):
    row = ("Ann <Lee>", "EXPIRED", "W&1", None, None, "now")
    df = spark.createDataFrame([row], "u string, k string, n string, e string, d long, t string")
    html = df.select(render.alert_html(*[F.col(c) for c in "ukned"], F.col("t"))).first()[0]
    assert "Dear Ann &lt;Lee&gt;," in html and "<td>W&amp;1</td>" in html
    assert "EXPIRED - Immediate Action Required" in html and "Expiry Date" not in html and "Days Until" not in html
    managers = spark.createDataFrame([("IT", "m@example.org")], "department string, manager string")
    pages = digest.digest_pages(issues(spark), managers, "hr@example.org", "2024-02-01")
    totals = F.struct("totalIssues", "totalExpired", "totalExpiring", "totalMissing", "totalNotApproved")
    bodies = {
        r[0]: r[1]
        for r in pages.select("manager", render.digest_html(F.col("managerName"), F.col("summaryDate"), totals, F.col("departments"))).collect()
    }
    assert "5 Issues • 2 Expired • 1 Expiring • 1 Missing • 1 Not Approved" in bodies["m@example.org"]
    assert "Boss &amp; Co" in bodies["m@example.org"] and "<td>—</td>" in bodies["m@example.org"]
    assert "All Clear - No Critical Issues" in bodies["hr@example.org"] and "in your departments." in bodies["hr@example.org"]
    assert "in your department." in bodies["m@example.org"]


def test_matching(spark):
    creds = spark.createDataFrame(
        [("1", "  MARY-jane", "O'Brien\t"), ("2", "Mary", "Jane")], "documentId string, firstName string, lastName string"
    )
    listed = [("z@example.org", "Mary-Jane", "O'Brien", "IT", "P", True, "x"), ("a@example.org", "mary-jane ", "o'brien", "HR", "P", True, "x")]
    got = classify.match_people(creds, spark.createDataFrame(listed, schemas.REQUIRED_PERSON)).collect()
    assert {r["documentId"]: (r["email"], r["matched"]) for r in got} == {"1": ("a@example.org", True), "2": (None, False)}


def test_latest_list_replaces_and_last_duplicate_wins(spark):
    def entry(email, last):
        return dict(zip([f.name for f in schemas.REQUIRED_PERSON], (email, "A", last, "D", "P", True, "2020-01-01"), strict=True))

    def message(*entries):
        return json.dumps({"requiredUsers": list(entries), "timestamp": "t"})

    rows = [
        (1, 0, message(entry("old@example.org", "Gone"))),
        (2, 0, message(entry("x1@example.org", "X"), entry("x2@example.org", " x"))),
        (2, 1, message(entry("y@example.org", "Y"))),
        (3, 0, json.dumps({"requiredUsers": [{"email": "bad@example.org"}], "timestamp": "t"})),
    ]
    df = spark.createDataFrame(rows, "v long, part long, value string")
    assert {r["email"] for r in decode.latest_required_people(df, "v", "part", "value").collect()} == {"x2@example.org", "y@example.org"}


def test_short_list_variant(spark):
    text = json.dumps({"requiredUsers": [{"email": "a@example.org", "firstName": "A", "lastName": "B", "requiredBecause": "Pool"}]})
    got = decode.people_from_short_list(spark.createDataFrame([(text,)], "value string"), "value").first()
    assert (got["department"], got["position"], got["requiresWwcc"], got["startDate"]) == ("Pool", None, True, None)


def test_quarantine_keeps_the_text(spark):
    rows = [('{"notificationId":"1"}',), ("not json",), ('{"notificationId":12',), (None,), ("{}",)]
    df = spark.createDataFrame(rows, "value string")
    kept = decode.decode_quarantine(df, "value", schemas.COMMAND, decode.OPTIONAL_IN_COMMAND)
    assert kept.count() == 5 and kept.columns == ["value"]
    good = '{"notificationId":"1","userId":"u","email":"e","issueType":"i","sentAt":"t","success":true,"extra":1}'
    typed = decode.decode_valid(spark.createDataFrame([(good,)], "value string"), "value", schemas.SENT, decode.OPTIONAL_IN_SENT)
    assert typed.first()["success"] is True
    wrong = good.replace("true", '"yes"')
    assert decode.decode_valid(spark.createDataFrame([(wrong,)], "value string"), "value", schemas.SENT, decode.OPTIONAL_IN_SENT).count() == 0


def test_directory_csv(spark, tmp_path):
    (tmp_path / "d.csv").write_text("UUID,EMAIL,FIRST NAME,LAST NAME\nid1,a@example.org,Ann,Lee\n")
    assert tuple(readers.read_directory(spark, str(tmp_path / "d.csv")).first()) == ("id1", "a@example.org", "Ann", "Lee")


def test_topic_folder_round_trip(spark, tmp_path):
    store = readers.TopicStore(str(tmp_path), "json")
    rows = spark.createDataFrame([("k", "v"), (None, "w")], "key string, value string")
    store.append(rows, "topic")
    store.append(rows, "topic")
    assert sorted((r["key"] or "", r["value"]) for r in store.scan(spark, "topic").collect()) == [("", "w"), ("", "w"), ("k", "v"), ("k", "v")]


def test_credential_fingerprint_moves_with_its_fields(spark):
    docs = [FIVE[0], FIVE[0], document("u1", "Ada", "One", "EXPIRED", "PENDING", (2024, 11, 1))]
    df = decode.snapshot_documents(
        spark.createDataFrame([(json.dumps({"next_page_token": "", "latest_document_versions": docs}),)], "value string"), "value"
    )
    from attestal.functions.scalar import credential_fingerprint

    a, b, c = [r[0] for r in df.select(credential_fingerprint(F.struct(*df.columns))).collect()]
    assert a == b != c
