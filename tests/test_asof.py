"""As-of joins against a plain search, and lists that change while credentials come in."""

import random

import pytest
from pyspark.sql import functions as F

from attestal.operators import classify
from attestal.operators.asof import LINE_ROWS, as_of_join


@pytest.mark.parametrize("max_rows", [10**9, 40])
@pytest.mark.parametrize("keys", [["k"], []])
def test_as_of_join(spark, keys, max_rows):
    rnd = random.Random(len(keys))
    rows = [(rnd.choice([None, "a", "a", "a", "b", "c"]), rnd.choice([None, *range(200)]), i, None if i % 9 else "x") for i in range(700)]
    versions = [(rnd.choice([None, "a", "a", "b"]), rnd.choice([None, *range(-5, 220, 7)]), v) for v in range(60)]
    df = spark.createDataFrame(rows, "k string, t long, id long, note string").repartition(3)
    got = as_of_join(df, spark.createDataFrame(versions, "k string, since long, v long"), keys, "t", "since", ["v"], max_rows)
    assert got.columns == ["k", "t", "id", "note", "v"]
    want = {}
    for k, t, i, _ in rows:
        held = [(s, v) for key, s, v in versions if s is not None and t is not None and s <= t and (not keys or key == k)]
        want[i] = max(held)[1] if held else None
    assert {r["id"]: r["v"] for r in got.collect()} == want and got.count() == len(rows)


def test_without_versions_or_rows(spark):
    rows = spark.createDataFrame([("a", 1)], "k string, t long")
    none = spark.createDataFrame([], "k string, since long, v long")
    assert as_of_join(rows, none, ["k"], "t", "since", ["v"]).collect() == [("a", 1, None)]
    assert as_of_join(rows.limit(0), none, ["k"], "t", "since", ["v"]).count() == 0


def test_a_replay_meets_the_same_lists(spark):
    """A list published later changes no earlier verdict; credentials from before the first list wait for it."""
    person = "email string, firstName string, lastName string, department string, position string, requiresWwcc boolean, startDate string"
    people = [(f"{n}@x", n, "L", "D", f"P{v}", True, "2020-01-01", v, v * 100) for v, n in [(1, "Ada"), (2, "Ada"), (2, "Ben"), (3, "Ben")]]
    lists = spark.createDataFrame(people, person + ", list_version long, since_us long")
    creds = spark.createDataFrame(
        [(f"u{i}", n, "L", None, None, "EXPIRY_STATUS_VALID", "DOCUMENT_APPROVAL_STATUS_APPROVED", t) for i, (n, t) in enumerate(
            [("Ada", 5), ("Ada", 100), ("Ben", 199), ("Ben", 200), ("Ada", 299), ("Ada", 300), ("Ben", None)])],
        "userId string, firstName string, lastName string, expiry struct<year:int,month:int,day:int>, wwccNumber string, expiryStatus string, approvalStatus string, at_us long",
    )
    as_of, now = F.lit("2024-01-01").cast("date"), F.lit("t")

    def verdicts(known):
        rows = classify.classify_as_of(creds, known, "at_us", "since_us", as_of, now).collect()
        return {r["userId"]: (r["list_version"], r["compliance_status"], r["position"]) for r in rows}

    early, late = verdicts(lists.filter("list_version < 3")), verdicts(lists)
    assert early == {
        "u0": (1, "COMPLIANT", "P1"), "u1": (1, "COMPLIANT", "P1"), "u2": (1, "UNEXPECTED", None), "u3": (2, "COMPLIANT", "P2"),
        "u4": (2, "COMPLIANT", "P2"), "u5": (2, "COMPLIANT", "P2"), "u6": (1, "UNEXPECTED", None),
    }
    assert late == early | {"u5": (3, "UNEXPECTED", None)}
    assert verdicts(lists.limit(0)) == {}


def test_a_line_without_keys_is_cut_long_before_it_fills_a_task(spark):
    rows = spark.range(LINE_ROWS + 9).selectExpr("id AS t", "id", "repeat('x', 20) AS note")
    versions = spark.createDataFrame([(0, 1), (70_000, 2), (LINE_ROWS, 3)], "since long, v long")
    got = as_of_join(rows, versions, [], "t", "since", ["v"])
    assert "__entry" in got._jdf.queryExecution().analyzed().toString()
    assert {r["v"]: r["count"] for r in got.groupBy("v").count().collect()} == {1: 70_000, 2: LINE_ROWS - 70_000, 3: 9}


def test_people_are_spread_before_they_are_sorted(spark):
    """A list in one file does not put all its people, or all of one name, into one task's sort."""
    people = spark.range(4000).selectExpr(
        "concat('u', id, '@x') AS email", "if(id % 2 = 0, 'Ada', concat('N', id)) AS firstName", "'L' AS lastName", "'D' AS department",
        "'P' AS position", "true AS requiresWwcc", "cast(null AS string) AS startDate",
    ).coalesce(1)
    found = classify.unique_people(people)
    assert {r["firstName"]: r["email"] for r in found.collect()} == {"Ada": "u0@x"} | {f"N{i}": f"u{i}@x" for i in range(1, 4000, 2)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
