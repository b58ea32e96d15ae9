"""Random inputs against plain Python, many examples per Spark job."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from attestal.functions import scalar as S
from attestal.functions.predicates import condition_holds
from attestal.operators.throttle import throttle

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
DATES = st.tuples(st.integers(1900, 2100), st.integers(0, 13), st.integers(0, 32))


def model_days(date, as_of):
    try:
        return (dt.date(*date) - as_of).days
    except ValueError:
        return None


@FEW
@given(st.lists(st.tuples(st.none() | DATES, st.dates(dt.date(1950, 1, 1), dt.date(2100, 1, 1))), min_size=50, max_size=200))
def test_days_until_expiry(spark, rows):
    df = spark.createDataFrame(rows, "d struct<year:int,month:int,day:int>, a date")
    got = [r[0] for r in df.select(S.days_until_expiry(F.col("d"), F.col("a"))).collect()]
    assert got == [None if d is None else model_days(d, a) for d, a in rows]


@FEW
@given(st.lists(st.text(st.characters(min_codepoint=1, max_codepoint=0x17F), max_size=6), min_size=50, max_size=200))
def test_name_key(spark, names):
    blanks = "".join(chr(i) for i in range(0x21))
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(S.name_key(F.col("n"))).collect()]
    want = [n.strip(blanks) for n in names]
    # Case folding is the platform's; what must agree is the trimming.
    assert [g.upper() for g in got] == [w.lower().upper() for w in want]


@FEW
@given(
    st.lists(st.none() | st.integers(-100, 100), min_size=50, max_size=100),
    st.sampled_from(["<", "<=", ">", ">=", "=", "!"]),
    st.integers(-50, 50),
)
def test_condition(spark, days, op, bound):
    compare = {"<": int.__lt__, "<=": int.__le__, ">": int.__gt__, ">=": int.__ge__}
    df = spark.createDataFrame([(d,) for d in days], "d long")
    got = [r[0] for r in df.select(condition_holds(f"days_until_expiry {op} {bound}", F.col("d"))).collect()]
    assert got == [op in compare and d is not None and compare[op](d, bound) for d in days]


STATUS_ROWS = st.tuples(
    st.sampled_from(["EXPIRED", "EXPIRING_SOON", "VALID", "UNKNOWN"]),
    st.sampled_from(["APPROVED", "PENDING", "UNKNOWN"]),
    st.booleans(),
    st.none() | st.integers(-3, 3),
    st.booleans(),
)


def model_status(expiry, approval, listed, since):
    if not listed:
        return "UNEXPECTED"
    if approval != "APPROVED":
        return "NOT_APPROVED"
    if since is not None and since < 0:
        return "NOT_STARTED"
    return {"EXPIRED": "EXPIRED", "EXPIRING_SOON": "EXPIRING"}.get(expiry, "COMPLIANT")


@FEW
@given(st.lists(STATUS_ROWS, min_size=50, max_size=100))
def test_status_and_flags(spark, rows):
    data = [(f"EXPIRY_STATUS_{e}", f"DOCUMENT_APPROVAL_STATUS_{a}", r, s, n) for e, a, r, s, n in rows]
    df = spark.createDataFrame(data, "e string, a string, r boolean, s long, n boolean")
    status = S.compliance_status(F.col("e"), F.col("a"), F.col("r"), F.col("s"))
    got = df.select(status.alias("st"), S.compliance_flags(status, F.col("n")).alias("fl")).collect()
    for row, (e, a, r, s, n) in zip(got, rows, strict=True):
        assert row["st"] == model_status(e, a, r, s)
        assert len(row["fl"]) == (row["st"] != "COMPLIANT") + (not n)
        assert ("NO_CREDENTIAL_NUMBER" in row["fl"]) == (not n)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("aab"), st.integers(0, 40), st.integers(0, 9), st.booleans()), min_size=20, max_size=80
    ),
    st.sampled_from([(10**9, 400), (10, 400), (10, 0)]),
)
def test_throttle(spark, rows, way):
    data = [(k, t, i, w, f) for i, (k, t, w, f) in enumerate(rows)]
    kept, last = set(), {}
    for k, t, i, w, f in sorted(data, key=lambda r: (r[1], r[2])):
        if k not in last or f or t > last[k] + w:
            kept.add(i)
            last[k] = t
    df = spark.createDataFrame(data, "k string, t long, id long, w long, f boolean")
    got = throttle(df, ["k"], "t", ["id"], F.col("w"), F.col("f"), hot_rows=way[0], max_steps=way[1])
    assert {r["id"] for r in got.select("id").collect()} == kept
