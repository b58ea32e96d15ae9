"""Keyed state against plain Python, on whole, split and hot paths."""

import random

import pytest
from pyspark.sql import functions as F

from attestal.operators import cells, dedup
from attestal.operators.throttle import throttle

SECOND = 1_000_000
HOUR = 3600 * SECOND


def skewed_rows(seed, n=1500, span_hours=24 * 20):
    """(k, t, id, v, w): one key holds a third of the rows; some times repeat."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.35 else rnd.choice([None, *[f"k{j}" for j in range(40)]])
        t = rnd.randrange(span_hours) * HOUR if rnd.random() < 0.5 else rnd.randrange(span_hours * HOUR)
        rows.append((key, t, i, rnd.choice(["a", "a", "a", "b", None]), rnd.choice([6, 24, 72]) * HOUR))
    return rows


SCHEMA = "k string, t long, id long, v string, w long"


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups.values()


def model_greedy(rows, wait, force=lambda row, before: False):
    kept = set()
    for group in by_key(rows):
        last, before = None, None
        for row in group:
            if before is None or force(row, before) or row[1] > last + wait(row):
                kept.add(row[2])
                last = row[1]
            before = row
    return kept


def ids(df):
    found = [r["id"] for r in df.select("id").collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("hot_rows,max_steps", [(10**9, 400), (200, 400), (200, 0)])
@pytest.mark.parametrize("seed", [1, 2])
def test_throttle_own_wait(spark, seed, hot_rows, max_steps, monkeypatch):
    monkeypatch.setattr("attestal.operators.throttle.CELL_ROWS", 40)
    rows = skewed_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = throttle(df, ["k"], "t", ["id"], F.col("w"), hot_rows=hot_rows, max_steps=max_steps)
    assert got.columns == df.columns
    assert ids(got) == model_greedy(rows, lambda r: r[4])


@pytest.mark.parametrize("hot_rows", [10**9, 200])
def test_change_filter_ttl(spark, hot_rows):
    rows = skewed_rows(3)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("f", F.coalesce("v", F.lit("")))
    ttl = 2 * 86400
    got = dedup.change_filter_ttl(df, ["k"], "t", ["id"], "f", ttl, max_rows=hot_rows, hot_rows=hot_rows)
    want = model_greedy(rows, lambda r: ttl * SECOND - 1, lambda r, b: (r[3] or "") != (b[3] or ""))
    assert ids(got) == want


@pytest.mark.parametrize("max_rows", [10**9, 100, 7])
def test_change_filter(spark, max_rows):
    rows = skewed_rows(4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = ids(dedup.change_filter(df, ["k"], "t", ["id"], "v", max_rows=max_rows))
    want = {r[2] for g in by_key(rows) for b, r in zip([None, *g], g, strict=False) if b is None or b[3] != r[3]}
    assert got == want


def test_change_filter_twice_is_once(spark):
    df = spark.createDataFrame(skewed_rows(5), SCHEMA)
    once = dedup.change_filter(df, ["k"], "t", ["id"], "v")
    assert ids(dedup.change_filter(once, ["k"], "t", ["id"], "v")) == ids(once)


@pytest.mark.parametrize("max_rows", [10**9, 50])
def test_position(spark, max_rows):
    rows = skewed_rows(6)
    df = cells.with_position(spark.createDataFrame(rows, SCHEMA).filter("k is not null"), ["k"], "t", ["id"], "pos", max_rows)
    want = {r[2]: i for g in by_key([r for r in rows if r[0] is not None]) for i, r in enumerate(g)}
    assert {r["id"]: r["pos"] for r in df.collect()} == want


def bursts():
    """Spread rows, a burst within a thousandth of a second, and 900 rows at one moment."""
    times = [i * HOUR for i in range(900)] + [400 * HOUR + i for i in range(900)] + [500 * HOUR] * 900
    rnd = random.Random(12)
    return [("k" if i % 3 else f"k{i % 7}", t, i, rnd.choice("aab"), 0) for i, t in enumerate(times)]


def test_cells_keep_their_bound(spark):
    celled, split = cells.with_cells(spark.createDataFrame(bursts(), SCHEMA), ["t", "id"], 100)
    assert split
    sizes = [r["count"] for r in celled.groupBy(cells.CELL).count().collect()]
    assert sum(sizes) == 2700 and max(sizes) <= 100


def test_cells_rise_with_the_order(spark):
    celled, _ = cells.with_cells(spark.createDataFrame(bursts(), SCHEMA), ["t", "id"], 100)
    inside = sorted((r[cells.CELL], r["t"], r["id"]) for r in celled.collect())
    assert [r[1:] for r in inside] == sorted(r[1:] for r in inside)
    whole, split = cells.with_cells(spark.createDataFrame(bursts(), SCHEMA), ["t", "id"], 2500, ["k"])
    assert not split and {r[cells.CELL] for r in whole.collect()} == {0}


def test_cuts_do_not_grow_with_the_rows(spark, monkeypatch):
    """Passes and numbers collected are the same for ten times the rows, a third of them at one moment."""
    monkeypatch.setattr(cells, "MOST_CELLS", 64)
    plain, collected = cells._quantiles, []

    def measured(*args):
        found = plain(*args)
        collected.append([len(values) for _, values in found])
        return found

    monkeypatch.setattr(cells, "_quantiles", measured)
    told = []
    for n in (20_000, 200_000):
        df = spark.range(n).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") * F.col("id") % 100_003).alias("t"), "id")
        celled, _ = cells.with_cells(df, ["t", "id"], 50)
        sizes = [r["count"] for r in celled.groupBy(cells.CELL).count().collect()]
        assert sum(sizes) == n and max(sizes) < 0.1 * n
        told.append((len(collected), sum(map(sum, collected))))
        collected.clear()
    assert told[0][0] == told[1][0] == 2 and max(t[1] for t in told) <= 2 * 64 and told[1][1] <= told[0][1] + 8


def test_ordered_operators_over_bursts(spark):
    rows = bursts()
    df = spark.createDataFrame(rows, SCHEMA)
    groups = list(by_key(rows))
    changed = {r[2] for g in groups for b, r in zip([None, *g], g, strict=False) if b is None or b[3] != r[3]}
    assert ids(dedup.change_filter(df, ["k"], "t", ["id"], "v", max_rows=100)) == changed
    placed = cells.with_position(df, ["k"], "t", ["id"], "pos", 100)
    assert {r["id"]: r["pos"] for r in placed.collect()} == {r[2]: i for g in groups for i, r in enumerate(g)}


def test_throttle_from_memory(spark, monkeypatch):
    """What is remembered counts on every path, for rows that come late too."""
    monkeypatch.setattr("attestal.operators.throttle.CELL_ROWS", 20)
    rows = [r for r in skewed_rows(9, n=600) if r[0] is not None]
    known = {"hot": 100 * HOUR, "k1": 5 * HOUR, "k2": 10**9 * HOUR}
    kept, last = set(), dict(known)
    for key, t, i, _, w in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or t > last[key] + w:
            kept.add(i)
            last[key] = t
    df = spark.createDataFrame(rows, SCHEMA)
    memory = spark.createDataFrame(list(known.items()), "k string, __last long")
    for hot_rows, max_steps in ((10**9, 400), (100, 400), (100, 0)):
        got = throttle(df, ["k"], "t", ["id"], F.col("w"), hot_rows=hot_rows, max_steps=max_steps, initial=memory)
        assert ids(got) == kept, (hot_rows, max_steps)


def test_cooldown_is_strict_but_expiry_is_not(spark):
    day = 86400 * SECOND
    rows = [("k", t, i, "a", 0) for i, t in enumerate([0, day, day + 1, 2 * day + 1, 2 * day + 2])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert ids(dedup.cooldown(df, ["k"], "t", ["id"], 86400)) == {0, 2, 4}
    # An interval as long as the memory: the row at exactly that distance passes.
    assert ids(dedup.cooldown(df, ["k"], "t", ["id"], 86400, ttl_seconds=86400)) == {0, 1, 3}
    assert ids(dedup.once_per_id(df, "k", "t", ["id"])) == {0, 1, 3}
    assert ids(dedup.once_per_id(df, "k", "t", ["id"], ttl_seconds=None)) == {0}


def test_rerun_of_sent_rows_sends_nothing_new(spark):
    rows = skewed_rows(7)
    df = spark.createDataFrame(rows, SCHEMA)
    sent = throttle(df, ["k"], "t", ["id"], 24 * HOUR)
    assert ids(throttle(sent, ["k"], "t", ["id"], 24 * HOUR)) == ids(sent)


def test_missing_suppression_resets_with_the_list(spark):
    rows = [("a@example.org", 1, 0, 0), ("a@example.org", 1, HOUR, 1), ("a@example.org", 2, 2 * HOUR, 2), ("a@example.org", 2, 30 * HOUR, 3)]
    df = spark.createDataFrame(rows, "email string, list_version long, t long, id long")
    assert ids(dedup.missing_suppressed(df, "t", ["id"])) == {0, 2, 3}


def test_latest_and_first(spark):
    rows = skewed_rows(8)
    df = spark.createDataFrame(rows, SCHEMA).filter("k is not null")
    groups = list(by_key([r for r in rows if r[0] is not None]))
    assert ids(dedup.latest_per_key(df, ["k"], ["t", "id"])) == {g[-1][2] for g in groups}
    assert ids(dedup.first_per_key(df, ["k"], ["t", "id"])) == {g[0][2] for g in groups}
