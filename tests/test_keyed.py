"""Keyed state of streams: order, lateness and memory."""

import pickle
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from attestal.operators import dedup
from attestal.operators.throttle import throttle
from attestal.streaming import keyed, streams

HOUR = 3600 * 1_000_000
BASE = 1_700_000_000 * 1_000_000
SCHEMA = "k string, t long, id long, f string, w long, at timestamp, d double, tick boolean"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    found = []
    for i in range(600):
        key = "hot" if rnd.random() < 0.35 else rnd.choice([None, *[f"k{j}" for j in range(15)]])
        t = BASE + (rnd.randrange(24 * 12) * HOUR if i % 3 else rnd.randrange(24 * 12 * HOUR))
        found.append((key, t, rnd.choice([i, -i]), rnd.choice(["a", "a", "b", None]), rnd.choice([6, 24]) * HOUR, None, rnd.random() / 3, False))
    return found


def land(spark, rows, path, parts):
    """The rows as files in this order, and a last one that only tells the time."""
    size = -(-len(rows) // parts)
    last = (None, BASE + 60 * 24 * HOUR, None, None, None, None, None, True)
    for part in [rows[i : i + size] for i in range(0, len(rows), size)] + [[last]]:
        df = spark.createDataFrame(part, SCHEMA).withColumn("at", F.timestamp_micros(F.col("t") + 1))
        df.repartition(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def drive(spark, stream, folder, **rule):
    kept = keyed.throttled(stream, ["k"], "t", ["id"], tick="tick", buckets=4, **rule)
    with streams.rocksdb(spark):
        query = streams.append_files(kept, f"{folder}/out", f"{folder}/cp")
        streams.run(query)
    return spark.read.schema(kept.schema).parquet(f"{folder}/out"), query.recentProgress


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.mark.parametrize("order", ["disordered", "shuffled"])
@pytest.mark.parametrize("rule", ["cooldown", "change"])
def test_files_in_any_order_give_the_batch_rows(spark, rows, tmp_path, order, rule):
    rnd = random.Random(4)
    span = 24 * 14 * HOUR if order == "shuffled" else 10 * HOUR
    arriving = sorted(rows, key=lambda r: r[1] + rnd.randrange(span))
    stream = land(spark, arriving, f"{tmp_path}/in", 6)
    batch = spark.createDataFrame(rows, SCHEMA)
    delay = span // 1_000_000 + 1
    if rule == "cooldown":
        out, progress = drive(spark, stream, tmp_path, wait_us=F.col("w"), longest_wait_us=24 * HOUR, delay_s=delay)
        want = throttle(batch, ["k"], "t", ["id"], F.col("w"))
    else:
        ttl = 3 * 86400
        out, progress = drive(spark, stream, tmp_path, wait_us=ttl * 1_000_000 - 1, longest_wait_us=ttl * 1_000_000, delay_s=delay, fingerprint="f")
        want = dedup.change_filter_ttl(batch, ["k"], "t", ["id"], "f", ttl)
    assert out.filter("late").count() == 0
    assert ids(out) == ids(want)
    assert sum(p["numInputRows"] > 0 for p in progress) == 7
    # whole rows come back as they went in
    got = {r["id"]: (r["k"], r["t"], r["f"], r["d"]) for r in out.collect()}
    assert all(got[r[2]] == (r[0], r[1], r[3], r[6]) for r in rows if r[2] in got)
    assert out.filter("at <> timestamp_micros(t + 1)").count() == 0
    # nothing is remembered once nothing can be suppressed any more
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 0


def test_late_rows_are_put_aside(spark, rows, tmp_path):
    """Rows behind the watermark come out marked, all others as if those had never been."""
    ordered = sorted(rows, key=lambda r: r[1])
    late = [r for r in ordered[:300] if r[2] % 7 == 3]
    timeless = [("k1", None, 10_000, "a", HOUR, None, 0.5, False)]
    arriving = [r for r in ordered if r not in late] + late + timeless
    stream = land(spark, arriving, f"{tmp_path}/in", 8)
    out, _ = drive(spark, stream, tmp_path, wait_us=24 * HOUR, longest_wait_us=24 * HOUR, delay_s=3600)
    assert ids(out.filter("late")) == sorted([r[2] for r in late] + [10_000])
    on_time = spark.createDataFrame([r for r in ordered if r not in late], SCHEMA)
    assert ids(out.filter("not late")) == ids(throttle(on_time, ["k"], "t", ["id"], 24 * HOUR))


def test_a_restart_goes_on_where_it_stopped(spark, rows, tmp_path):
    ordered = sorted(rows, key=lambda r: r[1])
    for half in (ordered[:300], ordered[300:]):
        stream = land(spark, half, f"{tmp_path}/in", 3) if half[0] is not ordered[0] else None
        if stream is None:
            spark.createDataFrame(half, SCHEMA).repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
            stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        out, _ = drive(spark, stream, tmp_path, wait_us=24 * HOUR, longest_wait_us=24 * HOUR, delay_s=60)
    assert ids(out) == ids(throttle(spark.createDataFrame(rows, SCHEMA), ["k"], "t", ["id"], 24 * HOUR))


class FakeState:
    """What a bucket sees of its state."""

    def __init__(self):
        self.value, self.mark, self.due, self.hasTimedOut = None, 0, None, False

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentWatermarkMs(self):  # noqa: N802
        return self.mark

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutTimestamp(self, at):  # noqa: N802
        assert at >= self.mark
        self.due = at


def test_memory_is_bounded_by_the_longest_wait():
    """A stream of ever new keys: what is held is what the wait and the delay span, however long the stream runs."""
    step, state, sizes = keyed._step(24 * HOUR, 0, False), FakeState(), []
    for hour in range(24 * 60):
        state.mark = BASE // 1000 + (hour - 2) * 3_600_000
        names = ["__t", "__order", "__row", "__key", "__wait", "__mark", "__tick"]
        frame = pd.DataFrame([(BASE + hour * HOUR, "1", f"r{hour}-{i}", f"k{hour}-{i}", 24 * HOUR, "", False) for i in range(5)], columns=names)
        passed = sum(len(out) for out in step((0,), iter([frame]), state))
        assert passed == (5 if hour >= 2 else 0)
        memory, held = pickle.loads(state.get[0])
        sizes.append(len(memory) + len(held))
    assert max(sizes) <= 5 * (24 + 3) and max(sizes[-100:]) == max(sizes[100:200])
    state.mark, state.hasTimedOut = state.due + 40 * 24 * 3_600_000, True
    assert sum(len(out) for out in step((0,), iter([]), state)) == 10 and not state.exists
