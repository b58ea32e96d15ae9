"""Streams over several micro-batches give what their batch twins give."""

import random

import pytest
from pyspark.sql import functions as F

from attestal import schemas
from attestal.operators import dedup, monitor
from attestal.operators.throttle import throttle
from attestal.sources import decode
from attestal.sources.readers import TopicStore, keyed_json
from attestal.streaming import streams

HOUR = 3600 * 1_000_000
SCHEMA = "k string, t long, id long, f string, topic string, at timestamp"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    times = sorted(rnd.randrange(24 * 12 * HOUR) for _ in range(600))
    return [
        ("hot" if rnd.random() < 0.35 else f"k{rnd.randrange(15)}", t, i, rnd.choice("aab"), rnd.choice("xy"))
        for i, t in enumerate(times)
    ]


@pytest.fixture()
def source(spark, rows, tmp_path):
    """Files in time order, read one per micro-batch."""
    for i in range(0, len(rows), 150):
        part = spark.createDataFrame(rows[i : i + 150], "k string, t long, id long, f string, topic string")
        part.withColumn("at", F.timestamp_micros("t")).repartition(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    return stream, spark.read.schema(SCHEMA).parquet(str(tmp_path / "in"))


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def start(stream, tmp_path, wait, **options):
    return streams.throttle_stream(stream, ["k"], "t", ["id"], wait, str(tmp_path / "w"), str(tmp_path / "cp"), **options)


def out(spark, tmp_path):
    return spark.read.parquet(str(tmp_path / "w" / "out"))


@pytest.mark.parametrize("options", [{}, {"hot_rows": 30}, {"keep_us": 24 * HOUR}])
def test_cooldown(spark, source, tmp_path, options):
    stream, batch = source
    streams.run(start(stream, tmp_path, 24 * HOUR, **options))
    assert ids(out(spark, tmp_path)) == ids(throttle(batch, ["k"], "t", ["id"], 24 * HOUR))


@pytest.mark.parametrize("options", [{}, {"hot_rows": 30}])
def test_change_filter_ttl(spark, source, tmp_path, options):
    stream, batch = source
    ttl = 3 * 86400
    streams.run(start(stream, tmp_path, ttl * 1_000_000 - 1, fingerprint="f", **options))
    assert ids(out(spark, tmp_path)) == ids(dedup.change_filter_ttl(batch, ["k"], "t", ["id"], "f", ttl))


def test_latest(spark, source, tmp_path):
    stream, batch = source
    latest = streams.latest_stream(stream, ["k"], ["t", "id"])
    streams.run(streams.per_batch(latest, lambda b: b, str(tmp_path / "out"), str(tmp_path / "cp"), mode="update"))
    updates = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert updates.count() > 16
    assert ids(dedup.latest_per_key(updates, ["k"], ["t", "id"])) == ids(dedup.latest_per_key(batch, ["k"], ["t", "id"]))


def test_rate(spark, source, tmp_path):
    stream, batch = source
    rate = streams.message_rate_stream(stream, "at")
    streams.run(streams.per_batch(rate, lambda b: b, str(tmp_path / "out"), str(tmp_path / "cp"), mode="update"))
    got = spark.read.parquet(str(tmp_path / "out")).groupBy("topic", "minute").agg(F.max("messages").alias("messages"))
    want = monitor.message_rate(batch, ts="at")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_redeliveries(spark, source, tmp_path):
    stream, batch = source
    twice = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    once = streams.drop_redeliveries(twice, "id", "at")
    streams.run(streams.append_files(once.select("id"), str(tmp_path / "out"), str(tmp_path / "cp")))
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == ids(batch)


def test_rerun_adds_nothing(spark, source, tmp_path):
    stream, _ = source
    for _ in range(2):
        streams.run(start(stream, tmp_path, 24 * HOUR))
    found = ids(out(spark, tmp_path))
    assert found and len(found) == len(set(found))


def test_a_failed_batch_is_made_good(spark, source, tmp_path):
    """A batch that died after writing part of its work gives the same rows when repeated."""
    stream, batch = source
    broken = {"left": 1}

    def fail_once(rows):
        if broken["left"]:
            broken["left"] = 0
            raise RuntimeError("lost")
        return rows

    query = streams.per_batch(stream, fail_once, str(tmp_path / "out"), str(tmp_path / "cp"))
    with pytest.raises(Exception, match="lost"):
        streams.run(query)
    streams.run(streams.per_batch(stream, fail_once, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == ids(batch)


def test_credentials_wait_for_the_list(spark, source, tmp_path):
    stream, batch = source
    listed = []

    def people():
        return spark.createDataFrame(listed, "k string")

    def start_status():
        return streams.status_stream(
            stream, people, lambda rows, names: rows.join(names, "k", "left_semi"), str(tmp_path / "out"), str(tmp_path / "cp")
        )

    with pytest.raises(Exception, match="no required list yet"):
        streams.run(start_status())
    listed.append(("hot",))
    streams.run(start_status())
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == ids(batch.filter("k = 'hot'"))


def test_topic_to_topic(spark, tmp_path):
    """A stream from one topic folder to another, decoded and keyed on the way."""
    store = TopicStore(str(tmp_path / "topics"), "json")
    sent = spark.createDataFrame([("n1", "u1", "a@example.org", "EXPIRED", "t", True, None)], schemas.SENT)
    broken = spark.createDataFrame([("x", "{broken")], "key string, value string")
    store.append(keyed_json(sent, "userId").unionByName(broken), "in")
    typed = decode.decode_valid(store.scan(spark, "in", stream=True), "value", schemas.SENT, decode.OPTIONAL_IN_SENT)
    writer = store.stream_to(keyed_json(typed, "notificationId"), "out", str(tmp_path / "cp"))
    streams.run(writer.trigger(**streams.AVAILABLE_NOW).start())
    row = store.scan(spark, "out").first()
    assert row["key"] == "n1" and '"errorMessage":null' in row["value"]
    assert store.scan(spark, "out").count() == 1
