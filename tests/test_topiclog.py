"""Logs with offsets: dense numbers, pruned scans, batches seen whole."""

import random

import pytest
from pyspark.sql import functions as F

from attestal.sources import published
from attestal.sources.topiclog import TopicLog

SCHEMA = "topic string, partition int, key string, value string, ts timestamp_ntz, t long"


@pytest.fixture(scope="module")
def batches(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("ab"), 0 if rnd.random() < 0.6 else rnd.randrange(1, 3), f"k{i}", f"v{i}", None, i // 2) for i in range(600)]
    return [spark.createDataFrame(rows[i : i + 200], SCHEMA) for i in range(0, 600, 200)]


def plain(batches, upto):
    """(topic, partition, offset, key) by a plain walk."""
    ends, found = {}, []
    for batch in batches[:upto]:
        for r in sorted(batch.collect(), key=lambda r: (r.t, r.key)):
            at = ends.get((r.topic, r.partition), 0)
            ends[r.topic, r.partition] = at + 1
            found.append((r.topic, r.partition, at, r.key))
    return found, ends


def told(df):
    return sorted((r.topic, r.partition, r.offset, r.key) for r in df.collect())


def test_offsets_are_dense_over_batches(spark, batches, tmp_path):
    log = TopicLog(str(tmp_path), segment_rows=16)
    assert log.scan(spark).count() == 0 and log.end_offsets(spark).count() == 0
    for i, batch in enumerate(batches):
        log.append(batch, i, "t", ["key"])
        rows, ends = plain(batches, i + 1)
        assert told(log.scan(spark)) == sorted(rows)
        assert {(r.topic, r.partition): r.end_offset for r in log.end_offsets(spark).collect()} == ends
    log.append(batches[0], 1, "t", ["key"])
    assert told(log.scan(spark)) == sorted(rows)


def test_scan_opens_only_what_lies_past_the_committed_offsets(spark, batches, tmp_path):
    log = TopicLog(str(tmp_path), segment_rows=16)
    for i, batch in enumerate(batches):
        log.append(batch, i, "t", ["key"])
    rows, ends = plain(batches, 3)
    start = {k: end - 5 for k, end in ends.items() if k != ("b", 2)} | {("a", 0): ends["a", 0]}
    committed = spark.createDataFrame([(t, p, n) for (t, p), n in start.items()], "topic string, partition int, committed long")
    found = log.scan(spark, committed)
    assert told(found) == sorted(r for r in rows if r[2] >= start.get(r[:2], 0))
    # two segments at most for five records, all of the partition without a committed offset, none of the one that is read to its end
    whole = log.scan(spark, topics=["b"]).where(F.col("partition") == 2).select(F.input_file_name()).distinct().count()
    assert len(found.inputFiles()) <= 2 * 4 + whole < len(log.scan(spark).inputFiles()) / 2
    assert told(log.scan(spark, topics=["a"])) == sorted(r for r in rows if r[0] == "a")
    sizes = log.scan(spark).groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert sizes <= 16


def test_a_batch_that_dies_before_it_is_published_is_not_seen(spark, batches, tmp_path, monkeypatch):
    log = TopicLog(str(tmp_path))
    log.append(batches[0], 0, "t", ["key"])
    plainly = published.Manifests.publish

    def dies(self, number, entries):
        raise RuntimeError("lost")

    monkeypatch.setattr(published.Manifests, "publish", dies)
    with pytest.raises(RuntimeError):
        log.append(batches[1], 1, "t", ["key"])
    assert told(log.scan(spark)) == sorted(plain(batches, 1)[0])
    monkeypatch.setattr(published.Manifests, "publish", plainly)
    log.append(batches[1], 1, "t", ["key"])
    assert told(log.scan(spark)) == sorted(plain(batches, 2)[0])
