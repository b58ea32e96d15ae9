"""Tables published by manifests, and streams that keep them."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestal.operators import dedup, digest
from attestal.sources import published
from attestal.sources.published import BatchLog, KeyedTable
from attestal.streaming import streams

PEOPLE = "userId string, compliance_status string, department string, event_id long, ts_us long"
COUNTS = "department string, totalCount long, expiredCount long, expiringCount long, missingCount long, notApprovedCount long"
ORDER = ["ts_us", "event_id"]


@pytest.fixture(scope="module")
def batches():
    """Statuses of people, with late and repeated ones, in batches."""
    rnd = random.Random(5)
    kinds = ["EXPIRED", "EXPIRING", "MISSING", "NOT_APPROVED", "COMPLIANT", "UNEXPECTED"]
    rows = [(f"u{rnd.randrange(40)}", rnd.choice(kinds), rnd.choice([None, "A", "B", "C"]), i, 100 + i + rnd.randrange(-90, 90)) for i in range(250)]
    return [rows[i : i + 50] + rows[max(0, i - 5) : i] for i in range(0, 250, 50)]


def land(spark, rows, path):
    spark.createDataFrame(rows, PEOPLE).repartition(1).write.mode("append").parquet(path)


def told(df):
    return sorted(map(repr, map(tuple, df.collect())))


def tables(tmp_path):
    people = KeyedTable(f"{tmp_path}/people", T.StructType.fromDDL(PEOPLE), ["userId"], 8)
    return people, KeyedTable(f"{tmp_path}/counts", T.StructType.fromDDL(COUNTS), ["department"], 2)


def test_counts_keep_step_with_every_batch(spark, batches, tmp_path):
    people, counts = tables(tmp_path)
    seen = []
    for batch in batches:
        land(spark, batch, f"{tmp_path}/in")
        seen += batch
        stream = spark.readStream.schema(PEOPLE).parquet(f"{tmp_path}/in")
        streams.run(streams.summary_tables(stream, people, counts, ORDER, f"{tmp_path}/cp"))
        latest = dedup.latest_per_key(spark.createDataFrame(seen, PEOPLE), ["userId"], ORDER)
        assert told(people.read(spark)) == told(latest)
        assert told(counts.read(spark).filter("totalCount > 0")) == told(digest.department_summary(latest))


def test_a_batch_that_dies_between_its_tables_counts_once(spark, batches, tmp_path, monkeypatch):
    people, counts = tables(tmp_path)
    plain, deaths = published.Manifests.publish, iter([False, True, True, False, False, False])

    def dying(self, number, entries):
        if number == 1 and "people" in self.folder and next(deaths, False):
            raise RuntimeError("lost")
        plain(self, number, entries)

    monkeypatch.setattr(published.Manifests, "publish", dying)
    next(deaths)
    for batch in batches[:2]:
        land(spark, batch, f"{tmp_path}/in")
        for _ in range(4):
            stream = spark.readStream.schema(PEOPLE).parquet(f"{tmp_path}/in")
            try:
                streams.run(streams.summary_tables(stream, people, counts, ORDER, f"{tmp_path}/cp"))
                break
            except Exception as error:
                assert "lost" in str(error)
    latest = dedup.latest_per_key(spark.createDataFrame(batches[0] + batches[1], PEOPLE), ["userId"], ORDER)
    assert told(counts.read(spark).filter("totalCount > 0")) == told(digest.department_summary(latest))
    assert told(people.read(spark)) == told(latest)


def test_only_touched_buckets_are_written(spark, tmp_path):
    people, _ = tables(tmp_path)
    latest = lambda both: dedup.latest_per_key(both, ["userId"], ORDER)
    first = [(f"u{i}", "EXPIRED", "A", i, i) for i in range(60)] + [(None, "EXPIRED", None, 99, 99)]
    people.merge(spark.createDataFrame(first, PEOPLE), 0, latest)
    people.merge(spark.createDataFrame([("u7", "COMPLIANT", "A", 100, 100)], PEOPLE), 1, latest)
    written = [d for d in os.listdir(f"{tmp_path}/people/data/batch=1") if d.startswith("__bucket")]
    assert len(written) == 1 and len(os.listdir(f"{tmp_path}/people/data/batch=0")) > 6
    assert people.read(spark).count() == 61
    assert people.read(spark).filter("userId = 'u7'").first()["compliance_status"] == "COMPLIANT"
    assert people.read(spark, before=1).filter("userId = 'u7'").first()["compliance_status"] == "EXPIRED"
    people.merge(spark.createDataFrame([], PEOPLE), 2, latest)
    assert people.read(spark).count() == 61


def test_readers_never_see_half_a_batch(spark, tmp_path, monkeypatch):
    """A batch killed between its files and its publication is not there; repeated, it is there once."""
    log = BatchLog(f"{tmp_path}/log", T.StructType.fromDDL("id long"))
    assert log.read(spark).count() == 0
    log.append(spark.range(5), 0)
    plain = published.Manifests.publish

    def lost(self, number, entries):
        raise RuntimeError("lost")

    monkeypatch.setattr(published.Manifests, "publish", lost)
    with pytest.raises(RuntimeError, match="lost"):
        log.append(spark.range(5, 9), 1)
    assert os.path.isdir(f"{tmp_path}/log/data/batch=1") and log.read(spark).count() == 5
    monkeypatch.setattr(published.Manifests, "publish", plain)
    for _ in range(2):
        log.append(spark.range(5, 9), 1)
    assert sorted(r[0] for r in log.read(spark).collect()) == list(range(9))


def test_a_stream_into_a_log(spark, batches, tmp_path):
    log = BatchLog(f"{tmp_path}/log", T.StructType.fromDDL("userId string, event_id long"))
    for batch in batches[:2]:
        land(spark, batch, f"{tmp_path}/in")
        stream = spark.readStream.schema(PEOPLE).parquet(f"{tmp_path}/in")
        streams.run(streams.published(stream, lambda b: b.filter(F.col("event_id") % 2 == 0), log, f"{tmp_path}/cp"))
    assert sorted(r["event_id"] for r in log.read(spark).collect()) == sorted(r[3] for b in batches[:2] for r in b if r[3] % 2 == 0)
