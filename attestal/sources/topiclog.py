"""Topics as logs of files with dense offsets, read on from committed ones.

An append numbers its records within each topic and partition, on from the last
published offset, and cuts them into segments, each a folder of its own. The
manifest of the batch names every segment with its first and last offset. A
scan from committed offsets opens only the segments that reach past them; end
offsets come from the manifest alone, without reading a record.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestal.operators import cells
from attestal.sources.published import Manifests

RECORD = "topic string, partition int, offset long, key string, value string, ts timestamp_ntz"
_COLUMNS = [c.split()[0] for c in RECORD.split(", ")]
_ENDS = "topic string, partition int, end_offset long"
_SEGMENT = "__segment"


@dataclass(frozen=True)
class TopicLog:
    """Records of all topics below one path. A segment holds at most ``segment_rows`` records.

    The driver holds one entry for each segment and partition, never records.
    """

    path: str
    segment_rows: int = 1 << 20

    def _manifests(self, spark: SparkSession) -> Manifests:
        return Manifests(spark, f"{self.path}/manifests")

    def append(self, rows: DataFrame, number: int, order: str, ties: Sequence[str] = ()) -> None:
        """Publishes (topic, partition, key, value, ts) rows as batch ``number``, numbered by the whole number ``order``, then ``ties``.

        A batch starts from the last manifest before its own number, so a
        repeated one gives the same offsets; a published one stays as it is.
        """
        spark = rows.sparkSession
        manifests = self._manifests(spark)
        if number in manifests.numbers():
            return
        known = manifests.read(number)
        ends = spark.createDataFrame([tuple(e) for e in known.get("ends", [])], _ENDS)
        placed = cells.with_position(rows, ["topic", "partition"], order, list(ties), "offset").join(ends, ["topic", "partition"], "left")
        placed = placed.withColumn("offset", F.col("offset") + F.coalesce("end_offset", F.lit(0)))
        part = F.expr(f"offset div {self.segment_rows}")
        name = F.md5(F.to_json(F.struct("topic", "partition", part.alias("part"))))
        folder = f"data/batch={number}"
        placed = placed.select(*_COLUMNS, name.alias(_SEGMENT)).repartition("topic", "partition", _SEGMENT)
        placed.write.mode("overwrite").partitionBy(_SEGMENT).parquet(f"{self.path}/{folder}")
        written = spark.read.schema(f"{RECORD}, {_SEGMENT} string").parquet(f"{self.path}/{folder}")
        found = written.groupBy("topic", "partition", _SEGMENT).agg(F.min("offset"), F.max("offset")).collect()
        fresh = [[t, p, first, last, f"{folder}/{_SEGMENT}={s}"] for t, p, s, first, last in found]
        segments = sorted(known.get("segments", []) + fresh, key=repr)
        latest: dict[tuple, int] = {}
        for t, p, _, last, _ in segments:
            latest[t, p] = max(latest.get((t, p), 0), last + 1)
        manifests.publish(number, {"segments": segments, "ends": [[t, p, end] for (t, p), end in latest.items()]})

    def end_offsets(self, spark: SparkSession) -> DataFrame:
        """(topic, partition, end_offset): the offset that the next record gets."""
        return spark.createDataFrame([tuple(e) for e in self._manifests(spark).read().get("ends", [])], _ENDS)

    def scan(self, spark: SparkSession, committed: DataFrame | None = None, topics: Sequence[str] | None = None) -> DataFrame:
        """The published records (of some topics) from the ``committed`` offset (topic, partition, committed) of their partition on.

        A partition without a committed offset is read from its start.
        """
        segments = [s for s in self._manifests(spark).read().get("segments", []) if topics is None or s[0] in topics]
        if committed is not None:
            # one number a partition
            start = {(t, p): n for t, p, n in committed.select("topic", "partition", "committed").collect()}
            segments = [s for s in segments if s[3] >= start.get((s[0], s[1]), 0)]
        if not segments:
            return spark.createDataFrame([], RECORD)
        rows = spark.read.schema(RECORD).parquet(*[f"{self.path}/{s[4]}" for s in segments])
        if committed is None:
            return rows
        given = spark.createDataFrame([(*k, n) for k, n in start.items()], "topic string, partition int, committed long")
        rows = rows.join(given, ["topic", "partition"], "left").where(F.col("offset") >= F.coalesce("committed", F.lit(0)))
        return rows.select(*_COLUMNS)
