"""Tables whose versions appear whole: files first, then one manifest that names them.

A batch writes its files to a folder of its own and then publishes a manifest,
one small file put in place by a rename. Readers follow the newest manifest, so
they never see half a batch, and a batch that died before it was published
leaves nothing behind that anyone reads. A batch always starts from the last
manifest before its own number; repeated, it writes the same rows, and where its
manifest is there already, nothing changes.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
_BUCKET = "__bucket"


@dataclass(frozen=True)
class Manifests:
    """The manifests of one table, by batch number, on whatever file system the path names."""

    spark: SparkSession
    folder: str

    def _fs(self):  # noqa: ANN202 - a JVM object
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        path, fs = self._fs()
        found = fs.globStatus(path(f"{self.folder}/*.json"))
        return sorted(int(f.getPath().getName()[: -len(".json")]) for f in found or [])

    def read(self, before: int | None = None) -> dict:
        """Entries of the newest manifest (with a number below ``before``); none where there is none."""
        numbers = [n for n in self.numbers() if before is None or n < before]
        if not numbers:
            return {}
        return json.loads(self.spark.read.text(f"{self.folder}/{numbers[-1]:020d}.json", wholetext=True).first()[0])

    def publish(self, number: int, entries: dict) -> None:
        path, fs = self._fs()
        final = path(f"{self.folder}/{number:020d}.json")
        if fs.exists(final):
            return
        draft = path(f"{self.folder}/.{number:020d}.draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(entries).encode()))
        out.close()
        fs.rename(draft, final)


@dataclass(frozen=True)
class BatchLog:
    """Batches of rows, each seen whole or not at all."""

    path: str
    schema: T.StructType

    def _manifests(self, spark: SparkSession) -> Manifests:
        return Manifests(spark, f"{self.path}/manifests")

    def append(self, rows: DataFrame, number: int) -> None:
        manifests = self._manifests(rows.sparkSession)
        rows.select(*self.schema.names).write.mode("overwrite").parquet(f"{self.path}/data/batch={number}")
        manifests.publish(number, {**manifests.read(number), str(number): f"data/batch={number}"})

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The published rows, or those of batches before a number."""
        folders = [f"{self.path}/{f}" for f in self._manifests(spark).read(before).values()]
        return spark.read.schema(self.schema).parquet(*folders) if folders else spark.createDataFrame([], self.schema)


@dataclass(frozen=True)
class KeyedTable:
    """One row per key, in buckets by the hash of the key; a batch rewrites only the buckets it touches."""

    path: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = BUCKETS

    def _manifests(self, spark: SparkSession) -> Manifests:
        return Manifests(spark, f"{self.path}/manifests")

    def _load(self, spark: SparkSession, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The newest published rows, or those before a batch."""
        return self._load(spark, list(self._manifests(spark).read(before).values()))

    def read_buckets_of(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """Published rows of the buckets in which keys of ``rows`` fall."""
        known = self._manifests(rows.sparkSession).read(before)
        return self._load(rows.sparkSession, [known[b] for b in self._touched(rows) if b in known])

    def _touched(self, rows: DataFrame) -> list[str]:
        return [str(r[0]) for r in self._bucketed(rows).select(_BUCKET).distinct().collect()]

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def merge(self, rows: DataFrame, number: int, combine: Callable[[DataFrame], DataFrame]) -> None:
        """Publishes ``combine`` of the rows and of the old rows in the same buckets.

        It leaves one row for each key that comes in, so that no touched bucket is empty.
        At most ``buckets`` numbers come to the driver: those of the touched buckets.
        """
        spark = rows.sparkSession
        manifests = self._manifests(spark)
        known = manifests.read(number)
        touched = self._touched(rows)
        old = self._load(spark, [known[b] for b in touched if b in known])
        merged = combine(rows.select(*self.schema.names).unionByName(old))
        folder = f"data/batch={number}"
        # one writer a bucket: a bucket is as large as its keys make it, so their number is the caller's
        placed = self._bucketed(merged.select(*self.schema.names)).repartition(_BUCKET)
        placed.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/{folder}")
        fresh = {b: f"{folder}/{_BUCKET}={b}" for b in touched}
        manifests.publish(number, {b: f for b, f in known.items() if b not in touched} | fresh)
