"""Snapshots, directory, rules and topics as DataFrames.

A topic is a stream of (key, value) rows. ``TopicStore`` opens it through the
Kafka connector where that is on the class path, or as a folder of files.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from attestal import schemas
from attestal.sources.decode import snapshot_documents

_KEY_VALUE = "key string, value string"


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Credential documents of a folder of snapshot files, one document per file."""
    return snapshot_documents(spark.read.text(path, wholetext=True), "value")


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """People directory: CSV with the header UUID,EMAIL,FIRST NAME,LAST NAME."""
    return spark.read.csv(path, header=True, schema=schemas.DIRECTORY, enforceSchema=True)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules document, one row per rule."""
    document = spark.read.json(path, schema=schemas.RULES_DOCUMENT, multiLine=True)
    return document.select("default_compliance_email", F.explode("rules").alias("r")).select("r.*", "default_compliance_email")


def load_rules(spark: SparkSession, path: str) -> list[Row]:
    """Rules as local rows, in document order; a configuration file, not data."""
    document = spark.read.json(path, schema=schemas.RULES_DOCUMENT, multiLine=True).first()
    return [] if document is None else list(document["rules"])


@dataclass(frozen=True)
class TopicStore:
    """Where topics live: ``format`` is kafka, or a file format below ``location``.

    For Kafka ``location`` is the bootstrap server list.
    """

    location: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def scan(self, spark: SparkSession, topic: str, stream: bool = False, schema: str = _KEY_VALUE) -> DataFrame:
        """(key, value) rows of a topic from its first record on."""
        reader = (spark.readStream if stream else spark.read).format(self.format).options(**self.options)
        if self.format == "kafka":
            reader = (
                reader.option("kafka.bootstrap.servers", self.location)
                .option("subscribe", topic)
                .option("startingOffsets", "earliest")
            )
            return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))
        return reader.schema(schema).load(f"{self.location}/{topic}")

    def append(self, rows: DataFrame, topic: str) -> None:
        """Appends (key, value) rows of a batch."""
        writer = rows.write.format(self.format).options(**self.options).mode("append")
        if self.format == "kafka":
            writer.option("kafka.bootstrap.servers", self.location).option("topic", topic).save()
        else:
            writer.save(f"{self.location}/{topic}")

    def stream_to(self, rows: DataFrame, topic: str, checkpoint: str):
        """A writer that appends (key, value) rows of a stream."""
        writer = rows.writeStream.format(self.format).options(**self.options).option("checkpointLocation", checkpoint)
        if self.format == "kafka":
            return writer.option("kafka.bootstrap.servers", self.location).option("topic", topic)
        return writer.option("path", f"{self.location}/{topic}")


def keyed_json(df: DataFrame, key: str) -> DataFrame:
    """(key, value) rows; fields without a value are written as ``null``."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))
