"""Typed decoding of JSON text with a quarantine for what does not decode."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestal import schemas
from attestal.operators.classify import NAME_KEYS, with_name_keys

_BAD = "_corrupt_record"

# Paths that may be absent, per record type; all other fields must be present.
OPTIONAL_IN_DOCUMENT = (
    "attributes.media",
    "attributes.expiry_period_start_date",
    "attributes.expiry_period_end_date",
    "attributes.credential_number",
)
OPTIONAL_IN_SNAPSHOT = tuple(f"latest_document_versions.{p}" for p in OPTIONAL_IN_DOCUMENT)
OPTIONAL_IN_MESSAGE = tuple(f"credential.{p}" for p in OPTIONAL_IN_DOCUMENT)
OPTIONAL_IN_STATUS = tuple(f.name for f in schemas.STATUS.fields if f.name not in schemas.STATUS_REQUIRED)
OPTIONAL_IN_COMMAND = ("cc", "bcc", "data.wwccNumber", "data.expiryDate", "data.daysUntilExpiry")
OPTIONAL_IN_SENT = ("errorMessage",)


def is_complete(value: Column, dtype: T.DataType, optional: Collection[str] = (), path: str = "") -> Column:
    """True where every field outside ``optional`` is present, at any depth."""
    if isinstance(dtype, T.StructType):
        tests = [value.isNotNull()]
        for field in dtype.fields:
            below = f"{path}.{field.name}" if path else field.name
            child = value[field.name]
            test = is_complete(child, field.dataType, optional, below)
            tests.append(child.isNull() | test if below in optional else test)
        return reduce(lambda a, b: a & b, tests)
    if isinstance(dtype, T.ArrayType):
        return value.isNotNull() & F.forall(value, lambda item: is_complete(item, dtype.elementType, optional, path))
    return value.isNotNull()


def decode(df: DataFrame, value: str, schema: T.StructType, optional: Collection[str] = (), out: str = "record") -> DataFrame:
    """Adds ``out`` (the typed record) and ``valid``.

    Broken JSON, a value of the wrong type, or a missing field that is not
    optional makes a row invalid; fields outside the schema are ignored.
    """
    wide = T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    # Exploding one element keeps the parser out of filters and projections,
    # which would otherwise each run it again.
    parsed = df.select("*", F.explode(F.array(F.from_json(F.col(value), wide, options))).alias("__parsed"))
    record = F.when(
        F.col("__parsed").isNotNull(), F.struct(*[F.col("__parsed")[f.name].alias(f.name) for f in schema.fields])
    )
    sound = F.col("__parsed").isNotNull() & F.col("__parsed")[_BAD].isNull()
    return (
        parsed.withColumn(out, record)
        .withColumn("valid", F.coalesce(sound & is_complete(F.col(out), schema, optional), F.lit(False)))
        .drop("__parsed")
    )


def decode_valid(df: DataFrame, value: str, schema: T.StructType, optional: Collection[str] = ()) -> DataFrame:
    """Typed rows of the records that decode; other columns of ``df`` are dropped."""
    return decode(df, value, schema, optional).filter("valid").select("record.*")


def decode_quarantine(df: DataFrame, value: str, schema: T.StructType, optional: Collection[str] = ()) -> DataFrame:
    """The rows that do not decode, as they came."""
    return decode(df, value, schema, optional).filter("NOT valid").select(*df.columns)


def snapshot_documents(df: DataFrame, value: str) -> DataFrame:
    """Document versions of provider snapshots, one snapshot per row.

    One malformed element fails the whole snapshot.
    """
    good = decode(df, value, schemas.SNAPSHOT, OPTIONAL_IN_SNAPSHOT).filter("valid")
    return good.select(F.explode("record.latest_document_versions").alias("d")).select("d.*")


def latest_required_people(messages: DataFrame, version: str, part: str, value: str) -> DataFrame:
    """People of the newest valid list; a repeated name keeps its last entry.

    A list may come in several messages of one version (``part`` orders them),
    so no single row has to hold all people.
    """
    good = decode(messages, value, schemas.REQUIRED_LIST).filter("valid")
    newest = good.agg(F.max(version).alias("__newest"))
    people = (
        good.join(F.broadcast(newest), F.col(version) == F.col("__newest"))  # one row
        .select(version, part, F.posexplode("record.requiredUsers").alias("pos", "p"))
        .select(version, part, "pos", "p.*")
    )
    row = F.struct(F.col(version), "email", "firstName", "lastName", "department", "position", "requiresWwcc", "startDate")
    return (
        with_name_keys(people)
        .groupBy(*NAME_KEYS)
        .agg(F.max_by(row, F.struct(part, "pos")).alias("p"))
        .select("p.*")
    )


def people_from_short_list(messages: DataFrame, value: str) -> DataFrame:
    """Required people of the older export: reason as department, all required."""
    good = decode(messages, value, schemas.REQUIRED_LIST_SHORT).filter("valid")
    text = F.lit(None).cast("string")
    return good.select(F.explode("record.requiredUsers").alias("p")).select(
        "p.email",
        "p.firstName",
        "p.lastName",
        F.col("p.requiredBecause").alias("department"),
        text.alias("position"),
        F.lit(True).alias("requiresWwcc"),
        text.alias("startDate"),
    )
