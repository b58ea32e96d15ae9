"""Helpers the text operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestal.session import work_dir

#: The six ASCII white space characters; everything else belongs to words.
SPACES = " \t\n\x0b\f\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text in order; an array without elements where there are none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK))


def kept_columns(df: DataFrame, replaced: Iterable[str]) -> list[str]:
    """Columns of the input that a result does not replace; Spark tells no case of letters apart, so this does not either."""
    gone = {name.lower() for name in replaced}
    return [c for c in df.columns if c.lower() not in gone]


def carried(names: Iterable[str]) -> Column:
    """These columns in one struct, told by place, so that no name of the input can meet one of an operator's own."""
    return F.struct(F.lit(True).alias("row"), *[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)])


def restored(names: Iterable[str], row: str = "_row") -> list[Column]:
    """The columns that ``carried`` put into column ``row``."""
    return [F.col(row)[f"c{i}"].alias(c) for i, c in enumerate(names)]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def count_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, WORD_BREAK))).cast("long")


def remainder(column: str, modulus: int) -> Column:
    """``crc32`` of a value's text modulo ``modulus``; -1 for a null value."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus, F.lit(-1).cast("long"))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written once below the shared checkpoint folder and read back, so that no lineage is left."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a batch of rows that Python gets, unless an operator says otherwise.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Sets the session's batches for Python by bytes, so that what a task holds does not grow with its texts' lengths (one row is never cut)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def text_chunks(texts: pa.Array, chars: int = 1 << 19) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of consecutive slices of about ``chars`` characters; one text is never cut."""
    first, chunk, size = 0, [], 0
    for row, value in enumerate(texts):
        text = value.as_py() or ""
        chunk.append(text)
        size += len(text)
        if size >= chars:
            yield first, chunk
            first, chunk, size = row + 1, [], 0
    if chunk:
        yield first, chunk
