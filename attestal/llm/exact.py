"""Exact deduplication behind a two-pass Bloom filter, in built-in functions only.

Pass one maps every text's digest to ``HASHES`` slots of a bit table and finds
the slots hit more than once (a map-side combined count). Pass two marks the
rows all of whose slots were hit more than once; only those can have an equal
text. They alone are grouped by digest, combined map-side, and joined with
their groups: those of the few largest groups in place, the others by shuffle.
Every other row passes straight through as the only one of its kind. A false
alarm of the filter costs one shuffled row and never changes the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestal.llm.common import carried, kept_columns, restored, stored, text_of

HASHES = 2
#: Bits of the filter for each row; the fewest there are, and the most: 128 MB, which every executor holds. Past it (64 million rows)
#: slots are shared by more rows and more rows become suspects; the result stays the same.
BITS_PER_ROW, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 30
#: Bits of one value of the table: those of Spark's bitmap aggregate.
CHUNK = 1 << 15
#: Groups of copies that hold more than one of so many rows are broadcast (fewer than this many); the others are shuffled.
HOT = 1000

RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def _slot(digest, number: int, bits: int):
    return F.pmod(F.xxhash64(digest, F.lit(number)), F.lit(bits).cast("long"))


def repeated_bits(digests: DataFrame, digest: str, bits: int) -> DataFrame:
    """(chunk, map): the slots that at least two insertions hit, as bitmaps of ``CHUNK`` slots."""
    slots = digests.select(F.explode(F.array(*[_slot(F.col(digest), i, bits) for i in range(HASHES)])).alias("slot"))
    hit = slots.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1")
    return hit.groupBy(F.expr(f"slot div {CHUNK}").alias("chunk")).agg(F.bitmap_construct_agg(F.col("slot") % CHUNK).alias("map"))


def suspected(rows: DataFrame, digest: str, total: int) -> DataFrame:
    """The rows with ``_suspect``: whether all slots of their digest were hit more than once. Rows stay where they are."""
    bits = min(max(LEAST_BITS, 1 << (BITS_PER_ROW * total).bit_length()), MOST_BITS)
    table = stored(repeated_bits(rows.select(digest), digest, bits), "exact-bits")
    suspect, maps = F.lit(True), []
    for i in range(HASHES):
        slot = _slot(F.col(digest), i, bits)
        # at most MOST_BITS / CHUNK rows of 4 KB
        side = F.broadcast(table.select(F.col("chunk").alias(f"_chunk{i}"), F.col("map").alias(f"_map{i}")))
        rows = rows.join(side, F.shiftright(slot, CHUNK.bit_length() - 1) == F.col(f"_chunk{i}"), "left")
        byte = F.conv(F.hex(F.substring(F.col(f"_map{i}"), (slot % CHUNK / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        suspect &= F.coalesce(F.getbit(byte, (slot % 8).cast("int")) == 1, F.lit(False))
        maps += [f"_chunk{i}", f"_map{i}"]
    return rows.withColumn("_suspect", suspect).drop(*maps)


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """All rows with the row of their text that stays.

    Adds ``keep_id`` (largest key among the equal texts), ``group_size``,
    ``kept`` and ``text_sha256`` (of the UTF-8 text); input columns of these
    names, in any case of letters, are replaced, and the text is left out
    unless ``keep_text``. A null text counts as empty. Rows that repeat both
    key and text are one document listed again: exactly one of them is kept.
    Null keys lose against any key. An empty table gives an empty result.
    """
    names = kept_columns(docs, RESULT if keep_text else (text, *RESULT))
    rows = docs.select(carried(names).alias("_row"), F.col(key).alias("_key"), F.sha2(text_of(text), 256).alias("_sha"))
    total = docs.count()
    marked = suspected(rows, "_sha", total)

    alone = marked.where("not _suspect").select(
        "_row", "_sha", F.col("_key").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept")
    )
    # written once, so that the numbers that tell repeated rows apart hold for both uses
    suspects = marked.where("_suspect").drop("_suspect").withColumn("_place", F.monotonically_increasing_id())
    suspects = stored(suspects, "exact-suspects")
    groups = suspects.groupBy(F.col("_sha").alias("_group")).agg(
        F.max("_key").alias("keep_id"), F.count("*").alias("group_size"), F.coalesce(F.max_by("_place", "_key"), F.max("_place")).alias("_top")
    )
    groups = stored(groups, "exact-groups")
    # at most HOT groups hold more than this; their rows stay where they are, and no other group fills a task
    large = F.col("group_size") * HOT > total
    hot = F.broadcast(groups.where(large))
    is_group = F.col("_sha") == F.col("_group")
    rest = suspects.join(F.broadcast(hot.select("_group")), is_group, "left_anti").join(groups.where(~large), is_group)
    found = suspects.join(hot, is_group).unionByName(rest).withColumn("kept", F.col("_place") == F.col("_top"))
    every = alone.unionByName(found.drop("_key", "_group", "_place", "_top"))
    return every.select(*restored(names), "keep_id", "group_size", "kept", F.col("_sha").alias("text_sha256"))
