"""Byte-level BPE encoding and decoding as a tree reduction.

A piece (one match of the split pattern) is halved until its parts are short;
those are encoded directly. Two neighbours are joined by encoding the bytes
around their boundary anew, in a window that grows until its first and last
tokens are the ones that stood there. Then every neighbouring pair of tokens
in the joined sequence also neighbours in a correct encoding, and a sequence
all of whose pairs do is the encoding of its bytes: tokens outside the window
cannot change any more. Pieces never merge with each other, so a text's ids
are those of its pieces in order, and decoding concatenates up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from attestal.llm.common import bound_batches, kept_columns, quoted

#: Bytes that are encoded directly; tokens on each side of the first window; words that a task remembers (some 200 bytes each).
LEAF, WINDOW, REMEMBERED = 48, 4, 500_000
#: Units of a text that are put together at a time.
_LONG = 1 << 18
#: White space next to white space or at an end; where it is absent, every blank and newline is a cut.
_WIDE_SPACE = re.compile(r"\s\s|^\s|\s\Z")
_CUT = re.compile(r"(?<=\S) (?=\S)")

#: Rank of a pair that is no token.
_NONE = 1 << 60


class Tokenizer:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.first, self.inner = _Remembered(self, ""), _Remembered(self, " ")

    def forget(self) -> None:
        """Lets go of what is remembered: workers live on between tasks."""
        self.first.clear()
        self.inner.clear()

    def leaf(self, data: bytes) -> list[int]:
        """Merges neighbours of the lowest rank, the first of equals, until none can be merged."""
        rank_of = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank_of(data[i : i + 2], _NONE) for i in range(len(data) - 1)]
        while pairs:
            low = min(pairs)
            if low == _NONE:
                break
            i = pairs.index(low)
            token = self.bytes_of[low]
            parts[i] = token
            del parts[i + 1], pairs[i]
            if i:
                pairs[i - 1] = rank_of(parts[i - 1] + token, _NONE)
            if i < len(pairs):
                pairs[i] = rank_of(token + parts[i + 1], _NONE)
        return [self.ranks[p] for p in parts]

    def encode(self, data: bytes) -> list[int]:
        """Ids of one piece: halves, then their joint; halves are worked off from a stack, not by recursion."""
        if data in self.ranks:
            return [self.ranks[data]]
        return self.merged(data)

    def merged(self, data: bytes) -> list[int]:
        """The merge loop's result for any bytes."""
        if len(data) <= LEAF:
            return self.leaf(data)
        level = [self.leaf(data[i : i + LEAF]) for i in range(0, len(data), LEAF)]
        while len(level) > 1:
            joined = [self.join(level[i], level[i + 1]) for i in range(0, len(level) - 1, 2)]
            level = joined + level[len(joined) * 2 :]
        return level[0]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        size = WINDOW
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            data = self.decode(left[a:] + right[:b])
            middle = self.leaf(data) if len(data) <= 4 * LEAF else self.window(data)
            if (a == 0 or middle[0] == left[a]) and (b == len(right) or middle[-1] == right[b - 1]):
                return left[:a] + middle + right[b:]
            size *= 2

    def window(self, data: bytes) -> list[int]:
        """A wide window, halved in its turn; its halves are shorter, so this ends."""
        middle = len(data) // 2
        return self.join(self.merged(data[:middle]), self.merged(data[middle:]))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _unit(self, unit: str) -> bytes:
        """Packed ids of a stretch of text that starts and ends where pieces do."""
        return _packed([i for piece in self.pattern.findall(unit) for i in self.encode(piece.encode("utf-8", "surrogatepass"))])

    def packed_ids(self, text: str) -> Iterator[bytes]:
        """The text's ids as little-endian unsigned 32-bit integers, in chunks.

        A blank or newline between two characters that are not white space
        always starts a piece, and a newline there is one by itself; so words
        between them are encoded, and remembered, as units of their own.
        """
        if _WIDE_SPACE.search(text) is None:
            first, inner = self.first, self.inner
            for line in _lines(text):
                head, *words = line.split(" ")
                yield first[head] if not words else first[head] + b"".join(map(inner.__getitem__, words))
        else:
            units = _CUT.split(text)
            yield self.first[units[0]]
            for start in range(1, len(units), _LONG):
                yield b"".join(map(self.inner.__getitem__, units[start : start + _LONG]))


class _Remembered(dict):
    """Packed ids of units that stand behind ``lead``; forgets all when full."""

    def __init__(self, tokenizer: Tokenizer, lead: str):
        self.tokenizer, self.lead = tokenizer, lead

    def __missing__(self, unit: str) -> bytes:
        packed = self.tokenizer._unit(self.lead + unit)
        if len(unit) <= LEAF:
            if len(self) >= REMEMBERED:
                self.clear()
            self[unit] = packed
        return packed


def _lines(text: str) -> Iterator[str]:
    """Lines, and the newlines between them."""
    for i, line in enumerate(text.split("\n")):
        if i:
            yield "\n"
        yield line


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def unpacked(packed: bytes) -> array:
    ids = array("I", packed)
    if sys.byteorder == "big":
        ids.byteswap()
    return ids


@lru_cache(maxsize=2)
def load(ranks_path: str, pattern: str) -> Tokenizer:
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Tokenizer(ranks, pattern)


def _digester(ranks_path: str, pattern: str, names: list[str], keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(ranks_path, pattern)
        try:
            for batch in batches:
                for start in range(0, batch.num_rows, 500):
                    yield digested(tokenizer, batch.slice(start, 500))
        finally:
            tokenizer.forget()

    def digested(tokenizer: Tokenizer, part: pa.RecordBatch) -> pa.RecordBatch:
        counts, id_digests, text_digests, ids = [], [], [], bytearray()
        for value in part.column("text"):
            count, id_digest, text_digest = 0, hashlib.sha256(), hashlib.sha256()
            for packed in tokenizer.packed_ids(value.as_py() or ""):
                count += len(packed) // 4
                id_digest.update(packed)
                text_digest.update(tokenizer.decode(unpacked(packed)))
                if keep_ids:
                    ids += packed
            counts.append(count)
            id_digests.append(id_digest.hexdigest())
            text_digests.append(text_digest.hexdigest())
        columns = [part.column(n) for n in names]
        columns += [pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())]
        if keep_ids:
            ends = pa.array([0, *accumulate(counts)], pa.int32())
            flat = pa.array(np.frombuffer(ids, "<u4").astype(np.int32))
            columns.append(pa.ListArray.from_arrays(ends, flat))
        return pa.RecordBatch.from_arrays(columns, names=[*names, *_RESULT[: len(columns) - len(names)]])

    return run


_RESULT = ("n_tokens", "ids_sha256", "decoded_sha256", "ids")
_TYPES = (LongType(), StringType(), StringType(), ArrayType(IntegerType()))


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """All columns but the text, with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids``.

    ``decoded_sha256`` is of the bytes that the ids decode to. A null text
    counts as empty: no ids. Input columns of these names, in any case of
    letters, are replaced. The file of ranks is read on each executor, where the path must exist.
    """
    kept = kept_columns(docs, ("text", *_RESULT))
    names = [f"c{i}" for i in range(len(kept))]
    rows = docs.select("text", *[F.col(quoted(c)).alias(n) for n, c in zip(names, kept, strict=True)])
    bound_batches(rows.sparkSession)
    schema = StructType(rows.schema.fields[1:])
    for name, kind in list(zip(_RESULT, _TYPES, strict=True))[: 4 if keep_ids else 3]:
        schema = schema.add(name, kind)
    found = rows.mapInArrow(_digester(ranks_path, pattern, names, keep_ids), schema)
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, kept, strict=True)], *schema.names[len(names) :])
