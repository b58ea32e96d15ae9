"""Near-duplicate groups by bottom-k sketches of one hash function.

1. Every text becomes its set of hashed word shingles; documents with equal
   sets are one class from here on.
2. A class keeps the ``SKETCH`` lowest hashes of its set. Two sets over the
   similarity share a number of kept hashes with a known lower bound, so with
   all kept hashes in one order, rarest first, they share one of the first
   few: those are the inverted lists.
3. Short lists give all their pairs. In a long list (many copies of one text)
   every member is paired with a few hubs only: the members whose kept hashes
   are most widely shared, which is what the common original looks like.
4. The union sketch of a pair estimates its similarity; pairs clearly below go.
   The others are confirmed on full sets.
5. Confirmed links are joined into components. What hubs leave open in long
   lists, members outside their largest component, is compared on full sets
   with all members in blocks, so that no link between components is lost.

Nothing is dropped for being frequent, no list is held in one task, and no list
gives all of its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal.llm.common import bound_batches, carried, restored, stored

SKETCH = 64
#: Standard deviations that a sketch's overlap may fall below its mean before a link is missed (about one in a million of those right at the similarity, none in practice above).
SLACK = 5.0
#: Members up to which a list gives all pairs; hubs of a longer one; members and hashes of a block of the rest.
SHORT_LIST, HUBS, BLOCK, BLOCK_HASHES = 24, 3, 512, 500_000
#: Rounds after which joining links is given up as an error; each halves the distance to the root at least.
MAX_ROUNDS = 60
#: Slots of the table, broadcast 64 to a row, that spares texts of other documents the shuffle to their candidates; past about as many candidates it lets every text through, and the join alone decides.
FILTER_BITS = 1 << 26
#: Shares into which the members of one family are dealt before they get their numbers of blocks.
SHARES = 32

_PRIMES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class _WordHashes(dict):
    """Hash of a word, remembered for words seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(text: str | None, n: int, words: _WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; of the whole sequence where it has fewer than ``n`` words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    width = min(n, len(hashes))
    mixed = np.zeros(len(hashes) - width + 1, np.uint64)
    for i in range(width):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(_PRIMES[0]) + hashes[i : len(hashes) - width + 1 + i] * np.uint64(_PRIMES[1 + i % 4])
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(_PRIMES[4])
    return np.unique(mixed ^ (mixed >> np.uint64(33)))


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _offsets(sizes: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def _sketcher(n: int, keep: int | None):
    """Rows (key, text, ...) as (key, n_shingles, set_hash, hashes, ...): the lowest ``keep`` hashes, or all. Further columns are passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                sets = [shingle_hashes(x.as_py(), n, words) for x in part.column(1)]
                kept = [s[:keep] for s in sets]
                flat = np.concatenate([*kept, np.empty(0, np.uint64)])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets], pa.string()),
                        pa.ListArray.from_arrays(_offsets([len(s) for s in kept]), pa.array(_signed(flat))),
                        *part.columns[2:],
                    ],
                    names=["key", "n_shingles", "set_hash", "hashes", *part.schema.names[2:]],
                )

    return run


_SETS = "key long, n_shingles long, set_hash string, hashes array<long>"


def least_overlap(size: int, similarity: float) -> int:
    """Kept hashes that a set of ``size`` shares at least with the sketch of any set over ``similarity``.

    Sets that are kept whole: exact, less what a larger partner's sketch may
    cut off. Larger ones: of the lowest ``SKETCH`` hashes of the union, each
    is shared with a probability of the similarity; ``SLACK`` deviations less.
    """
    if size <= SKETCH:
        cut = max(0, math.floor(size / similarity + 1e-9) - SKETCH)
        return max(1, math.ceil(size * similarity - 1e-9) - cut)
    mean, deviation = SKETCH * similarity, math.sqrt(SKETCH * similarity * (1 - similarity))
    return max(1, math.floor(mean - SLACK * deviation))


def prefix_length(similarity: float) -> Column:
    """Hashes, rarest first, of which two linked sets share one: by ``n``, the set's size."""
    table = F.array(*[F.lit(min(s, SKETCH) - least_overlap(s, similarity) + 1) for s in range(1, SKETCH + 2)])
    return F.element_at(table, F.least(F.col("n"), F.lit(SKETCH + 1)).cast("int"))


def estimate_passes(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, similarity: float) -> bool:
    """Whether the union sketch of two sorted unsigned sketches leaves room for the similarity."""
    if min(n_a, n_b) < similarity * max(n_a, n_b) - 1e-9:
        return False
    union = np.union1d(a, b)[:SKETCH]
    shared = np.isin(union, a, assume_unique=True) & np.isin(union, b, assume_unique=True)
    if max(n_a, n_b) <= SKETCH:
        return shared.sum() >= similarity * len(union) - 1e-9 or len(np.union1d(a, b)) > SKETCH
    return shared.sum() >= SKETCH * similarity - SLACK * math.sqrt(SKETCH * similarity * (1 - similarity)) - 1


def _estimator(similarity: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            passed = [
                estimate_passes(np.asarray(a, np.int64).view(np.uint64), np.asarray(b, np.int64).view(np.uint64), x, y, similarity)
                for a, b, x, y in zip(frame["hashes_a"], frame["hashes_b"], frame["n_a"], frame["n_b"], strict=True)
            ]
            yield frame.loc[passed, ["a", "b"]]

    return run


def _blocks(similarity: float):
    """Links between one block of open members and one block of a family, on full sets; one per member and component."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        open_, every = frame[frame["open"]], frame[~frame["open"]]
        if not len(open_) or not len(every):
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        both = _shared_counts(list(open_["hashes"]), list(every["hashes"]))
        total = open_["n"].to_numpy()[:, None] + every["n"].to_numpy()[None, :]
        labels = every["label"].to_numpy()
        linked = (100 * both >= round(100 * similarity) * (total - both)) & (open_["label"].to_numpy()[:, None] != labels[None, :])
        i, j = np.nonzero(linked)
        found = pd.DataFrame({"x": open_["node"].to_numpy()[i], "y": every["node"].to_numpy()[j], "label": labels[j]})
        found = found.drop_duplicates(["x", "label"])
        return pd.DataFrame({"a": found[["x", "y"]].min(axis=1), "b": found[["x", "y"]].max(axis=1)})

    return run


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """How many hashes each set of one block shares with each of the other, by 0/1 tables over ``width`` hashes at a time."""
    flats = [np.concatenate(side) for side in (left, right)]
    owners = [np.repeat(np.arange(len(side)), [len(h) for h in side]) for side in (left, right)]
    common = np.intersect1d(*flats)
    counts = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, len(common), width):
        some = common[start : start + width]
        tables = []
        for side, flat, owner in zip((left, right), flats, owners, strict=True):
            place = np.minimum(np.searchsorted(some, flat), len(some) - 1)
            hit = some[place] == flat
            table = np.zeros((len(side), len(some)), np.float32)
            table[owner[hit], place[hit]] = 1
            tables.append(table)
        counts += np.rint(tables[0] @ tables[1].T).astype(np.int64)
    return counts


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over links (a, b); nodes without a link are absent.

    Rounds of large and small stars: every node hands its larger neighbours,
    then its smaller ones, to the smallest it knows. Each round is written to
    the shared folder.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    state = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("c")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
        small = large.join(least, F.col("u") == F.col("c"))
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.*").where("u != v").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("links did not join")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots).distinct()


class _Finder:
    """Links between the classes of one table."""

    def __init__(self, docs: DataFrame, n: int, similarity: float):
        self.docs, self.n, self.similarity = docs, n, similarity
        bound_batches(docs.sparkSession)
        keyed = docs.select(F.col("doc_id").cast("long").alias("key"), "text")
        self.sets = stored(keyed.mapInArrow(_sketcher(n, SKETCH), _SETS), "sketches")
        # rows of one set have one sketch, so any of them is the class's
        classes = self.sets.where("set_hash is not null and key is not null").groupBy("set_hash").agg(
            F.min("key").alias("node"), F.first("n_shingles").alias("n"), F.first("hashes").alias("hashes")
        )
        classes = stored(classes, "classes")
        self.classes, self.sketches = classes.select("set_hash", "node"), classes.select("node", "n", "hashes")
        kept = self.sketches.select("node", "n", F.explode("hashes").alias("v"))
        common = kept.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
        ranked = kept.join(common, "v").groupBy("node", "n").agg(
            F.sort_array(F.collect_list(F.struct("df", "v"))).alias("shared"), F.sum(F.log2("df")).alias("spread")
        )
        # hashes that no other class keeps come first in the order and make no list
        single = F.least("n", F.lit(SKETCH)) - F.size("shared")
        length = F.greatest(prefix_length(similarity) - single, F.lit(0)).cast("int")
        entries = ranked.select("node", "spread", F.explode(F.slice("shared", 1, length)).alias("e"))
        entries = entries.select("node", "spread", F.col("e.v").alias("v"), F.col("e.df").alias("df"))
        self.entries = stored(entries, "lists")
        self.sizes = self.entries.groupBy("v").agg(F.count("*").alias("members")).where("members > 1")

    def candidates(self) -> DataFrame:
        """(a, b), a < b: all pairs of short lists, and each member of a long one with its hubs."""
        lists = self.entries.join(self.sizes, "v")
        short = lists.where(F.col("members") <= SHORT_LIST).groupBy("v").agg(F.sort_array(F.collect_set("node")).alias("m"))
        short = short.select(F.posexplode("m").alias("i", "a"), "m").select("a", F.explode(F.expr(f"slice(m, i + 2, {SHORT_LIST})")).alias("b"))
        long_ = lists.where(F.col("members") > SHORT_LIST)
        hubs = [
            long_.groupBy("v").agg(F.max(F.struct(F.col("spread") if i == 0 else F.lit(0.0), F.xxhash64("node", F.lit(i)).alias("h"), "node")).alias("hub"))
            for i in range(HUBS)
        ]
        hub = hubs[0].select("v", F.col("hub.node").alias("hub"))
        for more in hubs[1:]:
            hub = hub.unionByName(more.select("v", F.col("hub.node").alias("hub")))
        hub = hub.groupBy("v").agg(F.collect_set("hub").alias("hubs"))
        stars = long_.join(hub, "v").select("node", F.explode("hubs").alias("hub"))
        stars = stars.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).where("a != b")
        return short.unionByName(stars).distinct()

    def estimated(self, pairs: DataFrame) -> DataFrame:
        a = self.sketches.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("hashes_a"))
        b = self.sketches.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("hashes_b"))
        fits = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * self.similarity - 1e-6
        shared = F.size(F.array_intersect("hashes_a", "hashes_b"))
        least = F.when(F.least("n_a", "n_b") > SKETCH, F.lit(least_overlap(SKETCH + 1, self.similarity))).otherwise(F.lit(1))
        joined = pairs.join(a, "a").join(b, "b").where(fits & (shared >= least))
        return joined.mapInPandas(_estimator(self.similarity), "a long, b long").distinct()

    def full_sets(self, nodes: DataFrame) -> DataFrame:
        """(node, n, hashes) with the whole set of every class among the nodes.

        Texts that cannot be a node's stay where they are: a table of the slots
        that node ids hash to is laid over the scan before anything is dealt out.
        """
        wanted = stored(self.classes.join(nodes, "node").select("node", F.col("set_hash").alias("want")), "wanted")
        slot = lambda key: F.pmod(F.xxhash64(key), F.lit(FILTER_BITS).cast("long"))
        bit = F.expr("shiftleft(1L, cast(slot % 64 as int))")
        table = wanted.select(slot("node").alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("mask"))
        keyed = self.docs.select(F.col("doc_id").cast("long").alias("key"), "text")
        marked = keyed.join(F.broadcast(table), F.shiftright(slot("key"), 6) == F.col("word"))
        near = marked.where(F.getbit("mask", (slot("key") % 64).cast("int")) == 1).select("key", "text").distinct()
        texts = near.join(wanted, F.col("key") == F.col("node")).select("key", "text", "want")
        sets = stored(texts.mapInArrow(_sketcher(self.n, None), _SETS + ", want string").where("set_hash = want"), "sets")
        return sets.select(F.col("key").alias("node"), F.col("n_shingles").alias("n"), "hashes")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs whose full sets reach the similarity."""
        pairs = stored(self.estimated(pairs), "pairs")
        sets = self.full_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        a = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("hashes").alias("set_a"))
        b = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("hashes").alias("set_b"))
        links = pairs.join(a, "a").join(b, "b").withColumn("both", F.size(F.array_intersect("set_a", "set_b")))
        links = links.where(F.col("both") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("both")) * round(self.similarity * 100))
        return stored(links.select("a", "b").distinct(), "confirmed")

    def families(self, labels: DataFrame) -> DataFrame:
        """(family, node, label, open): members of the long lists that still hold several components.

        Lists with the same largest component hold much the same members, so
        they are one family. A member outside that component is open.
        """
        long_ = self.entries.join(self.sizes.where(F.col("members") > SHORT_LIST), "v").select("v", "node")
        long_ = long_.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        counts = long_.groupBy("v", "label").agg(F.count("*").alias("c"))
        main = counts.groupBy("v").agg(F.max(F.struct("c", "label")).alias("top"), F.count("*").alias("labels"))
        main = main.where("labels > 1").select("v", F.col("top.label").alias("family"))
        members = long_.join(main, "v").select("family", "node", "label").distinct()
        return members.withColumn("open", F.col("label") != F.col("family"))

    def open_links(self, families: DataFrame) -> DataFrame:
        """Links (a, b) of the open members with the members of other components in their families.

        Both sides are cut into blocks of bounded size, and each pair of
        blocks is a group of its own.
        """
        sets = self.full_sets(families.select("node").distinct())
        rows = families.join(sets, "node")
        parts = lambda one: F.ceil(F.greatest(F.sum(one) / BLOCK, F.sum(one * F.col("n")) / BLOCK_HASHES)).cast("int")
        sizes = families.join(sets.select("node", "n"), "node").groupBy("family").agg(
            parts(F.col("open").cast("int")).alias("rest"), parts(F.lit(1)).alias("whole")
        )
        # a family may hold most rows: its members meet their sizes in shares
        sizes = sizes.where("rest > 0").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
        rows = rows.withColumn("_h", F.pmod(F.xxhash64("node"), F.lit(1 << 30))).withColumn("share", (F.shiftright("_h", 20) % SHARES).cast("int"))
        rows = rows.join(sizes, ["family", "share"])
        opened = rows.where("open").withColumn("i", F.pmod("_h", "rest")).withColumn("j", F.explode(F.expr("sequence(0, whole - 1)")))
        every = rows.withColumn("open", F.lit(False)).withColumn("j", F.pmod("_h", "whole")).withColumn("i", F.explode(F.expr("sequence(0, rest - 1)")))
        kept = ["family", "i", "j", "node", "label", "n", "open", "hashes"]
        blocks = opened.select(*kept).unionByName(every.select(*kept))
        return blocks.groupBy("family", "i", "j").applyInPandas(_blocks(self.similarity), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, n: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, links), one row for each input row.

    Words are split at ASCII white space after lower-casing A-Z. A text of
    fewer than ``n`` words has its whole sequence as its one shingle; a null or
    wordless one has none, is linked with nothing and kept. ``component_id`` is
    the smallest id reachable over links, ``kept`` whether it is the row's own,
    ``links`` the confirmed links of the row's set to other sets, equal sets
    not counted; a long list confirms as many as join its members. A null id
    is a component of its own, null. Rows that repeat an id are one node. An
    empty table gives an empty result.
    """
    finder = _Finder(docs, n, similarity)
    links = finder.confirmed(finder.candidates())
    labels = stored(components(links), "labels")
    families = stored(finder.families(labels), "families")
    if not families.isEmpty():
        links = stored(links.unionByName(finder.open_links(families)).distinct(), "links")
        labels = stored(components(links), "labels")
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    named = finder.classes.join(labels, "node", "left").join(degree, "node", "left").select(
        "set_hash", F.coalesce("label", "node").alias("component"), F.coalesce("links", F.lit(0).cast("long")).alias("links")
    )
    rows = finder.sets.select("key", "n_shingles", "set_hash").join(named, "set_hash", "left")
    # an id that stands for several sets joins them
    component = F.coalesce(F.when(F.col("key").isNotNull(), F.col("component")), F.col("key"))
    return rows.select(
        F.col("key").alias("doc_id"), "n_shingles", component.alias("component_id"),
        (F.col("key").isNull() | (component == F.col("key"))).alias("kept"), F.coalesce("links", F.lit(0).cast("long")).alias("links"),
    )


def drop_near_duplicates(docs: DataFrame, n: int = 5, similarity: float = 0.8) -> DataFrame:
    """The input without the rows whose component has a smaller id; null ids stay."""
    gone = near_duplicates(docs, n, similarity).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(carried(docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_key"))
    return rows.join(gone, F.col("_key") == F.col("gone"), "left_anti").select(*restored(docs.columns))
