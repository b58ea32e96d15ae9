"""Hard-negative mining: inner products searched with cover trees over norm-augmented vectors.

A further component gives all vectors of a tree one norm; then the points that
a node covers lie in a cone around its centre, whose width follows from the
covering radius, and the cone bounds their inner products with any query.
A query descends best first: it opens the node with the highest bound, skips
nodes that lie outside all its score windows or under what it has found, and
computes the scores of a leaf exactly.

The queries (anchors) are dealt into blocks and the candidates into groups, by
hash; every block meets every group in one task, which reads the candidates as
a stream, builds a tree of each ``TREE_ROWS`` of them, and carries each
anchor's best rows on from tree to tree. So a task holds one block and one tree,
and what it returns does not grow with its group. Blocks grow with the anchors;
groups only fill the cluster.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestal.llm.common import bound_batches, stored

#: Anchors of a block, candidates of a tree, rows of a leaf, children of a node.
BLOCK, TREE_ROWS, LEAF, CHILDREN = 4096, 8192, 96, 16
#: A node of so many rows, none of whose children can be skipped, is verified as a whole.
AT_ONCE = 2048
#: Each level's covering radius is at most this share of the one above, where ``CHILDREN`` centres suffice.
SHRINK = 0.5
#: Block-by-group tasks for each core of the cluster.
TASKS_PER_CORE = 4
SCALE = 256
_NO_ID = np.iinfo(np.int64).max
_EXACT = 2.0**53


def quantised(vectors: pa.ListArray, width: int) -> np.ndarray:
    """floor(256 * x) of each component, as doubles; short vectors go on with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == width).all():
        table = values.reshape(-1, width)
    else:
        table = np.zeros((len(sizes), width))
        table[np.arange(width)[None, :] < sizes[:, None]] = values
    return np.floor(table * SCALE)


class CoverTree:
    """Points of one norm by nested balls: children lie within their node's radius, their centres apart from each other."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        squares = (points * points).sum(axis=1)
        self.norm = float(np.sqrt(squares.max(initial=0.0)))
        lifted = np.column_stack([points, np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0.0))])
        # depth first, so that the rows below a node lie together
        order, self.centres, self.radii, self.spans, self.children = [], [], [], [], []
        todo = [(np.arange(len(points)), 0, -1)]
        while todo:
            members, centre, parent = todo.pop()
            node = len(self.centres)
            self.centres.append(centre)
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            away = _distances(lifted[members], lifted[centre])
            self.radii.append(float(away.max(initial=0.0)))
            if len(members) <= LEAF or self.radii[-1] == 0.0:
                self.spans.append((len(order), len(order) + len(members)))
                order.extend(members[np.argsort(ids[members], kind="stable")].tolist())
                continue
            self.spans.append((len(points), 0))
            for child, part in self._split(lifted, members, away):
                todo.append((part, child, node))
        order = np.array(order, dtype=np.int64)
        self.points, self.ids, self.labels = points[order], ids[order], labels[order]
        self.heart = points[self.centres]
        self.largest = float(np.abs(points).max(initial=0.0))
        # on the sphere of one norm a chord of the radius spans this angle
        chord = np.array(self.radii) * (1 + 1e-9) / (2 * self.norm) if self.norm else np.zeros(len(self.radii))
        self.angles = 2 * np.arcsin(np.minimum(chord, 1.0)) + 1e-7
        self.first_id, self.one_label = self._summaries()

    def _summaries(self) -> tuple[list[int], list[int | None]]:
        """By node: its smallest id, and its label where it has only one; inner nodes get the span of their rows."""
        first, label = [_NO_ID] * len(self.centres), [None] * len(self.centres)
        for node in range(len(self.centres) - 1, -1, -1):
            below = self.children[node]
            if below:
                first[node] = min(first[c] for c in below)
                label[node] = label[below[0]] if len({label[c] for c in below}) == 1 else None
                self.spans[node] = (min(self.spans[c][0] for c in below), max(self.spans[c][1] for c in below))
            else:
                start, stop = self.spans[node]
                first[node] = int(self.ids[start:stop].min())
                found = np.unique(self.labels[start:stop])
                label[node] = int(found[0]) if len(found) == 1 else None
        return first, label

    @staticmethod
    def _split(lifted: np.ndarray, members: np.ndarray, away: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Centres farthest first, until all members are near one; each member goes to the nearest."""
        limit = away.max() * SHRINK
        points = lifted[members]
        centres, nearest = [], np.full(len(members), np.inf)
        owner = np.zeros(len(members), dtype=np.int64)
        at = int(away.argmax())
        while len(centres) < CHILDREN and (not centres or nearest.max() > limit):
            far = _distances(points, points[at])
            owner[far < nearest] = len(centres)
            nearest = np.minimum(nearest, far)
            centres.append(int(members[at]))
            at = int(nearest.argmax())
        for i, centre in enumerate(centres):
            yield centre, members[owner == i]

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest whole inner product that the points of each node (rows) can have with each query (columns)."""
        sizes = np.sqrt((queries * queries).sum(axis=1))
        reach = self.norm * sizes
        cosine = np.divide(self.heart @ queries.T, reach[None, :], out=np.zeros((len(self.heart), len(queries))), where=reach[None, :] > 0)
        angle = np.arccos(np.clip(cosine, -1.0, 1.0))
        slack = 1e-9 * reach + 1e-3
        high = reach * np.cos(np.maximum(angle - self.angles[:, None], 0.0)) + slack
        low = reach * np.cos(np.minimum(angle + self.angles[:, None], np.pi)) - slack
        return np.ceil(low), np.floor(high)

    def scores(self, start: int, stop: int, query: np.ndarray) -> np.ndarray:
        """Exact inner products; beyond what doubles hold exactly, in whole numbers of any size."""
        if self.largest * float(np.abs(query).max(initial=0.0)) * len(query) < _EXACT:
            return self.points[start:stop] @ query
        whole = [[int(x) for x in row] for row in self.points[start:stop]]
        told = [int(x) for x in query]
        return np.array([sum(a * b for a, b in zip(row, told, strict=True)) for row in whole], dtype=object)


def _distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gaps = points - centre
    return np.sqrt(np.einsum("ij,ij->i", gaps, gaps))


class Best:
    """The first ``k`` rows of one score window: higher scores first, then smaller ids."""

    def __init__(self, low: float, high: float, k: int) -> None:
        self.low, self.high, self.k = low, high, k
        self.rows: list[tuple[int, int]] = []  # (-score, id)
        self.floor: float = low

    def skips(self, low: float, high: float, first_id: int) -> bool:
        """True where no row of a node with these bounds can be among the first."""
        if high < self.floor or low > self.high or self.low > self.high:
            return True
        return len(self.rows) == self.k and high == -self.rows[-1][0] and first_id > self.rows[-1][1]

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = np.flatnonzero((scores >= self.floor) & (scores <= self.high))
        if not len(fits):
            return
        if len(fits) > self.k and scores.dtype != object:
            fits = fits[np.lexsort((ids[fits], -scores[fits]))][: self.k]
        found = [(-int(scores[i]), int(ids[i])) for i in fits]
        self.rows = sorted(self.rows + found)[: self.k]
        if len(self.rows) == self.k:
            self.floor = max(self.low, -self.rows[-1][0])


def search(tree: CoverTree, query: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: list[Best], label: int, same: bool, own: int) -> None:
    """Best-first descent for one query; its windows take what they want. ``low`` and ``high`` bound each node."""

    wanted = [best for best in wanted if best.low <= best.high]
    if not wanted:
        return
    low, high = low.tolist(), high.tolist()
    one_label, first_id = tree.one_label, tree.first_id
    # no window takes a score outside these two
    floor, top = min(best.floor for best in wanted), max(best.high for best in wanted)

    def useless(node: int) -> bool:
        if high[node] < floor or low[node] > top:
            return True
        if one_label[node] is not None and (one_label[node] == label) != same:
            return True
        return all(best.skips(low[node], high[node], first_id[node]) for best in wanted)

    heap = [(-high[0], 0)]
    while heap:
        _, node = heapq.heappop(heap)
        if useless(node):
            continue
        start, stop = tree.spans[node]
        below = tree.children[node]
        if below:
            if stop - start > AT_ONCE or any(high[child] < floor or low[child] > top for child in below):
                for child in below:
                    if not useless(child):
                        heapq.heappush(heap, (-high[child], child))
                continue
        scores = tree.scores(start, stop, query)
        hits = np.flatnonzero(scores >= floor)
        if not len(hits):
            continue
        scores, ids = scores[hits], tree.ids[start:stop][hits]
        keep = ((tree.labels[start:stop][hits] == label) == same) & (scores <= top)
        if same:
            keep &= ids != own
        if keep.any():
            scores, ids = scores[keep], ids[keep]
            highest = scores.max()
            for best in wanted:
                if highest >= best.floor:
                    best.offer(scores, ids)
            floor = min(best.floor for best in wanted)


class Block:
    """Anchors of one block, and the best rows of each window so far."""

    def __init__(self, k: int, same: bool, width: int) -> None:
        self.k, self.same, self.width = k, same, width
        self.ids, self.marks, self.labels, self.vectors, self.asked, self.best = [], [], [], [], [], []
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def anchors(self, batch: pa.RecordBatch) -> None:
        self.vectors.append(quantised(batch.column("vec"), self.width))
        self.ids += batch.column("id").to_pylist()
        self.marks += batch.column("mark").to_pylist()
        self.labels += batch.column("label").to_pylist()
        for asked in batch.column("asked").to_pylist():
            asked = asked or []
            self.asked.append(asked)
            self.best.append([Best(a["low"], a["high"], self.k) for a in asked] if not self.same else [Best(-np.inf, np.inf, self.k)])

    def candidates(self, batch: pa.RecordBatch) -> None:
        ids = batch.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        self.waiting.append((quantised(batch.column("vec"), self.width), ids, batch.column("label").to_numpy(zero_copy_only=False)))
        self.held += batch.num_rows
        if self.held >= TREE_ROWS:
            self.look()

    def look(self) -> None:
        """Searches the candidates held, and lets go of them."""
        if self.held and self.ids:
            points, ids, labels = (np.concatenate(parts) for parts in zip(*self.waiting, strict=True))
            queries = np.concatenate(self.vectors)
            self.vectors = [queries]
            for start in range(0, self.held, TREE_ROWS):
                part = slice(start, start + TREE_ROWS)
                tree = CoverTree(points[part], ids[part], labels[part])
                for first in range(0, len(queries), 512):
                    low, high = tree.bounds(queries[first : first + 512])
                    for i in range(first, min(first + 512, len(queries))):
                        own = _NO_ID if self.ids[i] is None else self.ids[i]
                        search(tree, queries[i], low[:, i - first], high[:, i - first], self.best[i], self.labels[i], self.same, own)
        self.waiting, self.held = [], 0

    def rows(self) -> Iterator[tuple]:
        for anchor, mark, asked, windows in zip(self.ids, self.marks, self.asked, self.best, strict=True):
            for number, best in enumerate(windows):
                positive = asked[number] if asked else {"positive_id": None, "positive_score": None, "place": None}
                for score, found in best.rows:
                    row = None if found == _NO_ID else found
                    yield anchor, mark, positive["place"], positive["positive_id"], positive["positive_score"], row, _long(-score)


def _long(score: int) -> int:
    return max(-(2**63) + 1, min(2**63 - 1, score))


_FOUND = "anchor_id long, mark long, place int, positive_id long, positive_score long, found_id long, score long"


def _searcher(k: int, same: bool, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _FOUND.split(", ")]
        types = [pa.int32() if f.endswith(" int") else pa.int64() for f in _FOUND.split(", ")]

        def told(block: Block) -> Iterator[pa.RecordBatch]:
            block.look()
            rows = list(block.rows())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        block, open_cell = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column("cell").to_numpy()
            kinds = batch.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero((np.diff(cells) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), len(cells)]
            for start, stop in zip(edges, edges[1:], strict=False):
                if cells[start] != open_cell:
                    if block is not None:
                        yield from told(block)
                    block, open_cell = Block(k, same, width), cells[start]
                part = batch.slice(start, stop - start)
                (block.anchors if kinds[start] == 0 else block.candidates)(part)
        if block is not None:
            yield from told(block)

    return run


def _searched(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, k: int, same: bool, width: int) -> DataFrame:
    """The first ``k`` rows of each anchor's windows in every group: blocks of anchors against groups of rows."""
    blocks = max(1, -(-n_anchors // BLOCK))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    groups = max(1, min(-(-n_rows // TREE_ROWS), -(-TASKS_PER_CORE * cores // blocks)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = F.pmod(F.xxhash64("id", "mark"), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("id", "vec"), F.lit(groups)).cast("int")
    asked = anchors.withColumn("kind", F.lit(0)).withColumn("group", every(groups)).withColumn("cell", block * groups + F.col("group"))
    given = rows.withColumn("kind", F.lit(1)).withColumn("block", every(blocks)).withColumn("cell", F.col("block") * groups + group)
    given = given.withColumns({"mark": F.lit(None).cast("long"), "asked": F.lit(None).cast(anchors.schema["asked"].dataType)})
    columns = ["cell", "kind", "id", "mark", "label", "vec", "asked"]
    # more partitions than cells, so that few share one
    dealt = asked.select(columns).unionByName(given.select(columns)).repartition(2 * blocks * groups, "cell").sortWithinPartitions("cell", "kind")
    return dealt.mapInArrow(_searcher(k, same, width), _FOUND)


def _first(found: DataFrame, keys: list[str], k: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("found_id").asc_nulls_last())
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


_ASKED = "array<struct<low: long, high: long, place: int, positive_id: long, positive_score: long>>"


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each anchor and positive.

    Components become floor(256 * x); a score is the inner product of two rows.
    An anchor's positives are its first rows of the same label, its negatives
    for one of them the first rows of other labels whose score is from
    ``low_percent`` to ``high_percent`` of the positive's: higher scores first,
    then smaller keys, a null key last. Exact.

    Rows with a null label or vector, or with a null or non-finite component,
    take no part. Rows of the anchor's own key are never its positives; an
    anchor listed again with the same label and vector is one anchor, other
    repeated rows count each. Short vectors go on with zeros. Scores beyond a
    long are told as the nearest long. ``key`` is a whole number, ``label``
    an int. Other columns are not read. An empty table, or one without anchors,
    gives an empty result.
    """
    bound_batches(vectors.sparkSession)
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vec"), F.coalesce(is_anchor, F.lit(False)).alias("_asks")
    )
    anchors = rows.where("_asks").drop("_asks").distinct().withColumn("mark", F.xxhash64("label", "vec"))
    rows = rows.drop("_asks")
    n_rows, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    n_anchors = anchors.count()
    width = max(1, width)
    unasked = anchors.withColumn("asked", F.lit(None).cast(_ASKED))
    near = _searched(rows, unasked, n_rows, n_anchors, positives, True, width)
    near = _first(near, ["anchor_id", "mark"], positives, "at")
    # the least and the greatest whole score between the two percentages
    percent = lambda p: F.col("score").cast("decimal(38,0)") * p
    window = F.struct(
        F.ceil(percent(low_percent) / 100).cast("long").alias("low"), F.floor(percent(high_percent) / 100).cast("long").alias("high"),
        F.col("at").cast("int").alias("place"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    windows = stored(near.groupBy("anchor_id", "mark").agg(F.array_sort(F.collect_list(window)).alias("asked")), "positives")
    asking = anchors.join(windows, (F.col("id") == F.col("anchor_id")) & (anchors["mark"] == windows["mark"])).select(
        "id", "label", "vec", anchors["mark"], F.col("asked").cast(_ASKED).alias("asked")
    )
    far = _searched(rows, asking, n_rows, n_anchors, negatives, False, width)
    ranked = _first(far, ["anchor_id", "mark", "place"], negatives, "rank")
    return ranked.select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
