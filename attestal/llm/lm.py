"""Language-model scores of whole documents: word frequencies and a gated recurrent network.

Word counts of all training documents are combined map-side. The network
(``gru``) knows every word of the dictionary; any other is predicted as
"outside" and shares that probability by its count, so both scores are over the
same words. Weights are fitted in rounds: every task trains on its own documents
from the common weights, and the averages are the next common ones: by tokens,
and for the rows of single words by the times each was moved. Scoring carries
the state through the whole text.

The counts of up to ``DICTIONARY`` words are broadcast; the words beyond are
looked up by a join, after being counted per document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal.llm import gru
from attestal.llm.common import bound_batches, remainder, stored

#: Held out: documents whose crc32 leaves this remainder.
MODULUS, HELD_OUT = 5, 1
#: Words whose counts are broadcast (the size bound), the most frequent ones.
DICTIONARY = 1 << 18
#: Rounds of fitting; documents fall into as many parts, and each round takes the next one, so that every document is trained on.
ROUNDS = 3
#: Rows of the weights that travel as one block.
BLOCK = 2048
#: Tokens that are trained on or scored side by side.
BATCH_TOKENS = 1_500_000
#: Bytes of a batch of texts that a task gets at a time.
TEXT_BYTES = 9 << 20
#: End of a text, as a token.
END = b""


def tokens_of(text: str | None) -> list[bytes]:
    """Words in lower-cased A-Z, split at ASCII white space, and the end."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def _token_array(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``tokens_of`` all texts, one after the other, and where those of each text end."""
    # with a space behind it, every text's last piece is empty: its end
    texts = pc.binary_join_element_wise(pc.fill_null(texts, ""), "", " ")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    pieces, ends = lists.flatten().cast(pa.binary()), np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)
    kept = pc.binary_length(pieces).to_numpy() > 0
    kept[ends - 1] = True
    return pieces.filter(pa.array(kept)), np.cumsum(kept)[ends - 1]


def held_out() -> Column:
    return remainder("doc_id", MODULUS) == HELD_OUT


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pc.value_counts(_token_array(batch.column(0))[0])
        yield pa.RecordBatch.from_arrays(found.flatten(), names=["word", "n"])


@dataclass(frozen=True)
class Lexicon:
    """Counts of the frequent words and what is known of all of them."""

    places: dict[bytes, int]
    counts: np.ndarray
    tokens: int
    distinct: int

    @property
    def known(self) -> int:
        """Words of the network's softmax; the others are leaves of its tail."""
        return min(gru.WORDS - 1, len(self.places))

    @cached_property
    def order(self) -> np.ndarray:
        """Places of the words of the tail in the order of its leaves: by their ends, so that words of one ending are near each other."""
        words = list(self.places)
        return np.array(sorted(range(self.known, len(words)), key=lambda i: words[i][::-1]), np.int64)

    @property
    def outside_tokens(self) -> float:
        return float(self.tokens - self.counts.sum())

    @cached_property
    def codes(self) -> np.ndarray:
        """The network's words by place; the last one, which place -1 finds, is the leaf of all words outside the dictionary."""
        codes = np.arange(len(self.places) + 1, dtype=np.int32)
        codes[self.order] = gru.WORDS - 1 + np.arange(len(self.order))
        codes[-1] = gru.WORDS - 1 + len(self.order)
        return codes

    def network_counts(self) -> np.ndarray:
        counts = np.zeros(gru.WORDS)
        counts[: self.known] = self.counts[: self.known]
        counts[-1] = self.tokens - counts.sum()
        return counts

    @cached_property
    def tree(self) -> gru.Tree:
        return gru.tree_of(np.append(self.counts[self.order], self.outside_tokens) + 0.5)

    def base_log(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def outside_scale(self) -> float:
        """What a word outside the dictionary has its count and a half divided by."""
        return self.outside_tokens + 0.5 * (self.distinct - len(self.places) + 1)


def _texts(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[tuple[list[np.ndarray], list[np.ndarray], list[list[bytes]], pa.RecordBatch]]:
    """Batches of about ``BATCH_TOKENS``: places in the lexicon (-1 outside), network words, words outside, other columns."""
    known, codes = pa.array(list(lexicon.places), pa.binary()), lexicon.codes
    for batch in batches:
        tokens, ends = _token_array(batch.column("text"))
        every = pc.fill_null(pc.index_in(tokens, known), -1).to_numpy()
        first = 0
        while first < batch.num_rows:
            start = ends[first - 1] if first else 0
            last = min(int(np.searchsorted(ends, start + BATCH_TOKENS)) + 1, batch.num_rows)
            found, cuts = every[start : ends[last - 1]], ends[first : last - 1] - start
            outside = np.flatnonzero(found < 0)
            words = tokens.take(pa.array(outside + start)).to_pylist()
            edges = np.searchsorted(outside, [0, *cuts, len(found)]).tolist()
            rare = [words[i:j] for i, j in pairwise(edges)]
            yield np.split(found, cuts), np.split(codes.take(found, mode="wrap"), cuts), rare, batch.slice(first, last - first)
            first = last


@dataclass(frozen=True)
class Weights:
    """The network's dense weights and the rows of its tail."""

    dense: np.ndarray
    tail: np.ndarray

    def model(self, tree: gru.Tree) -> gru.Model:
        return gru.Model(gru.shaped(self.dense), gru.Tail(tree, self.tail.copy()))

    def rows(self) -> np.ndarray:
        """All in one table: the dense ones first, filled up with zeros."""
        dense = np.concatenate([self.dense, np.zeros(-len(self.dense) % gru.TAIL_WIDTH, self.dense.dtype)])
        return np.concatenate([dense.reshape(-1, gru.TAIL_WIDTH), self.tail])

    def moved(self, rows: np.ndarray, steps: np.ndarray) -> Weights:
        table = self.rows()
        table[rows] += steps
        first = len(table) - len(self.tail)
        return Weights(table[:first].reshape(-1)[: len(self.dense)], table[first:])


def _blocks(rows: np.ndarray, weights: np.ndarray, steps: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rising rows of the table by block: their numbers, weights and steps."""
    edges = np.flatnonzero(np.diff(rows // BLOCK, prepend=-1))
    for start, end in zip(edges, [*edges[1:], len(rows)], strict=True):
        columns = [[int(rows[start] // BLOCK)]] + [[x[start:end].tobytes()] for x in (rows.astype(np.int32), weights.astype(np.float32), steps.astype(np.float32))]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=_NAMES)


_NAMES = ["block", "rows", "weights", "steps"]
_BLOCKS = "block int, rows binary, weights binary, steps binary"


def _trainer(shared, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common: Weights = weights.value
        model = common.model(shared.value.tree)
        squares = {k: np.zeros(s, np.float32) for k, s in gru.SHAPES.items()}
        tokens = 0
        for _, words, _, _ in _texts(batches, shared.value):
            model.train([w.astype(np.int64) for w in words], squares)
            tokens += sum(map(len, words))
        if tokens:
            table = common.rows()
            moves = np.full(len(table), float(tokens))
            moves[len(table) - len(common.tail) :] = model.tail.moves
            rows = np.flatnonzero(moves)
            yield from _blocks(rows, moves[rows], Weights(gru.flat(model.p), model.tail.table).rows()[rows] - table[rows])

    return run


def _averages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean steps of the rows of each block that this task has, by their weights."""
    sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for block, *values in zip(*(batch.column(name).to_pylist() for name in _NAMES), strict=True):
            rows, weights, steps = np.frombuffer(values[0], np.int32) - block * BLOCK, *(np.frombuffer(v, np.float32) for v in values[1:])
            total, weight = sums.setdefault(block, (np.zeros((BLOCK, gru.TAIL_WIDTH)), np.zeros(BLOCK)))
            total[rows] += steps.reshape(-1, gru.TAIL_WIDTH) * weights[:, None].astype(np.float64)
            weight[rows] += weights
    for block, (total, weight) in sums.items():
        rows = np.flatnonzero(weight)
        yield from _blocks(rows + block * BLOCK, weight[rows], total[rows] / weight[rows, None])


def _scorer(shared, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon: Lexicon = shared.value
        model = weights.value.model(lexicon.tree)
        base = lexicon.base_log(lexicon.counts)
        number = TaskContext.get().partitionId() << 40
        for places, words, rare, rest in _texts(batches, shared.value):
            score = model.log_probabilities([w.astype(np.int64) for w in words]) / math.log(10)
            base_score, n_known = np.zeros(len(words)), np.zeros(len(words), np.int64)
            for i, found in enumerate(places):
                known = found[found >= 0]
                n_known[i] = len(known)
                base_score[i] = base[known].sum()
            rows = np.arange(number, number + len(words))
            number += len(words)
            columns = [
                rest.column("doc_id"), rest.column("held_out"), pa.array(rows), pa.array([len(w) for w in words], pa.int64()),
                pa.array(n_known), pa.array(base_score), pa.array(score), pa.array(rare, pa.list_(pa.binary())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "row", "n_tokens", "n_known", "base_score", "score", "rare"])

    return run


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all tokens of the texts."""
    counts = docs.select("text").mapInArrow(_count, "word binary, n long")
    return stored(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")


def lexicon_of(words: DataFrame) -> Lexicon:
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = words.orderBy(F.desc("n"), "word").limit(DICTIONARY).toArrow()
    places = {w: i for i, w in enumerate(top.column("word").to_pylist())}
    lexicon = Lexicon(places, np.array(top.column("n").to_pylist(), np.float64), total["n"], total["v"])
    _ = lexicon.codes, lexicon.tree  # worked out here, they travel with it
    return lexicon


def rounds(docs: DataFrame) -> list[DataFrame]:
    """The documents of each round; every document is in exactly one of them, by id."""
    part = F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS))
    return [docs.where(part == i) for i in range(ROUNDS)]


def fit(docs: DataFrame, shared, lexicon: Lexicon) -> Weights:
    """The network's weights after all ``rounds``."""
    context = docs.sparkSession.sparkContext
    values = Weights(gru.flat(gru.first_parameters(lexicon.network_counts(), tree=lexicon.tree)), gru.first_tail(lexicon.tree))
    # a task trains on a batch at least: small ones would move apart and leave most lanes empty
    tasks = math.ceil(lexicon.tokens / (ROUNDS * BATCH_TOKENS)) or 1
    for part in rounds(docs):
        weights = context.broadcast(values)
        trained = part.select("text").coalesce(tasks).mapInArrow(_trainer(shared, weights), _BLOCKS)
        means = trained.repartition("block").mapInArrow(_averages, _BLOCKS).toArrow()
        if means.num_rows:
            rows, steps = (np.concatenate([np.frombuffer(v, t) for v in means.column(c).to_pylist()]) for c, t in (("rows", np.int32), ("steps", np.float32)))
            values = values.moved(rows, steps.reshape(-1, gru.TAIL_WIDTH))
        weights.unpersist()
    return values


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of (doc_id, text).

    Scores are log10 probabilities of the whole text with its end. A null text
    counts as empty: its end is its only token. A null id counts as not held
    out. Repeated rows teach and are scored one by one. Where nothing can be
    learned, ``n_known`` is 0 and words are as likely as the formula says. An
    empty table gives an empty result.
    """
    bound_batches(docs.sparkSession, TEXT_BYTES)
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    words = count_words(rows.where("not held_out"))
    lexicon = lexicon_of(words)
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    values = fit(rows.where("not held_out"), shared, lexicon)
    weights = rows.sparkSession.sparkContext.broadcast(values)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, row long, n_tokens long, n_known long, base_score double, score double, rare array<binary>"
    scored = stored(rows.mapInArrow(_scorer(shared, weights), schema), "scores")
    rare = scored.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    n = F.coalesce("n", F.lit(0))
    rare = rare.join(words, "word", "left").groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10((n + 0.5) / (lexicon.tokens + 0.5 * (lexicon.distinct + 1)))).alias("base"),
        F.sum(F.col("times") * F.log10((n + 0.5) / lexicon.outside_scale())).alias("other"),
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("known")).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + zero("base")).alias("base_score"), (F.col("score") + zero("other")).alias("score"),
    )
