"""Language ID by mixture inference over character n-grams.

Learning counts hashed character trigrams of lower-cased letters for every
language, combined map-side. A document is a mixture: each of its trigrams was
drawn from one of its languages. Expectation-maximisation estimates the
proportions; languages join the set, best first, while the likelihood they add
exceeds a penalty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal.llm.common import bound_batches, remainder, text_chunks

#: Buckets of hashed trigrams; languages that are learned at most, the most frequent ones (the model's size bound).
BUCKETS, MAX_LANGUAGES = 1 << 15, 256
#: Pseudo-count of a bucket; price of one more language, in logarithms of the number of trigrams (each letter is in three).
SMOOTHING, PENALTY = 0.05, 3.0
#: Rounds of expectation-maximisation, and the change of proportions at which they end.
ROUNDS, CLOSE = 40, 1e-4
#: Shares under this are left out of the sets that are tried.
LEAST_SHARE = 0.02
#: Held out: documents whose crc32 leaves this remainder.
MODULUS, HELD_OUT = 4, 2
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) of every trigram of each text's letters, words set apart by single blanks."""
    cleaned = [_NOT_LETTERS.sub(" ", f" {t.lower()} ") for t in texts]
    cleaned = [t if t.strip() else "" for t in cleaned]
    codes = np.frombuffer("".join(cleaned).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) for t in cleaned])
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mixed = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA6B) + codes[2:] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    inside = owner[:-2] == owner[2:]
    return owner[:-2][inside], (mixed >> np.uint32(17)).astype(np.int64)[inside]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, table in counts.items():
            found = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(table[found])], names=["lang", "bucket", "n"]
            )
        counts.clear()

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for first, texts in text_chunks(batch.column("text")):
            owner, bucket = trigrams(texts)
            here = langs[first : first + len(texts)]
            for lang in set(here):
                mine = np.array([x == lang for x in here])
                table = np.bincount(bucket[mine[owner]], minlength=BUCKETS)
                counts[lang] = counts.get(lang, 0) + table
            if len(counts) > MAX_LANGUAGES:
                yield from flush()
    yield from flush()


@dataclass(frozen=True)
class Model:
    """``odds[bucket, language]``: probability of a trigram in each language."""

    languages: tuple[str, ...]
    odds: np.ndarray

    def shares(self, counts: np.ndarray, odds: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions and log-likelihood of a text whose trigrams have these counts and probabilities."""
        share = start / start.sum()
        total = counts.sum()
        for _ in range(ROUNDS):
            mixed = odds @ share
            new = share * ((counts / mixed) @ odds) / total
            done = np.abs(new - share).max() < CLOSE
            share = new
            if done:
                break
        return share, float(counts @ np.log(odds @ share))

    def predict(self, counts: np.ndarray, buckets: np.ndarray) -> tuple[str, float, dict[str, float]]:
        """Language, its share, and the shares of the whole chosen set."""
        odds = self.odds[buckets]
        single = counts @ np.log(odds)
        best = int(single.argmax())
        chosen, likelihood = {best: 1.0}, float(single[best])
        if len(self.languages) > 1:
            full, _ = self.shares(counts, odds, np.ones(len(self.languages)))
            price = PENALTY * np.log(max(2, counts.sum()))
            order = [int(i) for i in np.argsort(-full, kind="stable") if full[i] >= LEAST_SHARE]
            for size in range(2, len(order) + 1):
                some = order[:size]
                share, now = self.shares(counts, odds[:, some], full[some])
                if now - likelihood <= price * (size - len(chosen)):
                    break
                chosen, likelihood = dict(zip(some, share.tolist(), strict=True)), now
        top = min(chosen, key=lambda i: (-chosen[i], i))
        return self.languages[top], min(1.0, chosen[top]), {self.languages[i]: s for i, s in chosen.items()}


def learn(labelled: DataFrame) -> Model:
    """A model of the languages of (text, lang); rows without a language teach nothing.

    Counts cover all rows. What comes to the driver is one number for each
    bucket of at most ``MAX_LANGUAGES`` languages.
    """
    bound_batches(labelled.sparkSession)
    rows = labelled.where("lang is not null").select("text", F.col("lang").cast("string").alias("lang"))
    counts = rows.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    top = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").limit(MAX_LANGUAGES)
    found = counts.join(F.broadcast(top.select("lang")), "lang").toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    places = {lang: i for i, lang in enumerate(languages)}
    table[found["bucket"].to_numpy(), found["lang"].map(places).to_numpy(int)] += found["n"].to_numpy()
    return Model(languages, table / table.sum(axis=0, keepdims=True))


def _predictor(shared, row: str | None = None):
    def text_column(batch: pa.RecordBatch) -> pa.Array:
        return batch.column("text") if row is None else batch.column(row).field("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            for first, texts in text_chunks(text_column(batch)):
                owner, bucket = trigrams(texts)
                bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
                langs, scores, mixtures = [], [], []
                for i in range(len(texts)):
                    mine = bucket[bounds[i] : bounds[i + 1]]
                    lang, score, mixture = UNKNOWN, 0.0, {}
                    if len(mine) and model.languages:
                        counts = np.bincount(mine, minlength=BUCKETS)
                        found = np.flatnonzero(counts)
                        lang, score, mixture = model.predict(counts[found].astype(float), found)
                    langs.append(lang)
                    scores.append(score)
                    mixtures.append(",".join(f"{k}:{v:.3f}" for k, v in sorted(mixture.items(), key=lambda x: (-x[1], x[0]))))
                part = batch.slice(first, len(texts)).drop_columns(["text"] if row is None else [])
                columns = [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(mixtures, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "lang_pred", "score", "mixture"])

    return run


def predict(rows: DataFrame, model: Model, row: str | None = None) -> DataFrame:
    """Rows with column text, unless it is a field of column ``row``, replaced by ``lang_pred``, ``score`` (its share of the text) and ``mixture``.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text if nothing was learned. Other columns are carried along unread.
    """
    schema = rows.drop("text", "lang_pred", "score", "mixture").schema.add("lang_pred", "string").add("score", "double").add("mixture", "string")
    shared = rows.sparkSession.sparkContext.broadcast(model)
    narrow = rows.drop("lang_pred", "score", "mixture")
    bound_batches(rows.sparkSession)
    return narrow.mapInArrow(_predictor(shared, row), schema)


def held_out() -> Column:
    return remainder("doc_id", MODULUS) == HELD_OUT


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, mixture) for every row, learned from the rows not held out.

    A null id counts as not held out. An empty table gives an empty result.
    """
    model = learn(docs.where(~held_out()).select("text", "lang"))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model)


#: Share of a document that its main language must have.
MAIN_SHARE = 0.5


def with_main_language(docs: DataFrame) -> DataFrame:
    """The documents that have letters and a main language; the others go. All columns are kept as they are."""
    model = learn(docs.where(~held_out()).select("text", "lang"))
    found = predict(docs.select(F.struct("*").alias("_row")), model, "_row").where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MAIN_SHARE))
    return found.select("_row.*")
