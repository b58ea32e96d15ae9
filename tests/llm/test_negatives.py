"""Hard negatives against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from attestal.llm import negatives
from attestal.llm.negatives import Best, CoverTree, search

SCHEMA = "vec_id long, label int, embedding array<double>"


def plain(rows, k=5, n=10):
    rows = [r for r in rows if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    whole = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows]

    def product(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    def order(r):
        return -r[0], math.inf if r[1] is None else r[1]

    found, done = [], []
    for row in whole:
        if row[0] is None or row[0] % 10 or row in done:
            continue
        done.append(row)
        anchor, label, vec = row
        scored = [(product(vec, v), i, other) for i, other, v in whole]
        near = sorted(((s, i) for s, i, other in scored if other == label and i != anchor), key=order)[:k]
        for score, positive in near:
            far = sorted(((s, i) for s, i, other in scored if other != label and 30 * score <= 100 * s <= 90 * score), key=order)[:n]
            found += [(anchor, positive, rank + 1, i, score, s) for rank, (s, i) in enumerate(far)]
    return found


def mine(df):
    found = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def told(rows):
    return sorted(map(repr, map(tuple, rows)))


def some_rows(seed, n=400, dims=6):
    """Clusters, many equal vectors, rows that take no part, short vectors, rows without a key."""
    rnd = random.Random(seed)
    hubs = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    rows = []
    for i in range(n):
        hub = rnd.choice(hubs)
        vec = list(hub) if rnd.random() < 0.3 else [x + rnd.gauss(0, 0.2) for x in hub]
        fate = rnd.random()
        if fate < 0.03:
            vec[rnd.randrange(dims)] = rnd.choice([None, math.nan, math.inf, -math.inf])
        elif fate < 0.05:
            vec = rnd.choice([None, [], vec[:2], [0.0] * dims])
        rows.append((None if rnd.random() < 0.01 else i, None if rnd.random() < 0.02 else rnd.randrange(4), vec))
    return rows


@pytest.mark.parametrize("block,tree", [(4096, 8192), (7, 60)])
def test_against_all_products(spark, monkeypatch, block, tree):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "TREE_ROWS", tree)
    rows = some_rows(1)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ID", F.lit(1)).withColumn("mark", F.lit("x")).repartition(3)
    want = plain(rows)
    assert len(want) > 500 and told(mine(df).collect()) == told(want)


def test_repeated_rows_and_empty_tables(spark):
    rows = some_rows(2, 60)
    twice = rows + rows[:25]
    df = spark.createDataFrame(twice, SCHEMA)
    assert told(mine(df).collect()) == told(plain(twice))
    assert mine(df.limit(0)).count() == 0
    assert mine(df.where("vec_id % 10 <> 0")).count() == 0
    assert mine(df.withColumn("embedding", F.lit(None).cast("array<double>"))).count() == 0


def test_large_components(spark):
    """Products that doubles do not hold exactly."""
    rnd = random.Random(4)
    rows = [(i, i % 3, [float(rnd.randrange(-(10**6), 10**6)) * 8 + 1 / 256 for _ in range(3)]) for i in range(80)]
    assert told(mine(spark.createDataFrame(rows, SCHEMA)).collect()) == told(plain(rows))


def first(points, ids, labels, query, label, low, high, k):
    scores = points @ query
    order = np.lexsort((ids, -scores))
    return [(-int(scores[i]), int(ids[i])) for i in order if labels[i] != label and low <= scores[i] <= high][:k]


@pytest.mark.parametrize("spread", [0.02, 0.5])
def test_tree(monkeypatch, spread):
    """Nodes cover their points, bounds hold, and on clustered points most leaves are skipped."""
    rng = np.random.default_rng(5)
    hubs = rng.normal(size=(40, 8))
    points = np.floor((hubs[rng.integers(0, 40, 4000)] + spread * rng.normal(size=(4000, 8))) * 256)
    points[:900] = points[0]
    ids, labels = rng.permutation(4000).astype(np.int64), rng.integers(0, 5, 4000)
    tree = CoverTree(points, ids, labels)
    leaves = [i for i, below in enumerate(tree.children) if not below]
    assert sorted(tree.ids.tolist()) == list(range(4000)) and len(leaves) > 30
    assert all(tree.spans[i][1] - tree.spans[i][0] <= negatives.LEAF or tree.radii[i] == 0 for i in leaves)
    queries = np.vstack([points[::97], np.zeros((1, 8))])
    low, high = tree.bounds(queries)
    products = tree.points @ queries.T
    for node, (start, stop) in enumerate(tree.spans):
        assert (products[start:stop] >= low[node]).all() and (products[start:stop] <= high[node]).all()
    for node, below in enumerate(tree.children):
        for child in below:
            gap = np.linalg.norm(tree.heart[child] - tree.heart[node])
            assert gap <= tree.radii[node] + 1e-6
    looked = []
    plain_scores = CoverTree.scores
    monkeypatch.setattr(CoverTree, "scores", lambda self, a, b, q: (looked.append(b - a), plain_scores(self, a, b, q))[1])
    for i, query in enumerate(queries):
        top = float(products[:, i].max())
        wanted = [Best(math.ceil(0.3 * top), math.floor(share * top), 10) for share in (0.5, 0.9)] + [Best(-np.inf, np.inf, 10)]
        search(tree, query, low[:, i], high[:, i], wanted, 2, False, -1)
        for best in wanted:
            assert best.rows == first(points, ids, labels, query, 2, best.low, best.high, 10)
    assert sum(looked) < (0.5 if spread < 0.1 else 1.0) * len(points) * len(queries)
