"""Mixing sources to target weights by Sainte-Lague apportionment, in built-in functions only.

Blocks of ``BLOCK_WORDS`` words are given to the sources one by one: the next
block goes to the highest quotient target / (2 * blocks + 1), until the mix is
spent. The quotient of the last block is searched for, so no row is made for
each block. A source is dealt by a seeded digest into shards of about
``SHARD_DOCS`` of its documents, a rare source into one; its blocks go on to
its shards as differences of rounded running sums, so that no rounding adds
up. The documents of a shard stand in seeded order on a line, twice over, and
the first blocks of the line up to its quota are taken; so whole documents are
taken, but for the one at the cut, none more than twice.

Every window over documents runs within a shard, running sums over shards in
runs of ``SHARD_RUN``; only the table of sources is ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestal.llm.common import carried, count_words, kept_columns, restored, stored, text_of

#: Words of a block; documents of a shard, about; share of all words that the mix has; copies of a document at most.
BLOCK_WORDS, SHARD_DOCS, MIX_PERCENT, COPIES = 64, 1024, 150, 2
#: Shards of a source that one running sum goes over; a second one goes over these runs.
SHARD_RUN = 4096
#: Quotients tried at once in the search for the last block's.
TRIED = 64
#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
SEED = "mix-1"

RESULT = ("size", "source_size", "target", "taken")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(_src, source_size, rank, target) of (_src, source_size): words by weight, each at most ``COPIES`` times the source.

    Sources are filled in order of size by weight. As long as the share of the
    words left exceeds what a source can give, the source is full; from the
    first one that is not, all get the same words by weight.
    """
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy("_src")))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", weight.cast("long"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("source_size") / F.col("_w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * MIX_PERCENT - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * (100 * COPIES)
    weight_left = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    level = ranked.withColumn("_left", left.cast("double")).withColumn("_weight_left", (weight_left * 100).cast("double"))
    share = F.col("_w") * F.col("_left") / F.col("_weight_left")
    level = level.withColumn("_full", share >= F.col("source_size") * COPIES)
    open_ = F.when(~F.col("_full"), F.struct((F.col("source_size") / F.col("_w")).alias("a"), "rank", "_left", "_weight_left"))
    level = level.withColumn("_open", F.min(open_).over(everything))
    target = F.when(F.col("_full"), (F.col("source_size") * COPIES).cast("double")).otherwise(
        F.col("_w") * F.col("_open._left") / F.col("_open._weight_left")
    )
    return level.select("_src", "source_size", "rank", target.alias("target"))


def apportion(sources: DataFrame) -> DataFrame:
    """The rows of (_src, source_size, rank, target) with ``_blocks``: blocks of the mix that each source gets by highest quotients.

    A source's blocks at a quotient are known without counting them one by
    one. The quotient of the last block is closed in on by one-row aggregates
    until no more than about a block a source is left in between; only these
    are ranked, ties by the source's rank.
    """
    room = F.expr(f"(source_size * {COPIES} + {BLOCK_WORDS - 1}) div {BLOCK_WORDS}")
    sources = sources.withColumn("_room", room).where("target > 0")

    def won(quotient: float) -> Column:
        return F.least(F.floor((F.col("target") / F.lit(quotient) + 1) / 2).cast("long"), F.col("_room"))

    total, count, high, low = sources.agg(
        F.expr(f"(sum(cast(floor(target) as bigint)) + {BLOCK_WORDS // 2}) div {BLOCK_WORDS}"),
        F.count("*"),
        F.max("target") * 2,
        F.min(F.col("target") / (F.col("_room") * 4 + 2)),
    ).first()
    between = None
    while count and (between is None or between > count) and high / low > 1 + 1e-14:
        step = (high / low) ** (1 / TRIED)
        tried = [low] + [low * step**i for i in range(1, TRIED)] + [high]
        blocks = list(sources.agg(*[F.sum(won(q)).alias(f"n{i}") for i, q in enumerate(tried)]).first())
        place = max(i for i, n in enumerate(blocks) if n >= total or i == 0)
        if place == TRIED or (low, high) == (tried[place], tried[place + 1]):
            break
        low, high, between = tried[place], tried[place + 1], blocks[place] - blocks[place + 1]
    # one block more on both sides, for the rounding of the quotients
    sure = F.greatest(won(high or 1.0) - 1, F.lit(0).cast("long"))
    seats = sources.withColumn("_sure", sure).withColumn("_last", F.least(won(low or 1.0) + 1, F.col("_room")))
    best = Window.orderBy((F.col("target") / (F.col("_k") * 2 + 1)).desc(), "rank", "_k")
    left = F.lit(total or 0).cast("long") - F.coalesce(F.sum("_sure").over(Window.partitionBy()), F.lit(0))
    open_ = seats.withColumn("_left", left).where("_last > _sure").withColumn("_k", F.explode(F.expr("sequence(_sure, _last - 1)")))
    taken = open_.withColumn("_place", F.row_number().over(best)).where("_place <= _left").groupBy("_src").agg(F.count("*").alias("_more"))
    return seats.join(taken, "_src", "left").select("_src", (F.col("_sure") + F.coalesce("_more", F.lit(0))).alias("_blocks"))


def quotas(cells: DataFrame) -> DataFrame:
    """(_src, _shard, _quota) of (_src, _shard, _words, source_size, _blocks): blocks that each shard gives."""
    run = F.expr(f"_shard div {SHARD_RUN}")
    runs = cells.groupBy("_src", run.alias("_run")).agg(F.sum("_words").alias("_run_words"))
    earlier = Window.partitionBy("_src").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_run_words").over(earlier), F.lit(0)))
    within = Window.partitionBy("_src", "_run").orderBy("_shard").rowsBetween(Window.unboundedPreceding, 0)
    ends = cells.withColumn("_run", run).join(runs, ["_src", "_run"]).withColumn("_end", F.col("_before") + F.sum("_words").over(within))

    def given(end: str) -> Column:
        product = f"2 * cast(_blocks as decimal(18, 0)) * cast({end} as decimal(19, 0)) + source_size"
        return F.expr(f"case when source_size > 0 then ({product}) div (2 * source_size) else 0L end")

    return ends.select("_src", "_shard", (given("_end") - given("_end - _words")).alias("_quota"))


def mix(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """All rows with ``size``, ``source_size``, ``target`` of their source and ``taken``: words the mix takes, repeats counted.

    Input columns of these names, in any case of letters, are replaced. A null or wordless text has
    size 0 and nothing is taken; a null source is a source of its own, the
    last one. Rows with equal ids and texts stand next to each other and are
    taken one by one. The same rows and seed give the same result. An empty
    table gives an empty result.
    """
    shards = docs.count() // SHARD_DOCS + 1
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    source = F.when(F.col("source").isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    names = kept_columns(docs, RESULT)
    rows = docs.select(
        carried(names).alias("_row"),
        F.col("doc_id").alias("_id"),
        count_words(text_of()).alias("size"),
        source.alias("_src"),
        (F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") % shards).alias("_deal"),
        F.substring(digest, 8, 25).alias("_place"),
    )
    deals = stored(rows.groupBy("_src", "_deal").agg(F.sum("size").alias("_words"), F.count("*").alias("_n")), "mix-deals")
    sources = deals.groupBy("_src").agg(F.sum("_words").alias("source_size"), F.expr(f"sum(_n) div {SHARD_DOCS} + 1").alias("_shards"))
    sources = stored(sources, "mix-sources")
    given = stored(targets(sources.select("_src", "source_size"), weights), "mix-targets")
    sources = sources.join(given.select("_src", "target"), "_src").join(apportion(given), "_src", "left")
    sources = stored(sources.withColumn("_blocks", F.coalesce("_blocks", F.lit(0).cast("long"))), "mix-blocks")

    def sharded(dealt: DataFrame) -> DataFrame:
        return dealt.join(sources, "_src").withColumn("_shard", F.expr(f"(_deal * _shards) div {shards}"))

    cells = sharded(deals).groupBy("_src", "_shard").agg(
        F.sum("_words").alias("_words"), F.first("source_size").alias("source_size"), F.first("_blocks").alias("_blocks")
    )
    rows = sharded(rows).join(stored(quotas(cells), "mix-quotas"), ["_src", "_shard"])
    line = Window.partitionBy("_src", "_shard").orderBy("_place", "_id")
    cell = Window.partitionBy("_src", "_shard")
    rows = rows.withColumn("_start", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rows = rows.withColumn("_cell", F.sum("size").over(cell))

    def covered(start: Column) -> Column:
        return F.least(F.greatest(F.col("_quota") * BLOCK_WORDS - start, F.lit(0).cast("long")), F.col("size"))

    taken = covered(F.col("_start")) + covered(F.col("_start") + F.col("_cell"))
    return rows.select(*restored(names), "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, seed: str = SEED, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mix itself: each document as often as its taken words fill it, rounded; the columns are those of the input.

    A document without words is never taken.
    """
    times = F.when(F.col("size") > 0, F.expr("cast(floor(2 * taken / size + 1) / 2 as int)")).otherwise(F.lit(0))
    copies = mix(docs.select(F.struct("*").alias("document"), "doc_id", "source", "text"), seed, weights)
    copies = copies.withColumn("copy", F.explode(F.array_repeat(F.lit(1), times)))
    return copies.select("document.*")
