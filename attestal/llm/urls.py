"""URL filter: rules for hosts and paths, and a character language-model ratio for the rest.

URLs that a rule decides are the examples: one variable-order Markov model of
the accepted, one of the rejected ones. A character's probability after its
longest context is smoothed by that after the next shorter one, down to an
even spread. The difference of both log-likelihoods by length, against a limit
set on examples kept out of the models, decides URLs without a rule.

Counts are of hashed character sequences in a table of ``SLOTS`` slots, so a
model is ``2 * SLOTS`` numbers whatever the corpus; it reaches every task as
one value. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal.llm.common import carried, kept_columns, restored, stored

#: (verdict, host, path prefix), for the host and its subdomains; the longest that fits decides.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Longest sequence; weight of the shorter context; slots of the count table.
ORDER, WEIGHT, SLOTS = 5, 4.0, 1 << 17
#: One of so many examples sets the limit, the others make the models.
FOLDS = 4

RESULT = ("host", "path", "rule", "verdict", "score")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.char_length(url)))
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), upper, lower), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(size, rule, verdict) of the longest rule that fits, else null."""
    hits = []
    for verdict, name, prefix in rules:
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        one = F.struct(F.lit(len(name + prefix)).alias("size"), F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        hits.append(F.when(fits, one))
    return F.array_max(F.array(*hits))


def _slots(length: int) -> Column:
    """Slot of the sequence of ``length`` characters that ends at each place of ``_codes``."""
    code = lambda i: F.get("_codes", i)
    places = F.sequence(F.lit(0), F.size("_codes") - 1)
    one = lambda i: F.pmod(F.xxhash64(F.lit(length), *[F.coalesce(code(i - k), F.lit(1)) for k in range(length)]), F.lit(SLOTS)).cast("int")
    return F.transform(places, one)


def with_slots(rows: DataFrame, url: str) -> DataFrame:
    """Adds ``_codes``, the URL's code points and an end mark, and ``_s1`` to ``_s5``."""
    chars = F.split(F.coalesce(F.col(url), F.lit("")), "")
    codes = F.filter(F.transform(chars, lambda c: F.ascii(c)), lambda c: c != 0)
    rows = rows.withColumn("_codes", F.concat(codes, F.array(F.lit(2))))
    return rows.withColumns({f"_s{n}": _slots(n) for n in range(1, ORDER + 1)})


def counts(examples: DataFrame) -> DataFrame:
    """One row (accepted, rejected): counts by slot, the total behind them, from rows with slots and ``verdict``."""
    every = F.concat(*[F.col(f"_s{n}") for n in range(1, ORDER + 1)], F.transform("_s1", lambda _: F.lit(SLOTS)))
    flat = examples.select("verdict", F.explode(every).alias("slot"))
    flat = flat.groupBy("slot").agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("r")
    )
    whole = examples.sparkSession.range(SLOTS + 1).withColumnRenamed("id", "slot").join(flat, "slot", "left")
    entry = F.struct(F.col("slot"), F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("r", F.lit(0)).alias("r"))
    table = whole.agg(F.sort_array(F.collect_list(entry)).alias("t"))
    return table.select(
        F.transform("t", lambda x: x["a"].cast("double")).alias("accepted"),
        F.transform("t", lambda x: x["r"].cast("double")).alias("rejected"),
    )


def scores(rows: DataFrame, key: str, accepted: Column, rejected: Column) -> DataFrame:
    """(key, score): difference of the log-likelihoods under both tables by length, for each distinct URL in ``key``.

    The characters of a URL are rows of one task and summed up there before
    anything is shuffled.
    """
    # dealt to as many tasks as a shuffle has: few bytes, but much work for each
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = with_slots(rows.select(key).distinct().repartition(tasks, key), key)
    last = range(1, ORDER + 1)
    # the arrays end where they are exploded: no row of a place carries those of its whole URL
    here = [F.col(f"_s{n}").alias(f"s{n}") for n in last]
    before = [F.concat(F.array(F.lit(None).cast("int")), F.slice(f"_s{n}", F.lit(1), F.size("_codes") - 1)).alias(f"b{n}") for n in last[:-1]]
    places = distinct.select(key, *here, *before).select(key, F.inline(F.arrays_zip(*[f"s{n}" for n in last], *[f"b{n}" for n in last[:-1]])))

    def probability(table: Column) -> Column:
        p, context = F.lit(1 / 256), F.get(table, F.lit(SLOTS))
        for n in last:
            # two sequences may share a slot: no more than the context's count
            p = (F.least(F.get(table, F.col(f"s{n}")), context) + WEIGHT * p) / (context + WEIGHT)
            if n < ORDER:
                context = F.coalesce(F.get(table, F.col(f"b{n}")), F.lit(0.0))
        return p

    difference = F.log(probability(accepted)) - F.log(probability(rejected))
    return places.select(key, difference.alias("_d")).groupBy(key).agg(F.avg("_d").alias("score"))


def filter_urls(pages: DataFrame, rules=RULES, url: str = "url") -> DataFrame:
    """All rows with ``host``, ``path``, ``rule`` (null without one), ``verdict`` and ``score`` (of URLs without a rule).

    A null URL, or one without ``://``, has an empty host and path and is
    judged by the models. Where no example of one side exists, URLs without a
    rule are allowed, with a null score. Input columns of these names, in any
    case of letters, are replaced. Repeated rows count as often as they occur. An empty table gives
    an empty result.
    """
    host, path = host_and_path(F.col(url))
    names = kept_columns(pages, RESULT)
    rows = pages.select(carried(names).alias("_row"), F.col(url).alias("_url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules)).withColumn("_key", F.coalesce(F.col("_url"), F.lit("")))
    examples = rows.where("_rule is not null").select("_key", F.col("_rule.verdict").alias("verdict"))
    examples = examples.withColumn("_fold", F.pmod(F.xxhash64("_key"), F.lit(FOLDS)))
    table = stored(counts(with_slots(examples.where("_fold <> 0"), "_key")), "url-models")
    model = table.select("accepted").scalar(), table.select("rejected").scalar()
    wanted = rows.select("_key", "_rule").where(F.col("_rule").isNull() | (F.pmod(F.xxhash64("_key"), F.lit(FOLDS)) == 0))
    scored = stored(scores(wanted, "_key", *model), "url-scores")
    kept_out = examples.where("_fold = 0").join(scored, "_key")
    sides = kept_out.groupBy().agg(
        *[f(F.when(F.col("verdict") == v, F.col("score"))).alias(n + v) for v in ("allow", "block") for n, f in (("m_", F.avg), ("s_", F.stddev_pop))]
    )
    # the point that lies as many standard deviations from one side's mean as from the other's
    spread = F.col("s_allow") + F.col("s_block")
    limit = F.when(spread > 0, (F.col("m_allow") * F.col("s_block") + F.col("m_block") * F.col("s_allow")) / spread).otherwise(
        (F.col("m_allow") + F.col("m_block")) / 2
    )
    limit = stored(sides.select(limit.alias("limit")), "url-limit").scalar()
    judged = rows.join(scored, "_key", "left").withColumn("_limit", limit)
    judged = judged.withColumn("score", F.when(F.col("_rule").isNull() & F.col("_limit").isNotNull(), F.col("score")))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("score") < F.col("_limit"), "block").otherwise("allow"))
    return judged.select(*restored(names), "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"), "score")
