"""Quality rules and robust multivariate outliers, in built-in functions only.

Every text becomes a few counts and from them a vector of transformed
statistics in fixed point. For each language and source, the mean and
covariance of the three quarters of the vectors that lie closest (the minimum
covariance determinant) are found by concentration steps: distances under the
current estimate, then the estimate of the closest ones. Texts whose
Mahalanobis distance is far beyond are rejected.

The sums are of whole numbers, so that a rerun finds the same estimates. Each
step is one aggregation combined map-side, of a size given by the number of
groups; quantiles are of whole numbers of a small range, kept as counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestal.llm.common import SPACES, carried, kept_columns, restored, stored, text_of, words_of

#: Fewest words; most words in repeated windows, in percent.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Rows that a group needs for an estimate of its own; smaller ones share that of their language, or of all.
GROUP_ROWS = 200
#: Share of the rows that an estimate covers; concentration steps; units of a statistic.
COVERED, STEPS, UNIT = 0.75, 3, 256
#: Least spread of a statistic, taken only where the measured one is smaller: the chance spread of the mean length of a
#: hundred words, a symbol in some 280 characters, a line in 25, a word in 100, and a factor of 1.6 in size.
FLOORS = {"length": 0.05, "symbols": 0.06, "lines": 0.20, "repeats": 0.10, "words": 0.50}
#: Median and 0.999 quantile of a squared distance with five degrees of freedom.
MEDIAN, CUTOFF = 4.3515, 20.515

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = (*COUNTS, "base_failed", "kept", "distance")
_NAMES = tuple(FLOORS)


def repeated_words(words: Column) -> list[tuple[str, Column]]:
    """Steps (column, expression) up to ``_repeated``: words inside three-word windows that occur twice or more.

    Windows are told apart by 64-bit hashes. Where all differ, nothing more is
    done; else sorting brings equal ones together, so that the cost is that of
    a sort whatever repeats.
    """
    window = lambda i: F.xxhash64(F.get("_hashes", i), F.get("_hashes", i + 1), F.get("_hashes", i + 2))
    windows = F.when(F.size("_hashes") >= 3, F.transform(F.sequence(F.lit(0), F.size("_hashes") - 3), window))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    h = lambda i: F.get("_sorted", i)["h"]
    again = lambda x, i: (i > 0) & (h(i - 1) == x["h"]) | F.coalesce(h(i + 1) == x["h"], F.lit(False))
    total = F.aggregate(
        "_places",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(i - s["last"], F.lit(3))).alias("n")),
    )["n"]
    return [
        ("_hashes", F.transform(words, lambda w: F.xxhash64(w))),
        ("_windows", F.coalesce(windows, F.array().cast("array<bigint>"))),
        ("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(placed)).otherwise(none)),
        ("_places", F.sort_array(F.transform(F.filter("_sorted", again), lambda x: x["i"]))),
        ("_repeated", total),
    ]


def others(docs: DataFrame, text: str) -> list[str]:
    """Columns of the input that the result keeps."""
    return kept_columns(docs, (text, *RESULT))


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``_row`` (the columns ``others`` keeps), ``_language``, ``_source``, the counts of ``COUNTS``, ``_lines`` and ``base_failed``."""
    rows = docs.select(
        carried(others(docs, text)).alias("_row"), F.col("lang").alias("_language"), F.col("source").alias("_source"), text_of(text).alias("_text")
    )
    rows = rows.withColumns({
        "_words": words_of(F.col("_text")),
        "_lines": F.filter(F.split("_text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
        "_symbols": F.regexp_count("_text", F.lit("[#*$%&|<>]")),
    })
    for name, step in repeated_words(F.col("_words")):
        rows = rows.withColumn(name, step)
    rows = rows.select(
        "_row",
        "_language",
        "_source",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.col("_symbols").cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.col("_repeated").alias("n_repeat_words"),
        F.size("_lines").alias("_lines"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    return rows.withColumn("base_failed", failed)


def _statistics() -> dict[str, Column]:
    """Whole numbers of 1/UNIT: logarithms of sizes, angles of shares (their spread hardly depends on the share)."""

    def angle(part: Column, whole: Column) -> Column:
        return F.asin(F.sqrt(F.least(part / F.greatest(whole, F.lit(1)), F.lit(1.0))))

    words = F.greatest(F.col("n_words"), F.lit(1))
    values = {
        "length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "symbols": angle(F.col("n_symbols"), F.col("word_chars")),
        "lines": angle(F.col("n_dup_lines"), F.col("_lines")),
        "repeats": angle(F.col("n_repeat_words"), F.col("n_words")),
        "words": F.log(words),
    }
    return {f"_{k}": F.round(v * UNIT).cast("long") for k, v in values.items()}


def _with_groups(rows: DataFrame) -> DataFrame:
    """Adds ``_group``: language and source, only the language, or nothing, by how many rows there are to learn from."""
    pair, lang = F.to_json(F.struct(F.col("_language").alias("lang"), F.col("_source").alias("source"))), F.to_json(F.struct(F.col("_language").alias("lang")))
    rows = rows.withColumn("_pair", pair).withColumn("_lang", lang)
    pairs = rows.where("not base_failed").groupBy("_pair", "_lang").agg(F.count("*").alias("_n"))
    pairs = stored(pairs, "quality-groups")
    langs = pairs.groupBy("_lang").agg(F.sum("_n").alias("_n_lang"))
    sizes = pairs.join(langs, "_lang").select("_pair", F.when(F.col("_n") >= GROUP_ROWS, F.col("_pair")).when(F.col("_n_lang") >= GROUP_ROWS, F.col("_lang")).otherwise("").alias("_group"))
    return rows.join(sizes, "_pair", "left").withColumn("_group", F.coalesce("_group", F.lit(""))).drop("_pair", "_lang")


def _estimate(rows: DataFrame) -> DataFrame:
    """(_group, mean, root): mean and lower triangular root of the covariance of each group's rows."""
    sums = [F.sum(f"_{a}").alias(f"s{i}") for i, a in enumerate(_NAMES)]
    sums += [F.sum(F.col(f"_{a}") * F.col(f"_{b}")).alias(f"p{i}{j}") for i, a in enumerate(_NAMES) for j, b in enumerate(_NAMES[: i + 1])]
    table = rows.groupBy("_group").agg(F.count("*").alias("n"), *sums)
    for i, name in enumerate(_NAMES):
        for j in range(i + 1):
            cov = (F.col(f"p{i}{j}") - F.col(f"s{i}") * F.col(f"s{j}").cast("double") / F.col("n")) / F.col("n")
            for k in range(j):
                cov -= F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # a floor replaces what varies less given the statistics before it, and adds nothing to larger spreads
            root = F.sqrt(F.greatest(cov, F.lit((FLOORS[name] * UNIT) ** 2))) if i == j else cov / F.col(f"l{j}{j}")
            table = table.withColumn(f"l{i}{j}", root)
    mean = F.array(*[F.col(f"s{i}") / F.col("n") for i in range(len(_NAMES))])
    root = F.array(*[F.col(f"l{i}{j}") for i in range(len(_NAMES)) for j in range(i + 1)])
    return table.select("_group", mean.alias("mean"), root.alias("root"))


def _first_estimate(rows: DataFrame) -> DataFrame:
    """Medians, and spreads from the quartiles, of each statistic by itself."""
    quartiles = [F.percentile(f"_{a}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i, a in enumerate(_NAMES)]
    table = rows.groupBy("_group").agg(*quartiles)
    spread = lambda i: F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOORS[_NAMES[i]] * UNIT))
    mean = F.array(*[F.col(f"q{i}")[1] for i in range(len(_NAMES))])
    root = F.array(*[spread(i) if i == j else F.lit(0.0) for i in range(len(_NAMES)) for j in range(i + 1)])
    return table.select("_group", mean.alias("mean"), root.alias("root"))


def _distances(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds ``_d``, the squared distance, and ``_step``, its logarithm in steps."""
    rows = rows.join(estimates, "_group", "left")
    at, total = 0, F.lit(0.0)
    for i, name in enumerate(_NAMES):
        value = F.col(f"_{name}") - F.col("mean")[i]
        for j in range(i):
            value -= F.col("root")[at + j] * F.col(f"_y{j}")
        rows = rows.withColumn(f"_y{i}", value / F.col("root")[at + i])
        total += F.col(f"_y{i}") * F.col(f"_y{i}")
        at += i + 1
    rows = rows.withColumn("_d", total).drop("mean", "root", *[f"_y{i}" for i in range(len(_NAMES))])
    return rows.withColumn("_step", F.floor(F.log1p("_d") * 64))


def quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows without the text, with ``COUNTS``, ``base_failed``, ``kept`` and ``distance``.

    ``kept`` is false for a row that fails the base rules, else whether its
    squared distance, scaled so that its group's median is that of a normal
    sample, is within ``CUTOFF``. ``distance`` is null where no estimate
    exists; such rows are kept. Input columns of these names, in any case of letters, are replaced; a
    null text has no words; null languages and sources are values of their
    own. Repeated rows are judged alike. An empty table gives an empty result.
    """
    rows = counted(docs, text).withColumns(_statistics())
    rows = stored(_with_groups(stored(rows, "quality-counts")), "quality-statistics")
    sound = rows.where("not base_failed")
    estimates = stored(_first_estimate(sound), "quality-estimates")
    for _ in range(STEPS):
        far = _distances(sound, estimates)
        # written, so that Spark knows its size and does not shuffle the rows of a large group for it
        limit = stored(far.groupBy("_group").agg(F.percentile("_step", F.lit(COVERED)).alias("_limit")), "quality-limits")
        estimates = stored(_estimate(far.join(limit, "_group").where("_step <= _limit")), "quality-estimates")
    middle = _distances(sound, estimates).groupBy("_group").agg(F.percentile("_step", F.lit(0.5)).alias("_middle"))
    # the covered part varies less than all do; and statistics under their floor make distances small, which is no reason to scale them up
    scale = F.greatest(F.expm1(F.col("_middle") / 64) / MEDIAN, F.lit(1.0))
    judged = _distances(rows, estimates).join(stored(middle.select("_group", scale.alias("_scale")), "quality-scales"), "_group", "left")
    judged = judged.withColumn("distance", F.col("_d") / F.col("_scale"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))
    return judged.select(*restored(others(docs, text)), *COUNTS, "base_failed", kept.alias("kept"), "distance")
