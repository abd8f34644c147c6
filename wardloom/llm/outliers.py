"""Quality rules by robust multivariate outliers: minimum covariance determinant (MCD) per language and source.

Every text gets a vector of five transformed statistics, chosen so that clean texts of any length spread alike:

* ``ln(1 + ln(n_words))``
* ``sqrt(n_words) * (mean word length - the group's median of it)``
* ``asin(sqrt(symbols per word))``, at most one symbol per word counted
* ``sqrt(n_dup_lines)``
* ``asin(sqrt(share of repeated words))``

For each group the MCD estimate is the mean and covariance of the ``support`` share of texts whose covariance has the smallest
determinant. It is found by concentration steps from several starts: distances to the present estimate, keep the nearest texts,
estimate again. The best start is reweighted once. A text is rejected if its squared Mahalanobis distance exceeds ``cutoff``.

Everything is aggregation per group with map-side combination, so a group that holds a third of all rows is no hot spot. Order
statistics are read from counted grids, not from sorted rows, and so do not depend on how rows are dealt to tasks.
Groups with fewer than ``least_rows`` texts borrow the estimate of their language, which is made from all texts of the language, those of its
large groups as well; it is made only where a language has such a group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardloom.llm.common import SPACE, filled, words_of, written

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "[#*$%&|<>]"
P = 5
AXES = tuple(f"x{i}" for i in range(P))
PAIRS = tuple((i, j) for i in range(P) for j in range(i, P))
MEANS = tuple(f"m{i}" for i in range(P))
COVS = tuple(f"c{i}{j}" for i, j in PAIRS)


@dataclass(frozen=True)
class Rules:
    """Parameters. ``least_spread`` is a standard deviation for each axis that no estimate goes below."""

    min_words: int = 50
    max_repeat_percent: int = 50
    support: float = 0.75
    steps: int = 3
    starts: int = 3
    least_rows: int = 50
    cutoff: float = 45.0
    reweight: float = 12.83  # 97.5 % point of chi squared with five degrees of freedom
    least_spread: tuple[float, ...] = (0.15, 2.5, 0.08, 0.6, 0.12)
    grid: float = 1 / 64


def text_statistics(docs: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``row`` (struct of the carried columns) and the counts of the base rules. A null or empty text has zeros everywhere.

    Repeated words are those inside a window of three words that occurs at least twice in the text. Windows are compared by
    64-bit hashes; only texts with a repeated window are looked at a second time.
    """
    first = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), filled(F.col(f"`{text}`")).alias("t"))
    first = first.withColumn("w", words_of(F.col("t")))
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    first = first.select(
        "row",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.char_length("t") - F.char_length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    three = F.transform(
        F.slice("h", 1, F.greatest(F.size("h") - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get("h", i + 1), F.get("h", i + 2))
    )
    second = first.select(
        "row", *STATS[:3], (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), three.alias("g")
    )
    second = second.withColumn("s", F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array("g")))
    second = second.withColumn("twice", F.array_distinct(F.filter("s", lambda x, i: (i > 0) & (F.get("s", i - 1) == x))))
    at = F.when(
        F.col("twice").isNotNull(),
        F.filter(F.sequence(F.lit(0), F.size("g") - 1), lambda i: F.array_contains(F.col("twice"), F.get("g", i))),
    )
    second = second.withColumn("at", at)
    # a window at i covers i, i+1, i+2: of neighbouring windows only the part that is new
    covered = F.aggregate(
        "at",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    return second.select("row", *STATS[:4], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _quantiles(rows: DataFrame, by: list[str], values: Sequence[str], share: float, step: float) -> DataFrame:
    """Per group the given quantile of each value, to the precision of a grid: counts per cell, then running counts over cells."""
    cells = F.explode(F.map_from_arrays(F.array(*[F.lit(v) for v in values]), F.array(*[F.floor(F.col(v) / step) for v in values])))
    counted = rows.select(*by, cells.alias("name", "cell")).groupBy(*by, "name", "cell").agg(F.count(F.lit(1)).alias("n"))
    up = Window.partitionBy(*by, "name").orderBy("cell")
    reached = counted.withColumn("below", F.sum("n").over(up)).withColumn("all", F.sum("n").over(Window.partitionBy(*by, "name")))
    at = F.min(F.when(F.col("below") >= share * F.col("all"), F.col("cell")))
    by_name = [F.max(F.when(F.col("name") == v, (F.col("at") + 0.5) * step)).alias(v) for v in values]
    return reached.groupBy(*by, "name").agg(at.alias("at")).groupBy(*by).agg(*by_name)


def _estimate(rows: DataFrame, by: list[str]) -> DataFrame:
    """Mean and covariance per group, from sums."""
    sums = [F.sum(a).alias(f"s{a}") for a in AXES] + [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in PAIRS]
    total = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums)
    mean = [(F.col(f"sx{i}") / F.col("n")).alias(MEANS[i]) for i in range(P)]
    cov = [(F.col(f"p{i}{j}") / F.col("n") - F.col(f"sx{i}") * F.col(f"sx{j}") / F.col("n") / F.col("n")).alias(f"c{i}{j}") for i, j in PAIRS]
    return total.select(*by, "n", *mean, *cov)


def _factored(estimate: DataFrame, least_spread: Sequence[float], scale: float) -> DataFrame:
    """The Cholesky factor of each scaled covariance plus the least spread, column by column, and the log determinant."""
    out = estimate
    for j in range(P):
        for i in range(j, P):
            value = F.col(f"c{j}{i}") * scale
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + least_spread[j] ** 2
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # the diagonal cannot fall below the spread that was added, but for rounding
            value = F.sqrt(F.greatest(value, F.lit((least_spread[j] / 4) ** 2))) if i == j else value / F.col(f"l{j}{j}")
            out = out.withColumn(f"l{i}{j}", value)
    log_det = 2 * sum((F.log(f"l{j}{j}") for j in range(P)), F.lit(0.0))
    return out.withColumn("log_det", log_det).drop(*COVS)


def _distance() -> Column:
    """Squared Mahalanobis distance: forward substitution with the factor's columns."""
    solved: list[Column] = []
    for i in range(P):
        value = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * solved[k]
        solved.append(value / F.col(f"l{i}{i}"))
    return sum((z * z for z in solved[1:]), solved[0] * solved[0])


def _concentrate(rows: DataFrame, estimate: DataFrame, by: list[str], rules: Rules) -> DataFrame:
    """One step: the estimate of the ``support`` share of rows nearest to the present estimate."""
    near = rows.join(estimate, by).withColumn("octave", F.log2(F.greatest(_distance(), F.lit(1e-9))))
    cut = _quantiles(near, by, ["octave"], rules.support, 1 / 16).withColumnRenamed("octave", "cut")
    inside = near.select(*by, *AXES, "octave").join(written(cut, "mcd-cut"), by).where(F.col("octave") <= F.col("cut") + 1 / 32)
    return written(_factored(_estimate(inside, by), rules.least_spread, 1.0), "mcd")


def mcd_estimates(vectors: DataFrame, rules: Rules) -> DataFrame:
    """Per ``grp`` of ``vectors`` (grp, pick, axes): means and Cholesky factor of the reweighted MCD estimate.

    Start 0 takes the medians with the spreads from median absolute deviations; the others take a pseudo-random half of the rows.
    """
    by = ["grp", "start"]
    medians = written(_quantiles(vectors, ["grp"], AXES, 0.5, rules.grid), "mcd-median")
    renamed = medians.select("grp", *[F.col(a).alias(MEANS[i]) for i, a in enumerate(AXES)])
    away = vectors.join(renamed, "grp").select("grp", *[F.abs(F.col(a) - F.col(MEANS[i])).alias(a) for i, a in enumerate(AXES)])
    mad = written(_quantiles(away, ["grp"], AXES, 0.5, rules.grid), "mcd-mad")
    first = renamed.join(mad, "grp").select(
        "grp", F.lit(0).alias("start"), F.lit(0).cast("long").alias("n"), *MEANS,
        *[((F.col(f"x{i}") * 1.4826) ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS],
    )
    each = F.explode(F.sequence(F.lit(0), F.lit(rules.starts - 1)))
    rows = vectors.select("grp", "pick", *AXES, each.alias("start"))
    if rules.starts > 1:
        half = rows.where((F.col("start") > 0) & (F.pmod(F.xxhash64("pick", "start"), F.lit(2)) == 0))
        first = first.unionByName(_estimate(half, by))
    estimate = written(_factored(first, rules.least_spread, 1.0), "mcd")
    for _ in range(rules.steps):
        estimate = _concentrate(rows, estimate, by, rules)
    order = Window.partitionBy("grp").orderBy("log_det", "start")
    best = written(estimate.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place", "start", "n"), "mcd-best")
    # the nearest share of a normal cloud is too narrow by this factor: share / P(chi2 with p+2 degrees <= its quantile)
    widen = rules.support / _chi2_7(_chi2_5_point(rules.support))
    near = vectors.join(best, "grp").where(_distance() <= rules.reweight * widen).select("grp", *AXES)
    final = _factored(_estimate(near, ["grp"]), rules.least_spread, 0.975 / _chi2_7(_chi2_5_point(0.975)))
    return written(final, "mcd-final")


def _chi2(x: float, odd: int) -> float:
    """Distribution function of chi squared with an odd number of degrees of freedom."""
    value, term = math.erf(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for k in range(1, odd, 2):
        value, term = value - term, term * x / (k + 2)
    return value


def _chi2_7(x: float) -> float:
    return _chi2(x, 7)


def _chi2_5_point(share: float) -> float:
    low, high = 0.0, 200.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2(middle, 5) < share else (low, middle)
    return low


def judge(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text", lang: str = "lang", source: str = "source",
          rules: Rules = Rules()) -> DataFrame:
    """``row`` (the carried columns), the statistics, ``base_failed``, ``distance`` (null if base_failed) and ``kept``.

    Null texts count as empty and fail the base rules; null languages and sources are groups of their own; equal rows are judged
    alike; an empty table gives an empty result. Columns of ``docs`` may have any names, they are carried inside ``row``.
    """
    named = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried"), F.col(f"`{text}`").alias("text"),
        F.to_json(F.struct(F.col(f"`{lang}`").cast("string").alias("l")), {"ignoreNullFields": "false"}).alias("lang"),
        F.to_json(F.struct(F.col(f"`{source}`").cast("string").alias("s")), {"ignoreNullFields": "false"}).alias("source"),
    )
    stats = text_statistics(named, "text", ["carried", "lang", "source"])
    n = F.col("n_words")
    failed = (n < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * n)
    stats = stats.select(F.col("row.carried").alias("row"), "row.lang", "row.source", *STATS, failed.alias("base_failed"))
    stats = written(stats, "statistics", compression="zstd")  # with whatever the rows carry
    passed = stats.where(~F.col("base_failed")).select("lang", "source", *STATS)
    sizes = passed.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    large, whole = F.col("n") >= rules.least_rows, F.xxhash64("lang", F.lit(""))  # sources are JSON and never empty
    groups = written(sizes.select("lang", "source", large.alias("large"), F.when(large, F.xxhash64("lang", "source")).otherwise(whole).alias("grp")), "groups")
    borrowing = groups.where("NOT large").select("lang").distinct()
    # whose texts an estimate is made from: a large group's own, and a language's where a small group borrows it
    members = groups.where("large").select("lang", "source", "grp").unionByName(groups.join(borrowing, "lang").select("lang", "source", whole.alias("grp")))
    members = written(members, "members")
    words = F.when(n > 0, n)  # texts without words have no axes
    length = (F.col("word_chars") / words).alias("length")
    centres = written(_quantiles(passed.join(members, ["lang", "source"]).select("grp", length), ["grp"], ["length"], 0.5, 1 / 256), "lengths")
    share = F.least(F.col("n_symbols") / words, F.lit(1.0))
    axes = (
        F.log1p(F.log(words)), F.sqrt(words) * (F.col("word_chars") / words - F.col("length")), F.asin(F.sqrt(share)),
        F.sqrt("n_dup_lines"), F.asin(F.sqrt(F.col("n_repeat_words") / words)),
    )
    # written, so that the planner knows how small it is and the texts that rows may carry stay where they are
    around, made_from = (written(x.join(centres, "grp").select("lang", "source", "grp", "length"), "around") for x in (groups, members))
    with_axes = [a.alias(AXES[i]) for i, a in enumerate(axes)]
    vectors = passed.join(made_from, ["lang", "source"]).select("grp", F.xxhash64(*STATS).alias("pick"), *with_axes)
    estimates = mcd_estimates(vectors, rules)
    placed = stats.join(around, ["lang", "source"], "left").select("row", *STATS, "base_failed", "grp", *with_axes).join(estimates, "grp", "left")
    distance = F.when(~F.col("base_failed"), _distance()).alias("distance")
    judged = placed.select("row", *STATS, "base_failed", distance)
    return judged.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= rules.cutoff, F.lit(False)))


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they came with."""
    return judge(docs, docs.columns, rules=rules).where("kept").select("row.*")
