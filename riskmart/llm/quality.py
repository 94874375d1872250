"""Quality rules: base limits on words, then robust multivariate outliers by language and source.

The statistics of each document are transformed to five numbers on comparable scales. For each
language and source a minimum-covariance-determinant estimate of centre and scatter is fitted: from
medians and absolute deviations the nearest three quarters of the documents are found, their mean and covariance give
new distances, and so on (concentration steps), each time over all documents with one
aggregate by group and distance bin. A last step takes every document within the usual range. The same is done for each
language and for all documents, and a group's centre and scatter are shrunk towards its language's, which are shrunk towards
those of all documents: with n documents the own estimate weighs n / (n + ``PRIOR``), and the rest goes to the
broader estimate, whose scatter is widened by how far the centres of such groups lie from their broader ones. So every group has
a verdict, whatever its size. A document whose squared Mahalanobis distance passes a far chi-square quantile is rejected.

Everything is DataFrame expressions. Estimates are tables of one row per group; nothing per document is ever collected.

Defined results: a null, empty or blank text has no words and fails the base limits; null languages and sources are groups
like others; repeated rows count as often as they occur; equal distances are treated alike;
an empty table gives no rows; extra columns are kept by ``quality_filter`` and not read otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.llm.registry import query, table
from riskmart.sources.scratch import Staging

BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
WINDOW = 5
MIN_WORDS, MAX_REPEATED = 10, 20  # words; percent of the words
PRIOR = 50.0  # documents that the broader estimate counts for
SUPPORT = 0.75  # share of a group that the estimate rests on
STEPS = 4
USUAL, FAR = 0.975, 1 - 1e-6  # chi-square levels of the last step and of the verdict
BINS = 16  # distance bins per factor of two
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Transformed statistics and the spread that each has at least.
SHAPE = ["x0", "x1", "x2", "x3", "x4"]
FLOORS = [0.5, 0.1, 0.05, 0.2, 0.15]


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the five statistics and ``base_failed`` of each text."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    trimmed = F.btrim(body, F.lit(BLANKS))
    found = docs.select(
        *kept, body.alias("_body"), F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_CLASS + "+")).alias("_words")
    )
    lines = F.filter(F.split("_body", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    found = found.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("_body", BLANK_CLASS + "+", "")).cast("long").alias("word_chars"),
        F.regexp_count("_body", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.transform("_words", lambda word: F.xxhash64(word)).alias("_hashes"),
    )
    ends = F.size("_hashes") - WINDOW
    windows = F.transform(
        F.when(ends >= 0, F.sequence(F.lit(0), ends)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(WINDOW)]),
    )
    found = found.select(
        *kept, *STATISTICS[:3],
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows"),
    )
    # Only a text with a repeated window needs its windows sorted.
    found = found.select(
        *kept, *STATISTICS[:4],
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"),
            F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("_sorted"),
    )
    same = lambda a, b: a["h"] == b["h"]
    repeated = F.filter(
        "_sorted", lambda x, j: F.coalesce(same(F.get("_sorted", j - 1), x), F.lit(False)) | F.coalesce(same(F.get("_sorted", j + 1), x), F.lit(False))
    )
    found = found.select(*kept, *STATISTICS[:4], F.sort_array(F.transform(repeated, lambda x: x["i"])).alias("_starts"))
    covered = F.aggregate(
        "_starts", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")),
    )["n"]
    found = found.select(*kept, *STATISTICS[:4], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def shape() -> list[Column]:
    """The transformed statistics of a text; null without words."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return [
        F.log(words),
        F.log(F.try_divide(chars, words)),
        F.sqrt(F.try_divide(F.col("n_symbols"), chars)),
        F.sqrt(F.try_divide(F.col("n_dup_lines"), words)),
        F.sqrt(F.try_divide(F.col("n_repeat_words"), words)),
    ]


def with_verdict(stats: DataFrame, by: list[str], staging: Staging, far: float = FAR) -> DataFrame:
    """``stats`` with ``distance`` (squared; null where the base limits fail) and ``kept``.

    ``by`` are the columns of a group, the broadest first. ``stats`` is read once per step, so it
    should be a stored table.
    """
    good = ~F.col("base_failed")
    # Names of its own for the keys, so that nothing clashes with a document's columns.
    levels = [F.struct(F.lit(k).alias("level"), *_keys(by[:k], by)) for k in range(len(by) + 1)]
    narrow = f"_g{len(by)}"
    sizes = stats.filter(good).groupBy(*[level.alias(f"_g{k}") for k, level in enumerate(levels)]).agg(F.count("*").alias("n"))
    groups = staging.table(sizes, "groups")
    points = stats.filter(good).select(F.explode(F.array(*levels)).alias("_group"), *[x.alias(c) for c, x in zip(SHAPE, shape())])
    fit = shrunk(groups, estimates(points, staging), len(by), staging)
    judged = stats.withColumns({narrow: levels[-1]} | dict(zip(SHAPE, shape()))).join(fit, narrow, "left")
    judged = judged.withColumn("distance", F.when(good, mahalanobis()))
    kept = good & (F.col("distance") <= chi_square_quantile(far, len(SHAPE)))
    return judged.withColumn("kept", F.coalesce(kept, F.lit(False))).select(*stats.columns, "distance", "kept")


def _keys(used: list[str], all_keys: list[str]) -> list[Column]:
    """Null keys marked as such, so that they join like any other value."""
    parts = []
    for i, key in enumerate(all_keys):
        value = F.col(f"`{key}`").cast("string") if key in used else F.lit(None).cast("string")
        parts += [value.isNull().alias(f"null{i}"), F.coalesce(value, F.lit("")).alias(f"key{i}")]
    return parts


def estimates(points: DataFrame, staging: Staging) -> DataFrame:
    """Centre ``m*`` and Cholesky factor ``l*_*`` of the scatter of each ``_group``.

    The estimates after each step are written, so the next step's plan knows how small they are and need not
    bring the points of a group together to join them.
    """
    p = len(SHAPE)
    middle = points.groupBy("_group").agg(*[F.percentile_approx(x, 0.5, 1000).alias(f"m{i}") for i, x in enumerate(SHAPE)])
    middle = staging.table(middle, "middle")
    spread = points.join(middle, "_group").groupBy("_group").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(p)],
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m{i}")), 0.5, 1000).alias(f"s{i}") for i, x in enumerate(SHAPE)],
    )
    factor = {f"l{i}_{j}": F.greatest(1.4826 * F.col(f"s{i}"), F.lit(FLOORS[i])) if i == j else F.lit(0.0) for i in range(p) for j in range(i + 1)}
    fit = spread.select("_group", *[f"m{i}" for i in range(p)], *[v.alias(k) for k, v in factor.items()])
    fit = staging.table(fit, "fit")
    for step in range(STEPS):
        fit = staging.table(_step(points, fit, SUPPORT, None), f"fit{step}")
    return staging.table(_step(points, fit, USUAL, chi_square_quantile(USUAL, p)), "estimates")


def _step(points: DataFrame, fit: DataFrame, share: float, within: float | None) -> DataFrame:
    """Estimate from the nearest ``share`` of each group, or from the points ``within`` a squared distance."""
    p = len(SHAPE)
    moved = points.join(fit, "_group").withColumn("distance", mahalanobis())
    moved = moved.select(
        "_group", F.floor(BINS * F.log2(F.col("distance") + 1e-9)).alias("bin"), "distance",
        *[f"m{i}" for i in range(p)], *[(F.col(x) - F.col(f"m{i}")).alias(x) for i, x in enumerate(SHAPE)],
    )
    products = {f"p{i}_{j}": F.sum(F.col(SHAPE[i]) * F.col(SHAPE[j])) for i in range(p) for j in range(i + 1)}
    sums = {f"p{i}": F.sum(SHAPE[i]) for i in range(p)}
    centre = {f"m{i}": F.first(f"m{i}") for i in range(p)}
    if within is not None:
        moved = moved.filter(F.col("distance") <= within)
    bins = moved.groupBy("_group", "bin").agg(
        F.count("*").alias("n"), *[v.alias(k) for k, v in (products | sums | centre).items()]
    )
    if within is None:  # bins up to the one that holds the wanted share
        below = F.coalesce(F.sum("n").over(W.partitionBy("_group").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        bins = bins.withColumn("below", below).withColumn("all", F.sum("n").over(W.partitionBy("_group")))
        bins = bins.filter(F.col("below") < share * F.col("all"))
    total = bins.groupBy("_group").agg(
        F.sum("n").alias("n"), *[F.sum(k).alias(k) for k in products | sums], *[F.first(k).alias(k) for k in centre]
    )
    # Scatter of the inner part of a normal cloud is too small by this much.
    inner = share / chi_square_cdf(chi_square_quantile(share, p), p + 2)
    cov = {
        f"c{i}_{j}": inner * (F.col(f"p{i}_{j}") / F.col("n") - F.col(f"p{i}") * F.col(f"p{j}") / F.col("n") ** 2) + (FLOORS[i] ** 2 if i == j else 0.0)
        for i in range(p) for j in range(i + 1)
    }
    out = total.select(
        "_group", *[(F.col(f"m{i}") + F.col(f"p{i}") / F.col("n")).alias(f"m{i}") for i in range(p)], *[v.alias(k) for k, v in cov.items()]
    )
    return _factored(out)


def _factored(fit: DataFrame) -> DataFrame:
    """Cholesky factor ``l*_*`` instead of the scatter ``c*_*``, entry by entry."""
    p = len(SHAPE)
    for i in range(p):
        for j in range(i + 1):
            rest = F.col(f"c{i}_{j}") - sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
            fit = fit.withColumn(f"l{i}_{j}", F.sqrt(F.greatest(rest, F.lit(FLOORS[i] ** 2))) if i == j else rest / F.col(f"l{j}_{j}"))
    return fit.drop(*[f"c{i}_{j}" for i in range(p) for j in range(i + 1)])


def shrunk(groups: DataFrame, fit: DataFrame, depth: int, staging: Staging) -> DataFrame:
    """Centre and Cholesky factor of each narrowest group, shrunk level by level from all documents down.

    ``groups`` has the keys ``_g0`` (all documents) to ``_g<depth>`` and the size ``n`` of every narrowest group.
    """
    p = len(SHAPE)
    entries = [(i, j) for i in range(p) for j in range(i + 1)]
    scatter = {f"c{i}_{j}": sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j + 1)), F.lit(0.0)) for i, j in entries}
    centre = [f"m{i}" for i in range(p)]
    own = fit.select("_group", *centre, *[v.alias(c) for c, v in scatter.items()])
    level = own.filter(F.col("_group.level") == 0).withColumnRenamed("_group", "_g0")
    for k in range(1, depth + 1):
        broad = level.select(f"_g{k - 1}", *[F.col(c).alias(f"b{c}") for c in [*centre, *scatter]])
        sizes = groups.groupBy(f"_g{k}", f"_g{k - 1}").agg(F.sum("n").alias("n"))
        both = sizes.join(own.withColumnRenamed("_group", f"_g{k}"), f"_g{k}").join(broad, f"_g{k - 1}")
        both = both.withColumn("w", F.col("n") / (F.col("n") + PRIOR))
        apart = [F.col(c) - F.col(f"b{c}") for c in centre]
        both = staging.table(both, f"level{k}")
        # A small group says little of how far centres lie apart.
        between = both.agg(*[(F.sum(F.col("w") ** 2 * apart[i] * apart[j]) / F.sum(F.col("w") ** 2)).alias(f"a{i}_{j}") for i, j in entries])
        rest = 1 - F.col("w")
        level = both.crossJoin(F.broadcast(between)).select(
            f"_g{k}",
            *[(F.col("w") * F.col(c) + rest * F.col(f"b{c}")).alias(c) for c in centre],
            *[(F.col("w") * F.col(f"c{i}_{j}") + rest * (F.col(f"bc{i}_{j}") + F.col(f"a{i}_{j}"))).alias(f"c{i}_{j}") for i, j in entries],
        )
    return staging.table(_factored(level), "shrunk")


def mahalanobis() -> Column:
    """Squared distance of a point from the centre of its group: solve L z = x - m, sum z squared."""
    def entry(i: int) -> Callable[[Column], Column]:
        def extend(z: Column) -> Column:
            rest = F.col(SHAPE[i]) - F.col(f"m{i}") - sum((F.col(f"l{i}_{k}") * z[k] for k in range(i)), F.lit(0.0))
            return F.concat(z, F.array(rest / F.col(f"l{i}_{i}")))
        return extend

    z = F.array().cast("array<double>")
    z = F.transform(F.array(z), entry(0))
    for i in range(1, len(SHAPE)):
        z = F.transform(z, entry(i))
    return F.aggregate(z[0], F.lit(0.0), lambda a, x: a + x * x)


def chi_square_cdf(x: float, degrees: int) -> float:
    """Series of the lower incomplete gamma function."""
    a, half = degrees / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= half / n
        total += term
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a))


def chi_square_quantile(level: float, degrees: int) -> float:
    low, high = 0.0, 200.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, degrees) < level else (low, middle)
    return high


def quality_filter(docs: DataFrame, staging: Staging) -> DataFrame:
    """The documents that are kept, with their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    stats = staging.table(with_statistics(docs.select(row, "text", "lang", "source")).drop("text"), "statistics")
    judged = with_verdict(stats, ["lang", "source"], staging)
    return judged.filter("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


@query("op5_quality")
def op5_quality(spark, sf_dir):
    staging = Staging(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    stats = staging.table(with_statistics(docs).drop("text"), "statistics")
    return with_verdict(stats, ["lang", "source"], staging).select("doc_id", *STATISTICS, "base_failed", "kept", "distance")
