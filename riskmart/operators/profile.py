"""Profiles of a table: counts, distributions, histograms and correlations as small tables."""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.quantiles import exact_quantiles
from riskmart.schemas import SNAPSHOT
from riskmart.sources.scratch import settled

BINS = 50
LOWEST_OVERLAP = 80.0

# The columns of the correlation matrix and of the category counts.
CORRELATED = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
    "Credit_History_Age",
    "Num_of_Delayed_Payment",
    "Delay_from_due_date",
]
COUNTED_CATEGORIES = ["Credit_Mix", "Payment_Behaviour", "Payment_of_Min_Amount", "Occupation"]


def snapshot_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(SNAPSHOT).agg(F.count("*").alias("row_count"))


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).alias("column_count"))


def overlap_quality(full: DataFrame, marker: str = "fe_1", lowest: float = LOWEST_OVERLAP) -> DataFrame:
    """Per snapshot, the rows with clickstream data, their share, and whether it is too low."""
    counts = full.groupBy(SNAPSHOT).agg(F.count("*").alias("total"), F.count(marker).alias("matched"))
    share = F.coalesce(F.try_divide(F.col("matched"), F.col("total")) * 100, F.lit(0.0))
    return counts.withColumn("match_pct", share).withColumn("warn", F.col("match_pct") < lowest)


def distribution(df: DataFrame, column: str = "label") -> DataFrame:
    """Rows and percentage per value, ordered by value."""
    counts = settled(df.groupBy(column).agg(F.count("*").alias("row_count")))
    total = counts.agg(F.sum("row_count")).first()[0] or 1
    return counts.withColumn("pct", F.col("row_count") / total * 100).orderBy(column)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def histogram(
    df: DataFrame, columns: list[str] | None = None, bins: int = BINS, shares: tuple[float, float] = (0.01, 0.99)
) -> DataFrame:
    """Equal bins per column between two exact quantiles, and the rows outside of them."""
    columns = columns or numeric_columns(df)
    limits = exact_quantiles(df, columns, list(shares)).first()
    return _binned(df, {c: tuple(limits[c] or (None, None)) for c in columns}, bins)


def full_range_histogram(df: DataFrame, columns: list[str], bins: int = BINS) -> DataFrame:
    """Equal bins per column between its smallest and largest value."""
    limits = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    return _binned(df, {c: (limits[f"lo{i}"], limits[f"hi{i}"]) for i, c in enumerate(columns)}, bins)


def _binned(df: DataFrame, limits: dict[str, tuple[float | None, float | None]], bins: int) -> DataFrame:
    """Counts of every bin, empty ones too, for columns that have any value."""
    spans = {c: (lo, hi) for c, (lo, hi) in limits.items() if lo is not None}
    # A single value gets a range of width one around it.
    ranges = {c: (lo, hi) if lo < hi else (lo - 0.5, hi + 0.5) for c, (lo, hi) in spans.items()}
    names = list(spans)

    def entry(position: int, name: str) -> Column:
        value, (lo, hi), (first, last) = F.col(name).cast("double"), ranges[name], spans[name]
        spot = F.least(F.floor((value - lo) / ((hi - lo) / bins)), F.lit(bins - 1)).cast("int")
        return F.struct(
            F.lit(position).alias("c"),
            # Null stays null; least() alone would turn it into the last bin.
            F.when((value < lo) | (value > hi), -1).when(value.isNotNull(), spot).alias("bin"),
            ((value < first) | (value > last)).cast("int").alias("outside"),
        )

    rows = df.select(F.inline(F.array(*[entry(i, c) for i, c in enumerate(names)]))).filter("bin is not null")
    counts = rows.groupBy("c", "bin").agg(F.count("*").alias("n"), F.sum("outside").alias("outside"))
    per_column = counts.groupBy("c").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("filled"),
        F.sum("outside").alias("outside_count"),
    )
    # From here on one row per column and bin.
    rows = per_column.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    edges = F.array(*[F.struct(F.lit(c).alias("name"), F.lit(float(ranges[c][0])).alias("lo"),
                               F.lit(float((ranges[c][1] - ranges[c][0]) / bins)).alias("width")) for c in names])
    edge = F.element_at(edges, F.col("c") + 1)
    return rows.select(
        edge["name"].alias("column"),
        "bin",
        (edge["lo"] + edge["width"] * F.col("bin")).alias("lower_edge"),
        (edge["lo"] + edge["width"] * (F.col("bin") + 1)).alias("upper_edge"),
        F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0)).alias("row_count"),
        "outside_count",
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per category of each column without nulls, the most frequent first."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in columns]
    counts = df.select(F.inline(F.array(*entries))).filter("category is not null")
    counts = counts.groupBy("column", "category").agg(F.count("*").alias("row_count"))
    return counts.orderBy("column", F.desc("row_count"), "category")


COMOMENT = ["n", "mean_a", "mean_b", "aa", "bb", "ab"]


def _comoment(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Count, means, and sums of squares and products of the deviations from these."""
    if not len(a):
        return np.zeros(len(COMOMENT))
    with np.errstate(invalid="ignore"):
        # The mean of equal values is that value, so they have no deviation at all.
        first_a, first_b = a[0], b[0]
        mean_a, mean_b = first_a + (a - first_a).mean(), first_b + (b - first_b).mean()
        da, db = a - mean_a, b - mean_b
        return np.array([len(a), mean_a, mean_b, da @ da, db @ db, da @ db])


def _merged(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The state of the rows of both."""
    if not p[0] or not q[0]:
        return q if not p[0] else p
    with np.errstate(invalid="ignore"):
        n = p[0] + q[0]
        da, db = q[1] - p[1], q[2] - p[2]
        share = p[0] * q[0] / n
        return np.array([n, p[1] + da * q[0] / n, p[2] + db * q[0] / n,
                         p[3] + q[3] + da * da * share, p[4] + q[4] + db * db * share, p[5] + q[5] + da * db * share])


def correlation(df: DataFrame, columns: list[str] = CORRELATED) -> DataFrame:
    """Pearson matrix as rows, each pair over the rows in which both columns are known.

    Null where a column does not vary over those rows.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    values = df.select([F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    places = list(combinations_with_replacement(range(len(columns)), 2))

    def comoments(batches):
        total = np.zeros((len(places), 6))
        for batch in batches:
            known = [~pc.is_null(column).to_numpy(zero_copy_only=False) for column in batch.columns]
            x = [pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False) for column in batch.columns]
            for i, (a, b) in enumerate(places):
                both = known[a] & known[b]
                total[i] = _merged(total[i], _comoment(x[a][both], x[b][both]))
        met = [i for i in range(len(places)) if total[i, 0]]
        arrays = [pa.array(met, pa.int32()), *[pa.array(total[met, k]) for k in range(6)]]
        yield pa.RecordBatch.from_arrays(arrays, ["i", *COMOMENT])

    # One row per pair and task, each with the state of the task's rows.
    states = settled(values.mapInArrow(comoments, "i int, " + ", ".join(f"{c} double" for c in COMOMENT)))
    # Counted from the least mean, so that equal means leave no deviation.
    weighted = [(F.min(c) + F.try_divide(F.sum(F.col("n") * (F.col(c) - F.col(f"least_{c}"))), F.sum("n"))).alias(f"all_{c}") for c in ("mean_a", "mean_b")]
    least = states.groupBy("i").agg(*[F.min(c).alias(f"least_{c}") for c in ("mean_a", "mean_b")])
    apart_a, apart_b = F.col("mean_a") - F.col("all_mean_a"), F.col("mean_b") - F.col("all_mean_b")
    moved = states.join(states.join(least, "i").groupBy("i").agg(*weighted), "i").groupBy("i").agg(
        F.sum(F.col("aa") + F.col("n") * apart_a * apart_a).alias("aa"),
        F.sum(F.col("bb") + F.col("n") * apart_b * apart_b).alias("bb"),
        F.sum(F.col("ab") + F.col("n") * apart_a * apart_b).alias("ab"),
    )
    found = moved.select("i", F.try_divide("ab", F.sqrt("aa") * F.sqrt("bb")).alias("r"))

    cells = [F.struct(F.lit(i).alias("i"), F.lit(a).alias("column_a"), F.lit(b).alias("column_b"))
             for i, pair in enumerate(pairs) for a, b in sorted({pair, pair[::-1]})]
    matrix = df.sparkSession.range(1).select(F.inline(F.array(*cells)))
    same = F.col("column_a") == F.col("column_b")
    return matrix.join(found, "i", "left").select(
        "column_a", "column_b", F.when(same & F.col("r").isNotNull(), 1.0).otherwise(F.col("r")).alias("r")
    )
