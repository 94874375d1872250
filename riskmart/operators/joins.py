"""Equi-joins that hold when keys carry a large share of the rows, on either side or both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.sources.scratch import settled

HOT_ROWS = 1_000_000
SAMPLE = 0.01


def hot_keys(
    left: DataFrame, right: DataFrame, keys: list[str], rows: int = HOT_ROWS, sample: float = SAMPLE
) -> DataFrame:
    """The keys with more than about ``rows`` rows, and how many salts each side needs: one for every ``rows`` rows.

    Counted on a sample of the key columns. The table only decides how rows are spread, never
    which rows a join returns. It has one row for every ``rows`` input rows at most.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        drawn = df.select(keys) if sample >= 1 else df.select(keys).sample(sample, seed=7)
        salts = F.ceil(F.count("*") / F.lit(rows * sample)).cast("int")
        return drawn.groupBy(keys).agg(salts.alias(name)).filter(F.col(name) > 1)

    both = counted(left, "_left").join(counted(right, "_right"), keys, "full")
    return both.fillna(1, ["_left", "_right"])


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    rows: int = HOT_ROWS,
    sample: float = SAMPLE,
) -> DataFrame:
    """``left.join(right, keys, how)`` for ``how`` inner or left, with the hot keys salted.

    Rows of a hot key are dealt over as many salts as their side needs and repeated for each
    salt of the other side, so both sides split where both are hot. The key columns of both
    inputs are sampled first, so pass stored tables. Without a hot key it is the plain join.
    """
    kinds = [(dict(left.dtypes)[key], dict(right.dtypes)[key]) for key in keys]
    if any(a != b for a, b in kinds):
        raise ValueError(f"join keys {keys} differ in type: {kinds}")
    hot = settled(hot_keys(left, right, keys, rows, sample))
    if hot.isEmpty():
        return left.join(right, keys, how)
    dealt_left = _salted(left, hot, keys, "_left", "_a", "_right", "_b")
    dealt_right = _salted(right, hot, keys, "_right", "_b", "_left", "_a")
    on = [*keys, "_a", "_b"]
    if how == "inner":
        joined = dealt_left.join(dealt_right.drop("_right"), on)
    else:
        # A left row is repeated only where its key is hot on the right. Such a key was seen
        # there, so these rows all have partners, and the inner join loses none of them.
        fans = F.col("_right") > 1
        joined = dealt_left.filter(~fans).join(dealt_right.filter(~fans).drop("_right"), on, how)
        joined = joined.unionByName(dealt_left.filter(fans).join(dealt_right.filter(fans).drop("_right"), on))
    return joined.drop("_a", "_b", "_right")


def _salted(
    df: DataFrame, hot: DataFrame, keys: list[str], own: str, own_salt: str, other: str, other_salt: str
) -> DataFrame:
    """``df`` with a salt of its own, one row for each salt of the other side, and the right side's number of salts."""
    # The input partition is part of the salt, so equal rows spread too. Both parts come out the
    # same when a task is run again.
    dealt = df.withColumn(own_salt, F.xxhash64(F.spark_partition_id(), *df.columns)).join(hot, keys, "left")
    dealt = dealt.fillna(1, ["_left", "_right"]).withColumn(own_salt, F.pmod(own_salt, own).cast("int"))
    return dealt.withColumn(other_salt, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("_left")


def lookup(df: DataFrame, small: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join of per-group statistics to the rows of ``df``.

    ``small`` is computed once and written, so the plan knows its size: Spark broadcasts it,
    leaving ``df`` unshuffled, where it is small, and splits skewed partitions otherwise.
    """
    return df.join(settled(small), keys, how)
