"""Mergeable quantile sketches of columns, per group: counts, ends and a KLL sketch.

States of disjoint rows merge into the state of all of them, so a table may keep the states of each snapshot, and bounds
over years come from those. A sketch knows a rank to within ``error_of(k)`` of all rows, but for a small chance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K, GRID = 1000, 200
INFINITE = float("inf")
COUNTS = ["n", "lowest", "highest"]


def error_of(k: int) -> float:
    """Four times the normalized rank error that a KLL sketch of ``k`` keeps in 99 of 100 cases."""
    return 4 * 2.446 / k**0.9433


def number(name: str) -> Column:
    """A column as doubles; NaN counts as null."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


def column_states(df: DataFrame, columns: list[str], by: list[str] = (), k: int = K, keep_empty: bool = False) -> DataFrame:
    """One row per group and column with values: ``c``, its place in ``columns``, and its state.

    A state is ``n`` values, of which ``lowest`` are minus infinity and ``highest`` infinity, the ``least`` and ``most`` of the
    finite ones, and their ``sketch``. One aggregate of the rows as they are, with partial states in each task.
    ``keep_empty`` also gives the state of a column without values, with ``n`` 0.
    """

    def state(c: int, name: str) -> Column:
        value = number(name)
        finite = F.when(F.abs(value) < INFINITE, value)
        return F.struct(
            F.lit(c).alias("c"), F.count(value).alias("n"), F.count_if(value == -INFINITE).alias("lowest"), F.count_if(value == INFINITE).alias("highest"),
            F.min(finite).alias("least"), F.max(finite).alias("most"), F.kll_sketch_agg_double(finite, F.lit(k)).alias("sketch"),
        )

    wide = df.groupBy(*by).agg(F.array(*[state(c, name) for c, name in enumerate(columns)]).alias("states"))
    states = wide.select(*by, F.inline("states"))
    return states if keep_empty else states.filter("n > 0")


def merged_states(states: DataFrame, by: list[str] = ()) -> DataFrame:
    """States of coarser groups, from those of their parts."""
    filled = F.when(F.col("least").isNotNull(), F.col("sketch"))
    return states.groupBy(*by, "c").agg(
        *[F.sum(c).alias(c) for c in COUNTS], F.min("least").alias("least"), F.max("most").alias("most"), F.kll_merge_agg_double(filled).alias("sketch")
    )


def with_grid(states: DataFrame) -> DataFrame:
    """States with the values at ``GRID`` even steps of their finite rows."""
    steps = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    return states.withColumn("grid", F.when(F.col("least").isNotNull(), F.kll_sketch_get_quantile_double("sketch", steps)))


def value_near(rank: Column, towards: Callable[[Column], Column]) -> Column:
    """The value of a state's grid at the normalized rank, from 0 to 1, rounded to a step; its ends are exact."""
    step = towards(rank * GRID).cast("int")
    return F.when(step <= 0, F.col("least")).when(step >= GRID, F.col("most")).otherwise(F.try_element_at("grid", step + 1))


def estimated_quantiles(states: DataFrame, columns: list[str], probabilities: list[float], by: list[str] = ()) -> DataFrame:
    """One row per group with an array of quantiles per column, each within the sketch's rank error of the exact one.

    Where infinities shift the ranks, half a step of the grid comes on top.
    """

    def quantile(share: float) -> Column:
        rank = F.ceil(F.col("n") * share)
        finite = F.try_divide(rank - F.col("lowest"), F.col("n") - F.col("lowest") - F.col("highest"))
        low, high = rank <= F.col("lowest"), rank > F.col("n") - F.col("highest")
        whole = (F.col("lowest") == 0) & (F.col("highest") == 0)
        plain = F.kll_sketch_get_quantile_double("sketch", F.lit(float(share)))
        return F.when(whole, plain).when(low, -INFINITE).when(high, INFINITE).otherwise(value_near(finite, F.round))

    found = with_grid(states).select(*by, "c", F.array(*[quantile(p) for p in probabilities]).alias("quantiles"))
    return found.groupBy(*by).agg(*[F.max(F.when(F.col("c") == c, F.col("quantiles"))).alias(name) for c, name in enumerate(columns)])
