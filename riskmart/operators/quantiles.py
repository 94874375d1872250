"""Column quantiles per group: approximate in one aggregate, or exact at any size.

The exact form reads the table twice and never holds the values of a group in one task. The first read builds a sketch of each
group and column, which gives a range for each wanted quantile. The second one keeps the values inside the ranges, a few
per cent of all, equal ones as one row with their number, and counts those on the range's shorter side, so every rank within a range is known.
Ranges of few values end in a running sum. Larger ones are narrowed on what was kept: a pass splits
the range around a rank into cells and counts them with partial aggregates; the cell that contains the rank, with the smallest
and largest value seen in it, is the range of the next pass. A range that spans orders of magnitude gets cells of equal ratio
instead of equal width. Infinities are counted apart and never bound a range.

A sketch is right but for a small chance. Counts show where a rank is outside its range; such a group is then narrowed from its
whole range, on the table itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskmart.operators.joins import lookup
from riskmart.operators.sketches import INFINITE, K, column_states, error_of, number, value_near, with_grid
from riskmart.sources.scratch import Staging, settled

CELLS = 4096
FEW = 100_000  # different values of a range that one task adds up
MOST_PASSES = 64  # far more than any range of doubles needs


def approx_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    by: list[str] = (),
    relative_error: float = 0.001,
) -> DataFrame:
    """One row per group with an array of quantiles per column; the values occur in the data."""
    accuracy = round(1 / relative_error)
    return df.groupBy(*by).agg(
        *[F.percentile_approx(F.col(c).cast("double"), list(probabilities), accuracy).alias(c) for c in columns]
    )


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    by: list[str] = (),
    interpolate: bool = True,
    margin: float | None = None,
    few: int = FEW,
    states: DataFrame | None = None,
) -> DataFrame:
    """One row per group with an array of exact quantiles per column.

    ``interpolate`` takes the point between the two nearest ranks; without it the result is
    the first value that at least the wanted share of rows does not exceed. Nulls and NaNs
    are left out; a column without values gives null, a group without any has no row. ``df``
    is read twice, so it should come straight from a stored table. ``margin`` is the share of rows on either side of a quantile
    that its range covers, by default the sketch's error. ``states`` of the same rows, as ``column_states`` or ``merged_states`` give
    them, save the first read; their counts must be those of ``df``.
    """
    by, columns = list(by), list(columns)
    keys = [*by, "c"]
    staging = Staging(df.sparkSession)
    states = staging.table(column_states(df, columns, by) if states is None else states, "states")
    targets = staging.table(_targets(states, list(probabilities), keys, interpolate, error_of(K) if margin is None else margin), "targets")
    entries = [F.struct(F.lit(c).alias("c"), number(name).alias("v")) for c, name in enumerate(columns)]
    long = df.select(*by, F.inline(F.array(*entries))).filter("v is not null")
    kept = staging.table(_inside(long, targets.filter(_finite()), keys), "kept")
    found = _found(long, kept, targets, [*keys, "p"], few, staging)
    quantiles = found.groupBy(*keys).agg(F.array(*[_quantile(p) for p in range(len(probabilities))]).alias("quantiles"))
    # One row per group and column so far; every group with a value has a row.
    return quantiles.groupBy(*by).agg(
        *[F.max(F.when(F.col("c") == c, F.col("quantiles"))).alias(name) for c, name in enumerate(columns)]
    )


def _targets(states: DataFrame, probabilities: list[float], keys: list[str], interpolate: bool, margin: float) -> DataFrame:
    """One row per rank to find, with the range ``lo`` to ``hi`` it should lie in, and whether the rows under or over that are fewer."""
    finite = F.col("n") - F.col("lowest") - F.col("highest")
    wanted = []
    for p, share in enumerate(probabilities):
        near = F.try_divide(F.col("n") * F.lit(float(share)) - F.col("lowest"), finite)
        reach = F.try_divide(F.lit(2), finite) + margin
        low, high = value_near(near - reach, F.floor), value_near(near + reach, F.ceil)
        wanted += [
            F.struct(F.lit(p).alias("p"), F.lit(side).alias("side"), rank.cast("long").alias("rank"), fraction.alias("fraction"),
                     low.alias("low"), high.alias("high"), (near <= 0.5).alias("from_below"))
            for side, rank, fraction in _ranks(F.col("n"), share, interpolate)
        ]
    each = with_grid(states).select(*keys, "n", "lowest", "highest", "least", "most", F.inline(F.array(*wanted)))

    def end(name: str) -> Column:
        low, high = F.col("rank") <= F.col("lowest"), F.col("rank") > F.col("n") - F.col("highest")
        return F.when(low, -INFINITE).when(high, INFINITE).otherwise(F.col(name))

    return each.select(
        *keys, "n", "lowest", "highest", "least", "most", "p", "side", "rank", "fraction", "from_below", end("low").alias("lo"), end("high").alias("hi")
    )


def _finite() -> Column:
    """Whether a rank is not among the infinities; its range is a guess then, even where that is a single value."""
    return F.abs("lo") < INFINITE


def _inside(long: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """``v, rows`` of the values in each range, and the rows on its shorter side under a null."""
    ranges = targets.groupBy(*keys, "p").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.first("from_below").alias("from_below"))
    value, inside = F.col("v"), F.col("v").between(F.col("lo"), F.col("hi"))
    beside = F.when(F.col("from_below"), value < F.col("lo")).otherwise(value > F.col("hi")) & (F.abs(value) < INFINITE)
    met = lookup(long, ranges, keys, "inner").filter(inside | beside)
    return met.groupBy(*keys, "p", F.when(inside, value).alias("v")).agg(F.count("*").alias("rows"))


def _found(long: DataFrame, kept: DataFrame, targets: DataFrame, keys: list[str], few: int, staging: Staging) -> DataFrame:
    """``targets`` with ``lo`` and ``hi`` both the value at the rank."""
    counts = kept.groupBy(*keys).agg(
        F.sum(F.when(F.col("v").isNull(), F.col("rows"))).alias("beside"), F.sum(F.when(F.col("v").isNotNull(), F.col("rows"))).alias("inside"),
        F.count("v").alias("values"), F.min("v").alias("first"), F.max("v").alias("last"),
    )
    open_ = targets.filter(_finite()).join(counts, keys, "left")
    beside, inside = F.coalesce("beside", F.lit(0)), F.coalesce("inside", F.lit(0))
    below = F.when(F.col("from_below"), F.col("lowest") + beside).otherwise(F.col("n") - F.col("highest") - beside - inside)
    placed = open_.withColumn("below", below).withColumn("sure", (F.col("rank") > F.col("below")) & (F.col("rank") <= F.col("below") + inside))
    placed = staging.table(placed, "placed")
    small, large = (F.expr(f"sure and values {sign} {few}") for sign in ("<=", ">"))
    sizes = placed.agg(F.count_if(small), F.count_if(large), F.count_if(~F.col("sure"))).first()
    shown = [*keys, "side", "rank", "fraction", "lo", "hi", "below"]
    done = [targets.filter(~_finite()).withColumn("below", F.lit(0).cast("long")).select(shown)]
    if sizes[0]:
        order = W.partitionBy(*keys).orderBy("v")
        sums = kept.filter("v is not null").withColumn("upto", F.sum("rows").over(order))
        met = placed.filter(small).join(sums, keys)
        met = met.filter((F.col("rank") > F.col("below") + F.col("upto") - F.col("rows")) & (F.col("rank") <= F.col("below") + F.col("upto")))
        done.append(met.withColumn("lo", F.col("v")).withColumn("hi", F.col("v")).select(shown))
    if sizes[1]:
        many = placed.filter(large).withColumn("lo", F.col("first")).withColumn("hi", F.col("last"))
        done.append(_narrowed_down(kept.filter("v is not null"), many.select(shown), keys))
    if sizes[2]:
        lost = placed.filter(~F.col("sure")).withColumn("lo", F.col("least")).withColumn("hi", F.col("most")).withColumn("below", F.col("lowest"))
        lost = staging.table(lost.select(shown), "lost")
        again = lookup(long.withColumn("rows", F.lit(1).cast("long")), lost.select(keys).distinct(), keys[:-1], "inner")
        done.append(_narrowed_down(again, lost, keys))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _narrowed_down(values: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """``targets`` whose ranges are cut down to single values by passes over ``values`` (keys, v, rows)."""
    targets = settled(targets)
    for _ in range(MOST_PASSES):
        if targets.filter("lo < hi").isEmpty():
            return targets
        narrowed = _narrowed(values, targets.filter("lo < hi"), keys)
        targets = settled(targets.filter("lo >= hi").unionByName(narrowed))
    raise RuntimeError("ranges of quantiles did not narrow")


def _ranks(n: Column, share: float, interpolate: bool) -> list[tuple[int, Column, Column]]:
    """(side, rank counted from 1, weight of the upper side) of the values a quantile is made of."""
    if not interpolate:
        return [(0, F.greatest(F.ceil(n * share), F.lit(1)), F.lit(0.0))]
    point = (n - 1) * F.lit(float(share))
    fraction = point - F.floor(point)
    return [(0, F.floor(point) + 1, fraction), (1, F.ceil(point) + 1, fraction)]


def _quantile(p: int) -> Column:
    def of(side: int, name: str) -> Column:
        return F.max(F.when((F.col("p") == p) & (F.col("side") == side), F.col(name)))

    lower, upper, fraction = of(0, "lo"), of(1, "lo"), of(0, "fraction")
    between = lower * (1 - fraction) + upper * fraction
    # Towards an infinite neighbour any part of the way is all of it.
    between = F.when(fraction == 0, lower).when(lower == -INFINITE, lower).when(upper == INFINITE, upper).otherwise(between)
    return F.when(lower < upper, between).otherwise(lower)


def _position(value: Column, lo: Column, hi: Column) -> Column:
    """Where a value lies in its range, from 0 to 1; never falling as the value rises."""
    # Halves where the width overflows.
    linear = F.when(hi - lo < INFINITE, (value - lo) / (hi - lo)).otherwise((value / 2 - lo / 2) / (hi / 2 - lo / 2))

    def magnitude(x: Column) -> Column:
        # The smallest double has a logarithm of -744.4.
        return F.when(x == 0, 0.0).otherwise(F.signum(x) * (F.ln(F.abs(x)) + 746))

    wide = (F.signum(lo) * F.signum(hi) <= 0) | (F.greatest(F.abs(lo), F.abs(hi)) / 4 > F.least(F.abs(lo), F.abs(hi)))
    ratio = F.try_divide(magnitude(value) - magnitude(lo), magnitude(hi) - magnitude(lo))
    return F.when(wide & (magnitude(hi) > magnitude(lo)), ratio).otherwise(linear)


def _narrowed(values: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """``targets`` with each range cut down to the cell that holds the rank.

    Two ranges of a quantile are equal or disjoint, so a value falls into one of them at most.
    """
    targets = targets.withColumn("span", F.dense_rank().over(W.partitionBy(*keys).orderBy("lo")))
    ranges = targets.select(*keys, "span", "lo", "hi").distinct()
    cell = F.least(F.floor(_position(F.col("v"), F.col("lo"), F.col("hi")) * CELLS), F.lit(CELLS - 1))
    cells = (
        lookup(values, ranges, keys, "inner")
        .filter(F.col("v").between(F.col("lo"), F.col("hi")))
        .groupBy(*keys, "span", cell.alias("cell"))
        .agg(F.sum("rows").alias("rows"), F.min("v").alias("cell_lo"), F.max("v").alias("cell_hi"))
    )
    # At most CELLS rows per range.
    order = W.partitionBy(*keys, "span").orderBy("cell")
    cells = cells.withColumn("upto", F.sum("rows").over(order))
    before = F.col("below") + F.col("upto") - F.col("rows")
    return (
        targets.join(cells, [*keys, "span"])
        .filter((F.col("rank") > before) & (F.col("rank") <= F.col("below") + F.col("upto")))
        .select(*keys, "side", "rank", "fraction", F.col("cell_lo").alias("lo"), F.col("cell_hi").alias("hi"), before.alias("below"))
    )
