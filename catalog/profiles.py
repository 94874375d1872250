"""Profiles of the silver and feature tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query
from catalog.features import base, financials, full_base
from catalog.views import duck, raw, table
from riskmart.operators import profile, silver, sketches
from riskmart.operators.joins import lookup
from riskmart.plans import states
from riskmart.schemas import CLICKSTREAM_FEATURES, FINANCIAL_TYPES
from riskmart.sources import snapshots
from riskmart.sources.scratch import Staging
from riskmart.sources.snapshots import write_snapshots

NUMERIC = [c for c, kind in FINANCIAL_TYPES.items() if kind != "string"]


@query(duck("""
    select snapshot_date, count(*) as total, count(fe_1) as matched, count(fe_1) / count(*) * 100 as match_pct,
           count(fe_1) / count(*) * 100 < 80 as warn from full_base group by snapshot_date"""))
def overlap_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.overlap_quality(full_base(spark, sf_dir))


def _histogram_sql(view: str, columns: list[str], low: str, high: str) -> str:
    as_doubles = ", ".join(f"cast({c} as double) as {c}" for c in columns)
    return duck(f"""
        select column_name as "column", cast(bin as integer) as bin, lo + (hi - lo) / 50 * bin as lower_edge,
               lo + (hi - lo) / 50 * (bin + 1) as upper_edge,
               count(case when least(floor((v - lo) / ((hi - lo) / 50)), 49) = bin and v between lo and hi then 1 end)
                   as row_count,
               count(case when v < lo or v > hi then 1 end) as outside_count
        from (select u.column_name, u.v, l.lo, l.hi
              from (unpivot (select {as_doubles} from {view}) on columns(*) into name column_name value v) u
              join (select column_name, {low} as lo, {high} as hi
                    from (unpivot (select {as_doubles} from {view}) on columns(*) into name column_name value v)
                    group by column_name) l on u.column_name = l.column_name) d,
             (select unnest(generate_series(0, 49)) as bin) b
        group by column_name, bin, lo, hi""")


def _point(share: float) -> str:
    """Interpolated quantile as the weighted sum of its two neighbours."""
    spot = f"(count(v) - 1) * {share}::double"
    sorted_values = "list(v order by v)"
    return (
        f"({sorted_values})[cast(floor({spot}) as bigint) + 1] * (floor({spot}) + 1 - {spot})"
        f" + ({sorted_values})[cast(ceil({spot}) as bigint) + 1] * ({spot} - floor({spot}))"
    )


@query(_histogram_sql("financials", NUMERIC, _point(0.01), _point(0.99)))
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = Staging(spark).table(financials(spark, sf_dir), "financials")
    return profile.histogram(stored, profile.numeric_columns(stored))


@query(_histogram_sql("clickstream", CLICKSTREAM_FEATURES, "min(v)", "max(v)"))
def clickstream_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    clickstream = silver.silver_clickstream(raw(spark, sf_dir, "raw_clickstream"))
    return profile.full_range_histogram(clickstream, CLICKSTREAM_FEATURES)


@query(duck(" union all ".join(
    f"select '{c}' as \"column\", {c} as category, count(*) as row_count "
    f"from {'attributes' if c == 'Occupation' else 'financials'} where {c} is not null group by {c}"
    for c in profile.COUNTED_CATEGORIES)))
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    others = [c for c in profile.COUNTED_CATEGORIES if c != "Occupation"]
    jobs = silver.silver_attributes(raw(spark, sf_dir, "raw_attributes"))
    return profile.value_counts(financials(spark, sf_dir), others).unionByName(profile.value_counts(jobs, ["Occupation"]))


@query(duck(" union all ".join(
    f"select '{a}' as column_a, '{b}' as column_b, round({'1.0' if a == b else f'corr({a}, {b})'}, 8) as r "
    "from financials" + (" having count(*) > 0" if a == b else "")
    for a in profile.CORRELATED for b in profile.CORRELATED)))
def correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.correlation(financials(spark, sf_dir)).withColumn("r", F.round("r", 8))


@query("select count(*) as row_count, 11 as column_count from lineitem")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_shape(table(spark, sf_dir, "lineitem"))


_SHARES = [0.01, 0.5, 0.99]


@query(duck(f"""
    select feature as "column", count(v) as row_count, min(v) as least, max(v) as most,
           {", ".join(f"round(quantile_cont(v, {share}), 6) as q{i}" for i, share in enumerate(_SHARES))}, true as estimates_within
    from (select {", ".join(f"cast({c} as double) as {c}" for c in NUMERIC)} from financials)
         unpivot (v for feature in ({", ".join(NUMERIC)})) group by feature"""))
def stored_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of all months from states stored month by month, one month of them written anew.

    Counts and ends come from the states alone; the exact quantiles read the table once, seeded by the states; the estimates
    are held against the ranks they promise.
    """
    staging = Staging(spark)
    root, kept = staging.path("silver"), staging.path("states")
    rows = staging.table(financials(spark, sf_dir), "financials")
    write_snapshots(rows, root, rebalance=True)
    states.refresh(spark, root, kept, NUMERIC)
    last = max(snapshots.stored_snapshots(spark, root))
    write_snapshots(snapshots.snapshot_range(rows, last, last), root, rebalance=True)
    again = states.refresh(spark, root, kept, NUMERIC)
    if again != [last]:
        raise RuntimeError(f"states of {again} were built again, not of {last} alone")

    merged = states.range_states(spark, root, kept, NUMERIC)
    names = F.array(*[F.lit(c) for c in NUMERIC])
    known = merged.select(F.element_at(names, F.col("c") + 1).alias("column"), F.col("n").alias("row_count"), "least", "most")
    exact = states.range_quantiles(spark, root, kept, NUMERIC, _SHARES, exact=True)
    near = states.range_quantiles(spark, root, kept, NUMERIC, _SHARES)

    def long(wide: DataFrame, name: str) -> DataFrame:
        return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in NUMERIC])))

    values = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in NUMERIC]
    met = lookup(snapshots.read_snapshots(spark, root).select(F.inline(F.array(*values))).filter("v is not null"), long(near, "near"), ["column"])

    def within(i: int, share: float) -> Column:
        n, slack = F.count("*"), sketches.error_of(sketches.K) * F.count("*") + 1
        return (F.count_if(F.col("v") < F.col("near")[i]) <= share * n + slack) & (F.count_if(F.col("v") <= F.col("near")[i]) >= share * n - slack)

    checked = met.groupBy("column").agg(reduce(Column.__and__, [within(i, share) for i, share in enumerate(_SHARES)]).alias("estimates_within"))
    quantiles = long(exact, "q").select("column", *[F.round(F.col("q")[i], 6).alias(f"q{i}") for i in range(len(_SHARES))])
    return known.join(quantiles, "column").join(checked, "column")
