"""Backfill of the medallion layers: one job per table over the whole date range.

Bronze is the raw text sliced by snapshot, silver is cleaned and typed, gold holds the
label store and the two feature stores. Rerunning a range replaces its snapshots and
leaves the others; a single snapshot is a range of one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.operators.features import (
    CLICKSTREAM_SNAPSHOTS,
    feature_table,
    in_snapshots,
    join_attributes,
    join_clickstream,
    pad_clickstream,
)
from riskmart.operators.loans import DPD_THRESHOLD, MONTH_ON_BOOK, add_delinquency, label_store
from riskmart.operators.profile import numeric_columns, overlap_quality, snapshot_counts
from riskmart.operators.silver import (
    silver_attributes,
    silver_clickstream,
    silver_financials,
    silver_loans_typed,
)
from riskmart.plans.states import range_quantiles, refresh
from riskmart.schemas import RAW_SCHEMAS, SNAPSHOT
from riskmart.sources.scratch import Staging
from riskmart.sources.snapshots import footer_counts, read_raw, read_snapshots, snapshot_range, stored_snapshots, write_snapshots


def silver_loans(raw: DataFrame) -> DataFrame:
    return add_delinquency(silver_loans_typed(raw))


SILVER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "loan_daily": silver_loans,
    "attributes": silver_attributes,
    "financials": silver_financials,
    "clickstream": silver_clickstream,
}
LABELS, BASELINE, FULL = "label_store", "features_baseline", "features_full"


@dataclass(frozen=True)
class Datamart:
    """Where the layers live, and the dates a run covers: all between two (both included), or only ``days`` of them."""

    spark: SparkSession
    root: str
    start: str
    end: str
    days: tuple[str, ...] | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def covers(self, day: str) -> bool:
        return self.start <= day <= self.end and (self.days is None or day in self.days)

    def within(self, df: DataFrame) -> DataFrame:
        """Rows of the snapshots that the run covers."""
        rows = snapshot_range(df, self.start, self.end)
        return rows if self.days is None else in_snapshots(rows, self.days)

    def bronze(self, table: str) -> DataFrame:
        return self.within(read_snapshots(self.spark, self.path("bronze", table), "csv", RAW_SCHEMAS[table]))

    def silver(self, table: str) -> DataFrame:
        return self.within(read_snapshots(self.spark, self.path("silver", table)))

    def gold(self, table: str) -> DataFrame:
        return self.within(read_snapshots(self.spark, self.path("gold", table)))

    def write(self, df: DataFrame, layer: str, table: str, fmt: str = "parquet", rebalance: bool = False) -> None:
        """Replace the snapshots that the run covers."""
        covered = {"span": (self.start, self.end)} if self.days is None else {"days": self.days}
        write_snapshots(df, self.path(layer, table), fmt, rebalance, **covered)


def land_bronze(mart: Datamart, raw: dict[str, DataFrame]) -> None:
    """The raw tables (all text) stored by snapshot."""
    for table, df in raw.items():
        mart.write(mart.within(dated(df, table)), "bronze", table, "csv", rebalance=True)


def dated(raw: DataFrame, table: str) -> DataFrame:
    """Raw rows with their snapshot as a date, null where it is none."""
    return raw.select(*RAW_SCHEMAS[table].names).withColumn(SNAPSHOT, F.col(SNAPSHOT).try_cast("date"))


def read_sources(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Raw CSV files by table name."""
    return {table: read_raw(spark, path, RAW_SCHEMAS[table]) for table, path in paths.items()}


def build_silver(mart: Datamart, tables: Iterable[str] = tuple(SILVER)) -> None:
    """Cleaned and typed tables; a row keeps its snapshot, so nothing is shuffled."""
    for table in tables:
        mart.write(SILVER[table](mart.bronze(table)), "silver", table)


def build_states(mart: Datamart, tables: Iterable[str] = ("financials", "clickstream")) -> dict[str, list[str]]:
    """Quantile states of the numeric columns of silver tables; names the snapshots that had to be read for them."""
    built = {}
    for table in tables:
        root = mart.path("silver", table)
        built[table] = refresh(mart.spark, root, mart.path("states", table), numeric_columns(mart.silver(table)), mart.start, mart.end)
    return built


def silver_quantiles(mart: Datamart, table: str, probabilities: list[float], by: list[str] = (), exact: bool = False) -> DataFrame:
    """Quantiles of a silver table's numeric columns over the range, from the states of its snapshots."""
    columns = numeric_columns(mart.silver(table))
    root, states = mart.path("silver", table), mart.path("states", table)
    return range_quantiles(mart.spark, root, states, columns, probabilities, mart.start, mart.end, by, exact)


def build_labels(mart: Datamart, dpd: int = DPD_THRESHOLD, mob: int = MONTH_ON_BOOK) -> None:
    mart.write(label_store(mart.silver("loan_daily"), dpd, mob), "gold", LABELS)


def build_features(
    mart: Datamart, clickstream_snapshots: Iterable[str] = CLICKSTREAM_SNAPSHOTS, exact: bool = False
) -> None:
    """The baseline store of all snapshots, and the full store of those with clickstream data.

    The joined base is written once by snapshot; bounds and rows of the baseline and the join
    of the full store all read it. The full store has bounds of its own, as clickstream rows
    may repeat a customer.
    """
    with Staging(mart.spark) as staging:
        base = staging.table(join_attributes(mart.silver("financials"), mart.silver("attributes")), "base", SNAPSHOT)
        mart.write(feature_table(base, exact), "gold", BASELINE)

        valid = [day for day in clickstream_snapshots if mart.covers(day)]
        if valid:
            joined = join_clickstream(in_snapshots(base, valid), in_snapshots(mart.silver("clickstream"), valid))
            full = staging.table(pad_clickstream(joined), "full", SNAPSHOT)
            mart.write(feature_table(full, exact), "gold", FULL)


def clickstream_overlap(mart: Datamart) -> DataFrame:
    """Share of full-store rows with clickstream data per snapshot, flagged where it is low."""
    return overlap_quality(mart.gold(FULL))


def backfill(
    mart: Datamart,
    raw: dict[str, DataFrame],
    dpd: int = DPD_THRESHOLD,
    mob: int = MONTH_ON_BOOK,
    clickstream_snapshots: Iterable[str] = CLICKSTREAM_SNAPSHOTS,
    exact: bool = False,
    states: bool = False,
) -> None:
    """Every layer of the range, from raw tables to the label and feature stores.

    ``states`` also keeps quantile states of the silver tables, so that later profiles need not read them.
    """
    land_bronze(mart, raw)
    build_silver(mart)
    if states:
        build_states(mart)
    build_labels(mart, dpd, mob)
    build_features(mart, clickstream_snapshots, exact)


def layer_counts(mart: Datamart) -> DataFrame:
    """Rows per stored table and snapshot of all three layers; those of silver and gold come from file footers."""
    counts = [(f"bronze/{t}", snapshot_counts(mart.bronze(t))) for t in SILVER]
    stored = [("silver", t) for t in SILVER]
    stored += [("gold", t) for t in (LABELS, BASELINE, FULL) if stored_snapshots(mart.spark, mart.path("gold", t))]
    counts += [(f"{layer}/{t}", mart.within(footer_counts(mart.spark, mart.path(layer, t), mart.start, mart.end))) for layer, t in stored]
    return reduce(DataFrame.unionByName, [df.withColumn("table", F.lit(name)) for name, df in counts])


def unreadable_dates(raw: dict[str, DataFrame]) -> DataFrame:
    """Rows of each raw table that no layer holds, as their date is not one."""
    lost = F.count_if(F.col(SNAPSHOT).try_cast("date").isNull())
    return reduce(DataFrame.unionByName, [df.agg(lost.alias("row_count")).withColumn("table", F.lit(t)) for t, df in raw.items()])
