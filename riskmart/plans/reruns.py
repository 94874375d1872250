"""Reruns that rebuild only the snapshots whose input changed.

Beside each stored table lies a record: for each snapshot, what it was built from and the files that it was built into. A
snapshot of raw rows is known by an order-free fingerprint of its rows, one of a stored table by the names and lengths of
its files, which listings give. A record counts only while both still hold, so a snapshot that was
rewritten by others, or whose record was never written, is built again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators.features import CLICKSTREAM_SNAPSHOTS
from riskmart.operators.loans import DPD_THRESHOLD, MONTH_ON_BOOK
from riskmart.plans.backfill import (
    BASELINE,
    FULL,
    LABELS,
    Datamart,
    build_features,
    build_labels,
    build_silver,
    dated,
    land_bronze,
)
from riskmart.plans.states import file_marks
from riskmart.schemas import SNAPSHOT
from riskmart.sources.snapshots import read_snapshots, remove_snapshots, stored_snapshots, write_snapshots

RECORDS = "records"


def fingerprints(df: DataFrame) -> DataFrame:
    """``print`` of each snapshot: the number of its rows, and the sum and the exclusive or of their 64-bit hashes.

    One aggregate. Neither the order of rows nor how they lie in files matters; a repeated row, a null and an empty cell do.
    """
    cells = [part for c in df.columns if c != SNAPSHOT for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    # A sum of 64-bit hashes leaves 64 bits.
    hashed = df.select(SNAPSHOT, F.xxhash64(F.lit(1), *cells).alias("a"), F.xxhash64(F.lit(2), *cells).alias("b"))
    parts = [F.count("*"), F.sum(F.col("a").cast("decimal(20,0)")), F.bit_xor("b")]
    return hashed.groupBy(SNAPSHOT).agg(F.concat_ws(" ", *[p.cast("string") for p in parts]).alias("print"))


def stale(mart: Datamart, layer: str, table: str, inputs: dict[str, str]) -> list[str]:
    """Snapshots of the run that are not stored as they would be built from ``inputs`` (by day)."""
    spark, records = mart.spark, mart.path(RECORDS, f"{layer}/{table}")
    stored = file_marks(spark, mart.path(layer, table), mart.start, mart.end)
    known = {}
    if stored_snapshots(spark, records):
        # One row for each snapshot.
        known = {str(r[SNAPSHOT]): (r.inputs, r.files) for r in read_snapshots(spark, records, start=mart.start, end=mart.end).collect()}
    return sorted(day for day in {*inputs, *stored} if known.get(day) != (inputs.get(day), stored.get(day)))


def record(mart: Datamart, layer: str, table: str, inputs: dict[str, str], days: Iterable[str]) -> None:
    """Note what ``days`` were built from; a day whose input gave no row has no files."""
    stored = file_marks(mart.spark, mart.path(layer, table), mart.start, mart.end)
    rows = [(inputs.get(day), stored.get(day), day) for day in days]
    if rows:
        noted = mart.spark.createDataFrame(rows, f"inputs string, files string, {SNAPSHOT} string")
        noted = noted.withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date"))
        write_snapshots(noted.coalesce(1), mart.path(RECORDS, f"{layer}/{table}"))


def refill(
    mart: Datamart,
    raw: dict[str, DataFrame],
    dpd: int = DPD_THRESHOLD,
    mob: int = MONTH_ON_BOOK,
    clickstream_snapshots: Iterable[str] = CLICKSTREAM_SNAPSHOTS,
    exact: bool = False,
    rules: str = "",
) -> dict[str, list[str]]:
    """``backfill`` of the snapshots whose input changed since they were built, with all that depends on them.

    Returns the snapshots that were built again or removed, by layer and table. The raw tables are read once for their
    fingerprints, and again only where a snapshot changed. ``rules`` names the version of the caller's code: another
    name builds all again. Without financials the feature stores, and without loans the labels, are left alone.
    """
    spark, rebuilt = mart.spark, {}
    valid = list(clickstream_snapshots)

    def marks(layer: str, table: str) -> dict[str, str]:
        return file_marks(spark, mart.path(layer, table), mart.start, mart.end)

    def build(layer: str, wanted: dict[str, dict[str, str]], builder: Callable[[Datamart], None]) -> None:
        """Bring the tables of ``wanted``, inputs by table and day, up to date by one call of the builder."""
        wanted = {table: {day: f"{rules} {mark}" for day, mark in inputs.items()} for table, inputs in wanted.items()}
        changed = {table: stale(mart, layer, table, inputs) for table, inputs in wanted.items()}
        for table, days in changed.items():
            remove_snapshots(spark, mart.path(layer, table), [day for day in days if day not in wanted[table]])
        days = sorted({day for table, found in changed.items() for day in found if day in wanted[table]})
        if days:
            builder(replace(mart, days=tuple(days)))
        for table, inputs in wanted.items():
            # Another table's days may have built this one's again.
            again = {*changed[table], *(day for day in days if day in inputs)}
            record(mart, layer, table, inputs, sorted(again))
            rebuilt[f"{layer}/{table}"] = sorted(again)

    for table, df in raw.items():
        # One row for each snapshot.
        prints = {str(r[SNAPSHOT]): r["print"] for r in fingerprints(mart.within(dated(df, table))).collect()}
        build("bronze", {table: prints}, lambda part: land_bronze(part, {table: df}))
        build("silver", {table: marks("bronze", table)}, lambda part: build_silver(part, [table]))
    if "loan_daily" in raw:
        inputs = {day: f"{mark} {dpd} {mob}" for day, mark in marks("silver", "loan_daily").items()}
        build("gold", {LABELS: inputs}, lambda part: build_labels(part, dpd, mob))
    if "financials" in raw:
        attributes, clicks = marks("silver", "attributes"), marks("silver", "clickstream")
        base = {day: f"{mark} {attributes.get(day)} {exact}" for day, mark in marks("silver", "financials").items()}
        full = {day: f"{mark} {clicks.get(day)}" for day, mark in base.items() if day in valid}
        build("gold", {BASELINE: base, FULL: full}, lambda part: build_features(part, valid, exact))
    return rebuilt
