"""Quantile states kept beside stored tables, one set for each snapshot.

A set names the files it was built from and counts only while its snapshot consists of those files, so a rewritten or removed
snapshot, or a crash between the two writes, never leaves a state that is believed. ``refresh`` reads the snapshots
that changed and no others. Quantiles over any range merge sets: estimates without reading a row of the table,
exact ones with one read of it instead of two.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.operators.quantiles import exact_quantiles
from riskmart.operators.sketches import K, column_states, estimated_quantiles, merged_states
from riskmart.schemas import SNAPSHOT
from riskmart.sources.scratch import hadoop_path
from riskmart.sources.snapshots import in_span, read_snapshots, stored_snapshots, write_snapshots

MARK = "files"


def file_marks(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> dict[str, str]:
    """A digest of the names and lengths of the files of each snapshot, from folder listings alone."""
    marks = {}
    for day, path in stored_snapshots(spark, root).items():
        if in_span(day, start, end):
            system, location = hadoop_path(spark, path)
            files = sorted(f"{s.getPath().getName()}:{s.getLen()}" for s in system.listStatus(location))
            marks[day] = hashlib.md5("\n".join(files).encode()).hexdigest()
    return marks


def refresh(
    spark: SparkSession, root: str, states: str, columns: list[str], start: str | None = None, end: str | None = None, k: int = K
) -> list[str]:
    """Build the states at ``states`` of those snapshots of the table at ``root`` that have none or other files, and name these.

    A set is by column name, so one that lacks a column is built again with all of ``columns``.
    """
    now = file_marks(spark, root, start, end)
    known = {}
    if stored_snapshots(spark, states):
        # One row for each snapshot.
        held = read_snapshots(spark, states, start=start, end=end).groupBy(F.col(SNAPSHOT).cast("string").alias("day"))
        known = {r.day: r for r in held.agg(F.max(MARK).alias(MARK), F.max("columns").alias("columns")).collect()}
    changed = sorted(d for d, mark in now.items() if d not in known or known[d][MARK] != mark or not set(columns) <= set(known[d]["columns"]))
    if changed:
        mark = reduce(lambda rest, day: rest.when(F.col(SNAPSHOT) == day, now[day]), changed[1:], F.when(F.col(SNAPSHOT) == changed[0], now[changed[0]]))
        rows = read_snapshots(spark, root).filter(F.col(SNAPSHOT).isin([F.lit(day).cast("date") for day in changed]))
        names = F.array(*[F.lit(c) for c in columns])
        sets = column_states(rows, columns, [SNAPSHOT], k, keep_empty=True)
        sets = sets.select(F.element_at(names, F.col("c") + 1).alias("column"), *[c for c in sets.columns if c not in ("c", SNAPSHOT)], mark.alias(MARK),
                           names.alias("columns"), SNAPSHOT)
        # A few rows for each snapshot.
        write_snapshots(sets.coalesce(1), states)
    return changed


def range_states(
    spark: SparkSession, root: str, states: str, columns: list[str], start: str | None = None, end: str | None = None, by: list[str] = ()
) -> DataFrame:
    """Merged states of ``columns`` over the snapshots between two dates, all of them or by ``by`` (the snapshot).

    An error names the snapshots whose states are absent or of other files; ``refresh`` mends that.
    """
    now = file_marks(spark, root, start, end)
    sets = read_snapshots(spark, states, start=start, end=end)
    current = sets.filter(F.concat_ws(" ", F.col(SNAPSHOT).cast("string"), MARK).isin([f"{day} {mark}" for day, mark in now.items()]))
    current = current.filter(F.col("column").isin(columns))
    counted = current.groupBy(F.col(SNAPSHOT).cast("string").alias("day")).agg(F.count_distinct("column").alias("n"))
    whole = {r.day for r in counted.filter(F.col("n") == len(set(columns))).collect()}
    if set(now) - whole:
        raise ValueError(f"no current states of {columns} for {sorted(set(now) - whole)}")
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column")) - 1
    return merged_states(current.withColumn("c", place.cast("int")), by).filter("n > 0")


def range_quantiles(
    spark: SparkSession,
    root: str,
    states: str,
    columns: list[str],
    probabilities: list[float],
    start: str | None = None,
    end: str | None = None,
    by: list[str] = (),
    exact: bool = False,
    interpolate: bool = True,
) -> DataFrame:
    """Quantiles over the snapshots between two dates, from their states.

    Estimates lie within the sketch's rank error and read no row. ``exact`` reads the table once, for the
    values near the ranks that the states point at.
    """
    merged = range_states(spark, root, states, columns, start, end, by)
    if not exact:
        return estimated_quantiles(merged, columns, probabilities, by)
    return exact_quantiles(read_snapshots(spark, root, start=start, end=end), columns, probabilities, by, interpolate, states=merged)
