"""Reading and writing tables that are partitioned by snapshot date.

A write first puts its rows into a folder beside the snapshots, then notes in a journal which snapshots it replaces and removes,
then moves the folders. Until the journal is there the table is as before, from then on it is as after: readers take a snapshot
that is not moved yet from where it waits, and the next write to the table first ends the moves, or removes
rows that never got a journal. A table has one writer at a time.
"""

from __future__ import annotations

import csv
import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.schemas import SNAPSHOT
from riskmart.sources.scratch import compiled, delete_path, hadoop_path

# Text cells keep their blanks on the way out as on the way in; an empty cell is null.
CSV_OPTIONS = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

_PREFIX = f"{SNAPSHOT}="
# Names that no reader of the table opens.
_PENDING, _JOURNAL = "_pending", "_journal"


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Raw CSV with a header, every column as text, columns matched by header name."""
    parts = []
    for names, files in _files_by_header(spark, path).items():
        absent = [name for name in schema.names if name not in names]
        if absent:
            raise ValueError(f"{files[0]} lacks the columns {absent}")
        text = T.StructType([T.StructField(name, T.StringType()) for name in names])
        # Headers are checked against the columns, so a file that changed meanwhile is an error.
        parts.append(spark.read.options(**CSV_OPTIONS, enforceSchema=False).schema(text).csv(files).select(schema.names))
    if not parts:
        raise ValueError(f"{path} holds no file with a header")
    return reduce(DataFrame.unionByName, parts)


def _files_by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files under ``path`` by the names in their first line; files without one are left out.

    Reads one line of each file.
    """
    system, location = hadoop_path(spark, path)
    found: dict[tuple[str, ...], list[str]] = {}
    files = system.globStatus(location) or []
    if len(files) == 1 and files[0].isDirectory():
        files = system.listStatus(files[0].getPath())
    for status in files:
        name = status.getPath().getName()
        if status.isDirectory() or name.startswith(("_", ".")):
            continue
        codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
        stream = system.open(status.getPath())
        packed = codec.getCodec(status.getPath())
        reader = spark._jvm.java.io.BufferedReader(
            spark._jvm.java.io.InputStreamReader(packed.createInputStream(stream) if packed else stream, "UTF-8")
        )
        line = reader.readLine()
        reader.close()
        if line is not None:
            names = tuple(next(csv.reader([line.removeprefix("﻿")])))
            found.setdefault(names, []).append(status.getPath().toString())
    return found


def snapshot_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of the snapshots between two ISO dates, both included; ``None`` leaves a side open."""
    day = F.col(SNAPSHOT)
    if dict(df.dtypes)[SNAPSHOT] != "date":
        day = day.try_cast("date")
    if start is not None:
        df = df.filter(day >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(day <= F.lit(end).cast("date"))
    return df


def stored_snapshots(spark: SparkSession, root: str) -> dict[str, str]:
    """Path of each stored snapshot by its ISO date, from the folder names alone."""
    root = root.rstrip("/")
    journal = _journal(spark, root)
    waiting = journal.waiting(spark, root)
    paths = {name: path for name, path in _folders(spark, root).items() if name not in journal.removed} | waiting
    return {name.removeprefix(_PREFIX): path for name, path in paths.items()}


@dataclass(frozen=True)
class _Journal:
    """Folder names that a write replaces from ``pending``, and those that it removes."""

    pending: str = ""
    replaced: list[str] = field(default_factory=list)
    removed: list[str] = field(default_factory=list)

    def waiting(self, spark: SparkSession, root: str) -> dict[str, str]:
        """Path of each new folder that is not moved yet."""
        return _folders(spark, f"{root}/{self.pending}") if self.replaced else {}


def _folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Path of each snapshot folder by its name."""
    system, location = hadoop_path(spark, root)
    if not system.exists(location):
        return {}
    paths = [status.getPath() for status in system.listStatus(location)]
    return {p.getName(): p.toString() for p in paths if p.getName().startswith(_PREFIX)}


def _journal(spark: SparkSession, root: str) -> _Journal:
    system, location = hadoop_path(spark, f"{root}/{_JOURNAL}")
    if not system.exists(location):
        return _Journal()
    stream = system.open(location)
    try:
        return _Journal(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _note(spark: SparkSession, root: str, journal: _Journal) -> None:
    """Write the journal under another name and rename it, so that it is there whole or not at all."""
    system, draft = hadoop_path(spark, f"{root}/{journal.pending}/{_JOURNAL}")
    stream = system.create(draft, True)
    stream.writeBytes(json.dumps(asdict(journal)))
    stream.close()
    _move(spark, draft.toString(), f"{root}/{_JOURNAL}")


def _move(spark: SparkSession, source: str, target: str) -> None:
    system, old = hadoop_path(spark, source)
    if not system.rename(old, hadoop_path(spark, target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def settle_writes(spark: SparkSession, root: str, keep: str | None = None) -> None:
    """End the moves of a write that stopped after its journal, and remove the rows of one that stopped before.

    ``keep`` is the folder of a write under way.
    """
    root = root.rstrip("/")
    journal = _journal(spark, root)
    # A folder that waits no more was moved; one that still waits replaces whatever is in its place.
    for name, path in journal.waiting(spark, root).items():
        delete_path(spark, f"{root}/{name}")
        _move(spark, path, f"{root}/{name}")
    for name in journal.removed:
        delete_path(spark, f"{root}/{name}")
    delete_path(spark, f"{root}/{_JOURNAL}")
    if keep is None:
        delete_path(spark, f"{root}/{_PENDING}")
        return
    system, location = hadoop_path(spark, f"{root}/{_PENDING}")
    for status in system.listStatus(location) if system.exists(location) else []:
        if f"{_PENDING}/{status.getPath().getName()}" != keep:
            delete_path(spark, status.getPath().toString())


def write_snapshots(
    df: DataFrame,
    root: str,
    fmt: str = "parquet",
    rebalance: bool = False,
    span: tuple[str, str] | None = None,
    days: Iterable[str] = (),
) -> None:
    """Replace exactly the snapshots in ``df``; the others under ``root`` stay as they are.

    ``rebalance`` is for rows that are not yet grouped by snapshot (a raw file, the output
    of a join): one shuffle on the snapshot, in which adaptive execution splits large
    snapshots over many files and merges small ones. Rows read from a snapshot table are
    grouped already and are written without a shuffle.

    ``span`` names the (start, end) a rerun covers, ``days`` single snapshots: a stored snapshot among them that has no
    rows any more is removed, so the rerun leaves what a first run would have left.

    All of it takes effect at once, also if the write stops midway (see the top of this module).
    """
    spark = df.sparkSession
    root = root.rstrip("/")
    days = set(days)
    covered = {day for day in stored_snapshots(spark, root) if day in days or (span is not None and in_span(day, *span))}
    pending = f"{_PENDING}/{uuid.uuid4().hex}"
    grouped = df.hint("rebalance", SNAPSHOT) if rebalance else df
    writer = grouped.write.partitionBy(SNAPSHOT)
    if fmt == "csv":
        # Text is by far the largest of the layers; a large snapshot has several files, so packed ones are still read in parallel.
        writer = writer.options(**CSV_OPTIONS, compression="gzip")
    with compiled(spark):
        writer.format(fmt).save(f"{root}/{pending}")
    _commit(spark, root, pending, covered)


def remove_snapshots(spark: SparkSession, root: str, days: Iterable[str]) -> None:
    """Remove single stored snapshots, all at once."""
    root = root.rstrip("/")
    covered = set(days) & stored_snapshots(spark, root).keys()
    if covered:
        _commit(spark, root, f"{_PENDING}/{uuid.uuid4().hex}", covered)


def _commit(spark: SparkSession, root: str, pending: str, covered: set[str]) -> None:
    """Put the folders in ``pending`` into their places, and remove those of ``covered`` that it lacks."""
    # An earlier write is settled only now, as the rows may have been read from where it left them.
    settle_writes(spark, root, keep=pending)
    replaced = sorted(_folders(spark, f"{root}/{pending}"))
    removed = sorted({f"{_PREFIX}{day}" for day in covered} - set(replaced))
    _note(spark, root, _Journal(pending, replaced, removed))
    settle_writes(spark, root)


def in_span(day: str, start: str | None = None, end: str | None = None) -> bool:
    """Whether a folder's ISO date lies between two others, both included; ``None`` leaves a side open."""
    try:
        found = date.fromisoformat(day)
    except ValueError:
        return False
    return (start is None or date.fromisoformat(start) <= found) and (end is None or found <= date.fromisoformat(end))


def read_snapshots(
    spark: SparkSession,
    root: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """The stored snapshots between two ISO dates as one table; other folders are not opened.

    Parquet may bring its own ``schema``. The snapshot column is a date either way.
    """
    root = root.rstrip("/")
    journal = _journal(spark, root)
    waiting = journal.waiting(spark, root)
    hidden = {*waiting, *journal.removed}
    sources = [path for path, names in ((root, _folders(spark, root).keys() - hidden), (f"{root}/{journal.pending}", waiting)) if names]
    if not sources:
        raise FileNotFoundError(f"no snapshots under {root}")
    reader = spark.read.format(fmt)
    if schema is not None:
        fields = [f for f in schema.fields if f.name != SNAPSHOT]
        reader = reader.schema(T.StructType([*fields, T.StructField(SNAPSHOT, T.DateType())]))
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    parts = [reader.load(path).withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("date")) for path in sources]
    if hidden and sources[0] == root:
        name = F.concat(F.lit(_PREFIX), F.coalesce(F.col(SNAPSHOT).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")))
        parts[0] = parts[0].filter(~name.isin(sorted(hidden)))
    return snapshot_range(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), start, end)


def footer_counts(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of each stored Parquet snapshot (``row_count``), from the footers of its files: no column is read."""
    # One row for each snapshot.
    return spark.createDataFrame(footer_plan(spark, root, start, end).collect(), f"{SNAPSHOT} date, row_count long")


def footer_plan(spark: SparkSession, root: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The counts as a plan in a session of its own, as only the newer form of the Parquet reader takes the aggregate."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return read_snapshots(session, root, start=start, end=end).groupBy(SNAPSHOT).agg(F.count("*").alias("row_count"))


def write_result(df: DataFrame, path: str) -> None:
    """A small result table (coefficients, metrics) as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
