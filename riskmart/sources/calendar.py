"""The snapshot calendar: first days of months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.schemas import SNAPSHOT


def month_starts(start: Column, end: Column) -> Column:
    """First of every month from the month of ``start`` up to ``end``; null where there is none."""
    first = F.trunc(start, "MM")
    return F.when(first <= end, F.sequence(first, end, F.expr("interval 1 month")))


def snapshot_calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per snapshot between two ISO dates."""
    starts = month_starts(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(starts).alias(SNAPSHOT))
