"""Delinquency arithmetic on loan rows: missed instalments, days past due, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LARGEST_INT = 2**31 - 1
# Dates are 32-bit day numbers, and so are the days between two of them: this many months span no more days than that.
MONTHS_OF_DATES = 12 * 5_800_000


def installments_missed(overdue: Column, due: Column) -> Column:
    """Whole instalments overdue; 0 where the ratio is undefined (due is 0 or null).

    A count beyond the integers is the largest integer.
    """
    whole = F.ceil(F.try_divide(overdue, due).cast("double"))
    held = F.least(F.greatest(whole, F.lit(-LARGEST_INT)), F.lit(LARGEST_INT))
    return F.when(whole.isNotNull(), held).otherwise(0).cast("int")


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """Date of the first missed instalment; a month end clamps to the shorter month.

    Null where nothing is missed, or further back than dates go.
    """
    return F.when((missed > 0) & (missed <= MONTHS_OF_DATES), F.add_months(snapshot, -missed))


def days_past_due(overdue: Column, snapshot: Column, first_missed: Column, missed: Column) -> Column:
    """Days since the first missed date; the largest integer where that lies further back than dates go.

    Null where an amount is overdue of which no instalment is due.
    """
    days = F.when(missed > MONTHS_OF_DATES, LARGEST_INT).otherwise(F.datediff(snapshot, first_missed))
    return F.when(overdue > 0, days).otherwise(0)


def default_flag(dpd: Column, threshold: int) -> Column:
    """1 from ``threshold`` days past due on; an unknown dpd counts as 0."""
    return F.when(dpd >= threshold, 1).otherwise(0)


def loan_open_date(loan_id: Column) -> Column:
    """Open date at the end of ``CUS_0x<id>_YYYY_MM_DD``; null for any other form."""
    parts = F.split(loan_id, "_")
    text = F.concat_ws("-", *[F.get(parts, F.lit(i)) for i in (2, 3, 4)])
    return F.try_to_date(text, "yyyy-MM-dd")
