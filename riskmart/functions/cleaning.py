"""Cleaning expressions for raw text columns.

Sources are read as strings, and every conversion is a ``try_cast`` so that dirty
text becomes null under ANSI mode instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The valid payment behaviours.
PAYMENT_BEHAVIOURS = [
    "low_spent_small_value_payments",
    "low_spent_medium_value_payments",
    "low_spent_large_value_payments",
    "high_spent_small_value_payments",
    "high_spent_medium_value_payments",
    "high_spent_large_value_payments",
]

MISSING = "na"

# Text without any of these is no number in any form; a cast of it would throw inside Spark, and cost ten times as much.
_NUMBER_SIGNS = "[0-9]|(?i:nan|inf)"


def normalise_key(key: Column) -> Column:
    return F.trim(F.lower(key.cast("string")))


def as_type(text: Column, kind: str) -> Column:
    """Typed value of clean text, null where it does not parse ('23.7' is the int 23)."""
    if kind == "int":
        return text.try_cast("double").try_cast("int")
    return text.try_cast(kind)


def number_of(text: Column, kind: str) -> Column:
    """``as_type`` for a text column of which many cells may hold no number."""
    return F.when(text.rlike(_NUMBER_SIGNS), as_type(text, kind))


def clean_number(text: Column, kind: str) -> Column:
    """Number left after stripping every character but digits, '.' and '-'.

    Floats keep two decimals. Text that is still no number, such as '5-', is null.
    """
    text = text.cast("string")
    stripped = F.regexp_replace(text, r"[^0-9.\-]", "")
    # Without a digit nothing is left to parse.
    number = F.when(text.rlike("[0-9]"), as_type(stripped, kind))
    return F.round(number, 2) if kind == "float" else number


def clean_category(text: Column) -> Column:
    """Lower-cased, trimmed text; 'na' where nothing alphanumeric is in it."""
    tidy = F.trim(F.lower(text))
    return F.when(tidy.rlike("[a-zA-Z0-9]"), tidy).otherwise(MISSING)


def clean_loan_list(text: Column, drop_unspecified: bool = False) -> Column:
    """Comma list of distinct loan names in the order first seen.

    'not specified' stays an entry unless ``drop_unspecified`` is set.
    """
    unwanted = ["", "not specified"] if drop_unspecified else [""]
    items = F.split(F.regexp_replace(F.lower(text), r"\band\b", ","), ",")
    items = F.filter(F.transform(items, lambda item: F.trim(item)), lambda item: ~item.isin(unwanted))
    return F.array_join(F.array_distinct(items), ", ")


def history_months(text: Column) -> Column:
    """Months in text like '22 Years and 1 Months'; a part not found counts as 0."""

    def part(unit: str) -> Column:
        digits = F.regexp_extract(text, rf"(\d+)\s+{unit}", 1)
        return F.coalesce(F.nullif(digits, F.lit("")).try_cast("int"), F.lit(0)).cast("long")

    return (part("Years") * 12 + part("Months")).try_cast("int")


def clean_min_amount(text: Column) -> Column:
    tidy = F.trim(F.lower(text))
    return F.when(tidy.isin("yes", "no"), tidy).otherwise(MISSING)


def clean_behaviour(text: Column) -> Column:
    tidy = F.trim(F.lower(text))
    return F.when(tidy.isin(PAYMENT_BEHAVIOURS), tidy).otherwise("unknown")
