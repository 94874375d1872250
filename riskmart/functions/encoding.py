"""Ordinal encodings of the categorical columns; -1 marks an unknown value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The known occupations.
OCCUPATIONS = [
    "accountant",
    "architect",
    "developer",
    "doctor",
    "engineer",
    "entrepreneur",
    "journalist",
    "lawyer",
    "manager",
    "mechanic",
    "media_manager",
    "musician",
    "nurse",
    "scientist",
    "teacher",
    "writer",
]
UNKNOWN_OCCUPATION = "unknown"

# Ordinal codes.
CREDIT_MIX_CODES = {"bad": 0, "standard": 1, "good": 2}
MIN_AMOUNT_CODES = {"no": 0, "yes": 1}
SPENT_LEVEL_CODES = {"low_spent": 0, "high_spent": 1}
PAYMENT_SIZE_CODES = {"small_value_payments": 0, "medium_value_payments": 1, "large_value_payments": 2}


def _tidy(text: Column) -> Column:
    return F.trim(F.lower(text))


def _code(matches: list[tuple[Column, int]]) -> Column:
    return F.coalesce(*[F.when(match, F.lit(code)) for match, code in matches], F.lit(-1))


def credit_mix_code(text: Column) -> Column:
    return _code([(_tidy(text) == name, code) for name, code in CREDIT_MIX_CODES.items()])


def min_amount_code(text: Column) -> Column:
    return _code([(_tidy(text) == name, code) for name, code in MIN_AMOUNT_CODES.items()])


def spent_level_code(behaviour: Column) -> Column:
    return _code([(_tidy(behaviour).startswith(start), code) for start, code in SPENT_LEVEL_CODES.items()])


def payment_size_code(behaviour: Column) -> Column:
    return _code([(_tidy(behaviour).endswith(end), code) for end, code in PAYMENT_SIZE_CODES.items()])


def known_occupation(text: Column) -> Column:
    return F.when(_tidy(text).isin(OCCUPATIONS), _tidy(text)).otherwise(UNKNOWN_OCCUPATION)


def occupation_code(text: Column) -> Column:
    """Position of the occupation, or of 'unknown', in the alphabetical list of both."""
    pairs = []
    for position, name in enumerate(sorted([*OCCUPATIONS, UNKNOWN_OCCUPATION])):
        pairs += [F.lit(name), F.lit(position)]
    return F.create_map(*pairs)[known_occupation(text)]
