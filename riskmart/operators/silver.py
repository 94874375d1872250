"""Silver typing: every column cleaned and cast in one projection per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions.cleaning import (
    as_type,
    clean_behaviour,
    clean_category,
    clean_loan_list,
    clean_min_amount,
    clean_number,
    history_months,
    normalise_key,
    number_of,
)
from riskmart.schemas import (
    ATTRIBUTE_TYPES,
    CLICKSTREAM_FEATURES,
    CUSTOMER,
    FINANCIAL_TYPES,
    LOAN_TYPES,
    PII,
    SNAPSHOT,
)


def enforce_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The columns named in ``types`` cast where present, the others as they are."""
    held = dict(df.dtypes)

    def typed(name: str) -> Column:
        parse = number_of if held[name] == "string" and types[name] in ("int", "float", "double") else as_type
        return parse(F.col(name), types[name])

    return df.select(*[typed(c).alias(c) if c in types else F.col(c) for c in df.columns])


def normalise_customer(df: DataFrame) -> DataFrame:
    return df.withColumn(CUSTOMER, normalise_key(F.col(CUSTOMER)))


def drop_identity(df: DataFrame) -> DataFrame:
    return df.drop(*PII)


def clean_numbers(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Int and float columns stripped of stray characters and typed; doubles are not text to strip."""
    numeric = {c: kind for c, kind in types.items() if kind in ("int", "float") and c in df.columns}
    return df.withColumns({c: clean_number(F.col(c), kind) for c, kind in numeric.items()})


def clean_categories(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns but the customer key lower-cased, trimmed, and 'na' where empty."""
    text = [c for c, kind in types.items() if kind == "string" and c != CUSTOMER and c in df.columns]
    return df.withColumns({c: clean_category(F.col(c)) for c in text})


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn(SNAPSHOT, F.col(SNAPSHOT).try_cast("date"))


def silver_loans_typed(raw: DataFrame) -> DataFrame:
    return normalise_customer(enforce_types(raw, LOAN_TYPES))


def silver_attributes(raw: DataFrame) -> DataFrame:
    df = _dated(normalise_customer(drop_identity(raw)))
    df = clean_categories(clean_numbers(df, ATTRIBUTE_TYPES), ATTRIBUTE_TYPES)
    return df.select(*ATTRIBUTE_TYPES, SNAPSHOT)


def silver_financials(raw: DataFrame, drop_unspecified: bool = False) -> DataFrame:
    """``drop_unspecified`` also drops 'not specified' from the loan list."""
    df = _dated(normalise_customer(raw))
    df = clean_categories(clean_numbers(df, FINANCIAL_TYPES), FINANCIAL_TYPES)
    df = df.withColumns(
        {
            "Type_of_Loan": clean_loan_list(F.col("Type_of_Loan"), drop_unspecified),
            "Credit_History_Age": history_months(F.col("Credit_History_Age")).cast("double"),
            "Payment_of_Min_Amount": clean_min_amount(F.col("Payment_of_Min_Amount")),
            "Payment_Behaviour": clean_behaviour(F.col("Payment_Behaviour")),
        }
    )
    return df.select(*FINANCIAL_TYPES, SNAPSHOT)


def silver_clickstream(raw: DataFrame) -> DataFrame:
    """Feature columns cast as they are: dirty text becomes null rather than being stripped."""
    df = _dated(normalise_customer(raw))
    return enforce_types(df, dict.fromkeys(CLICKSTREAM_FEATURES, "float")).select(
        CUSTOMER, *CLICKSTREAM_FEATURES, SNAPSHOT
    )
