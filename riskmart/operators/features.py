"""Feature tables: joins within a snapshot, repairs, clamping, encoding and ratios."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.functions import encoding
from riskmart.operators.joins import lookup, skew_join
from riskmart.operators.quantiles import approx_quantiles, exact_quantiles
from riskmart.schemas import CLICKSTREAM_FEATURES, KEYS, SNAPSHOT

# Counts that cannot be negative, columns that are clamped, raw categories
# that their encoding replaces.
COUNT_COLUMNS = [
    "Num_of_Loan",
    "Num_of_Delayed_Payment",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_Credit_Inquiries",
    "Delay_from_due_date",
    "Credit_History_Age",
]
LOWEST_LIMIT_CHANGE = -50
CLAMP_COLUMNS = [
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
    "Outstanding_Debt",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
    "Changed_Credit_Limit",
    "Credit_History_Age",
]
CLAMP_SHARES = [0.01, 0.99]
ENCODED_CATEGORIES = ["Type_of_Loan", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour", "Occupation"]

# The 18 months with usable clickstream data.
CLICKSTREAM_SNAPSHOTS = [
    *[f"2023-{month:02d}-01" for month in range(1, 13)],
    *[f"2024-{month:02d}-01" for month in range(1, 7)],
]


def join_attributes(financials: DataFrame, attributes: DataFrame) -> DataFrame:
    """Financials with the attributes of the same customer and snapshot, where there are any."""
    return skew_join(financials, attributes, KEYS, "left")


def join_clickstream(base: DataFrame, clickstream: DataFrame) -> DataFrame:
    return skew_join(base, clickstream, KEYS, "left")


def in_snapshots(df: DataFrame, snapshots: Iterable[str] = CLICKSTREAM_SNAPSHOTS) -> DataFrame:
    """Rows of the listed snapshots; a partition filter on a stored table."""
    return df.filter(F.col(SNAPSHOT).isin([F.lit(day).cast("date") for day in snapshots]))


def pad_clickstream(df: DataFrame) -> DataFrame:
    """All clickstream features as doubles, null where the table lacks the column."""
    present = set(df.columns)
    return df.withColumns(
        {c: (F.col(c) if c in present else F.lit(None)).cast("double") for c in CLICKSTREAM_FEATURES}
    )


def fix_negatives(df: DataFrame) -> DataFrame:
    """Impossible negatives as nulls; a limit change may be negative down to -50."""
    floors = dict.fromkeys(COUNT_COLUMNS, 0) | {"Changed_Credit_Limit": LOWEST_LIMIT_CHANGE}
    return df.withColumns(
        {c: F.when(F.col(c) >= floor, F.col(c).cast("double")) for c, floor in floors.items() if c in df.columns}
    )


def clamp_bounds(
    df: DataFrame, columns: list[str] = CLAMP_COLUMNS, by: list[str] = (SNAPSHOT,), exact: bool = False
) -> DataFrame:
    """P1 and P99 of each column per group, all columns in one aggregate."""
    if exact:
        return exact_quantiles(df, columns, CLAMP_SHARES, by, interpolate=False)
    return approx_quantiles(df, columns, CLAMP_SHARES, by)


def clamp_outliers(
    df: DataFrame, columns: list[str] = CLAMP_COLUMNS, by: list[str] = (SNAPSHOT,), exact: bool = False
) -> DataFrame:
    """Columns limited to the P1..P99 range of their own group; nulls stay null."""
    columns = [c for c in columns if c in df.columns]
    by = list(by)
    bounds = clamp_bounds(df, columns, by, exact)
    renamed = bounds.select(*by, *[F.col(c).alias(f"{c}_bounds") for c in columns])
    rows = lookup(df, renamed, by)

    def limited(name: str) -> Column:
        value, low, high = F.col(name).cast("double"), F.col(f"{name}_bounds")[0], F.col(f"{name}_bounds")[1]
        return F.when(value < low, low).when(value > high, high).otherwise(value)

    return rows.select(*[limited(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def encode_categories(df: DataFrame) -> DataFrame:
    behaviour = F.col("Payment_Behaviour")
    return df.withColumns(
        {
            "Credit_Mix_encoded": encoding.credit_mix_code(F.col("Credit_Mix")),
            "Payment_of_Min_Amount_encoded": encoding.min_amount_code(F.col("Payment_of_Min_Amount")),
            "pb_spent_level": encoding.spent_level_code(behaviour),
            "pb_payment_size": encoding.payment_size_code(behaviour),
            "Occupation_encoded": encoding.occupation_code(F.col("Occupation")),
        }
    )


def add_ratios(df: DataFrame) -> DataFrame:
    """Burden, stress and surplus features; a ratio is null unless its denominator is positive."""

    def ratio(top: str, bottom: str) -> Column:
        return F.when(F.col(bottom) > 0, F.round(F.try_divide(F.col(top), F.col(bottom)), 4))

    surplus = F.col("Monthly_Inhand_Salary") - F.col("Total_EMI_per_month")
    return df.withColumns(
        {
            "debt_to_income": ratio("Outstanding_Debt", "Annual_Income"),
            "emi_to_salary": ratio("Total_EMI_per_month", "Monthly_Inhand_Salary"),
            "savings_rate": ratio("Amount_invested_monthly", "Monthly_Inhand_Salary"),
            "payment_stress": (F.col("Delay_from_due_date") * F.col("Num_of_Delayed_Payment")).cast("double"),
            "loans_per_credit_card": ratio("Num_of_Loan", "Num_Credit_Card"),
            "monthly_surplus": F.round(surplus, 2).cast("double"),
        }
    )


def drop_encoded(df: DataFrame) -> DataFrame:
    return df.drop(*ENCODED_CATEGORIES)


def feature_table(base: DataFrame, exact: bool = False) -> DataFrame:
    """Model-ready features of a joined base: repaired, clamped per snapshot, encoded, with ratios.

    ``base`` is read twice, for the bounds and for the rows, so pass a stored table.
    """
    df = clamp_outliers(fix_negatives(base), exact=exact)
    return df.transform(encode_categories).transform(add_ratios).transform(drop_encoded)
