"""Loan rows: delinquency, the label store, and the cuts analysts take of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.functions.delinquency import (
    days_past_due,
    default_flag,
    first_missed_date,
    installments_missed,
    loan_open_date,
)
from riskmart.schemas import CUSTOMER, SNAPSHOT

DPD_THRESHOLD = 30
MONTH_ON_BOOK = 6


def add_delinquency(loans: DataFrame) -> DataFrame:
    """Month on book, missed instalments, first missed date and days past due of typed loans.

    Every null number becomes 0 once the instalments are known, before dates are derived.
    """
    df = loans.withColumns(
        {
            "mob": F.col("installment_num").cast("int"),
            "installments_missed": installments_missed(F.col("overdue_amt"), F.col("due_amt")),
        }
    ).fillna(0)
    df = df.withColumn("first_missed_date", first_missed_date(F.col(SNAPSHOT), F.col("installments_missed")))
    days = days_past_due(
        F.col("overdue_amt"), F.col(SNAPSHOT), F.col("first_missed_date"), F.col("installments_missed")
    )
    return df.withColumn("dpd", days)


def at_month_on_book(loans: DataFrame, mob: int = MONTH_ON_BOOK) -> DataFrame:
    return loans.filter(F.col("mob") == mob)


def label_store(loans: DataFrame, dpd: int = DPD_THRESHOLD, mob: int = MONTH_ON_BOOK) -> DataFrame:
    """One label per loan at ``mob``: 1 from ``dpd`` days past due on."""
    return at_month_on_book(loans, mob).select(
        "loan_id",
        CUSTOMER,
        default_flag(F.col("dpd"), dpd).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"),
        SNAPSHOT,
    )


def started_before(loans: DataFrame, day: str = "2024-01-01") -> DataFrame:
    """Loans that started before ``day`` and so have run their course."""
    return loans.filter(F.col("loan_start_date") < F.lit(day).cast("date"))


def at_installment(loans: DataFrame, number: int = 10) -> DataFrame:
    """The terminal observation of each loan."""
    return loans.filter(F.col("installment_num") == number)


def flag_delinquent(loans: DataFrame, dpd: int = DPD_THRESHOLD) -> DataFrame:
    return loans.withColumn("dpd_flag", default_flag(F.col("dpd"), dpd))


def bad_rate_by_mob(loans: DataFrame, dpd: int = DPD_THRESHOLD) -> DataFrame:
    """Share of delinquent rows per month on book, in that order."""
    flagged = flag_delinquent(loans, dpd)
    return flagged.groupBy("mob").agg(F.avg("dpd_flag").alias("bad_rate")).orderBy("mob")


def label_observations(labels: DataFrame) -> DataFrame:
    """Labels keyed by the date their loan was opened, with the date they were observed."""
    return labels.select(
        CUSTOMER,
        loan_open_date(F.col("loan_id")).alias("loan_open_date"),
        F.col(SNAPSHOT).alias("label_obs_date"),
        "label",
    )
