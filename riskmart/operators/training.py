"""From feature and label stores to a checked, chronologically split training set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.operators.joins import skew_join
from riskmart.operators.loans import label_observations
from riskmart.schemas import CUSTOMER, SNAPSHOT

# Columns that identify or date a row, or are the answer.
NOT_FEATURES = [CUSTOMER, "loan_id", SNAPSHOT, "label", "label_def", "loan_open_date", "label_obs_date"]


def training_set(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features as of the day a loan was opened, with the label observed on it later."""
    observed = label_observations(labels).withColumn(SNAPSHOT, F.col("loan_open_date"))
    return skew_join(features, observed, [CUSTOMER, SNAPSHOT], "inner").select(
        *features.columns, "loan_open_date", "label_obs_date", "label"
    )


def chronological_split(df: DataFrame, train_end: str, column: str = "label_obs_date") -> tuple[DataFrame, DataFrame]:
    """Rows up to and on ``train_end``, and the rows after it."""
    end = F.lit(train_end).cast("date")
    return df.filter(F.col(column) <= end), df.filter(F.col(column) > end)


def feature_columns(df: DataFrame) -> list[str]:
    names = [c for c in df.columns if c not in NOT_FEATURES]
    text = [c for c in names if not isinstance(df.schema[c].dataType, T.NumericType)]
    if text:
        raise TypeError(f"feature columns must be numbers: {text}")
    return names


def columns_with_values(df: DataFrame, names: list[str]) -> list[str]:
    """The columns that hold a number in any row."""
    def number(name: str):
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value), value)

    known = df.agg(*[F.count(number(c)).alias(c) for c in names]).first()
    return [c for c in names if known[c]]


def check_split(df: DataFrame, train_end: str) -> tuple[int, int]:
    """(train, test) row counts in one pass; raises where the join or the test set is empty."""
    late = F.col("label_obs_date") > F.lit(train_end).cast("date")
    total, test = df.agg(F.count("*"), F.count_if(late)).first()
    if total == 0:
        raise ValueError("no feature row matches a label: check customer keys and loan open dates")
    if test == 0:
        raise ValueError(f"no label was observed after {train_end}: choose an earlier train end")
    return total - test, test
