from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskmart.operators import features, profile, silver
from riskmart.plans.backfill import silver_loans
from riskmart.operators.loans import bad_rate_by_mob, label_store
from riskmart.schemas import CLICKSTREAM_FEATURES, RAW_LOANS

DAY = date(2023, 1, 1)


def test_fix_negatives(spark):
    df = spark.createDataFrame([(-1, -50.0), (3, -50.01), (None, None), (0, 4.0)], "Num_of_Loan int, Changed_Credit_Limit float")
    have = [tuple(r) for r in features.fix_negatives(df).collect()]
    assert have == [(None, -50.0), (3.0, None), (None, None), (0.0, 4.0)]
    assert features.fix_negatives(spark.range(1)).columns == ["id"]


@pytest.mark.parametrize("exact", [False, True])
def test_clamp_leaves_an_all_null_column_and_nulls_alone(spark, exact):
    df = spark.range(200).select(
        F.lit(DAY).alias("snapshot_date"),
        F.when(F.col("id") > 0, F.col("id")).alias("Annual_Income"),
        F.lit(None).cast("float").alias("Outstanding_Debt"),
    )
    rows = features.clamp_outliers(df, exact=exact).collect()
    assert len(rows) == 200
    assert {r["Outstanding_Debt"] for r in rows} == {None}
    incomes = [r["Annual_Income"] for r in rows]
    assert incomes.count(None) == 1 and min(filter(None, incomes)) == 2.0 and max(filter(None, incomes)) == 198.0


def test_grouped_clamp_equals_month_by_month(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(
        {
            "snapshot_date": [date(2023, m, 1) for m in rng.choice([1, 1, 1, 1, 2, 3], 6000)],
            "Annual_Income": rng.lognormal(10, 2, 6000).round(2),
            "Num_of_Loan": rng.integers(0, 30, 6000),
        }
    )
    df = spark.createDataFrame(frame).cache()
    have = sorted(tuple(r) for r in features.clamp_outliers(df).collect())
    want = []
    for day, rows in frame.groupby("snapshot_date"):
        month = df.filter(F.col("snapshot_date") == day)
        for c in ("Annual_Income", "Num_of_Loan"):
            low, high = month.approxQuantile(c, [0.01, 0.99], 0.001)
            rows = rows.assign(**{c: rows[c].astype(float).clip(low, high)})
        want += [tuple(r) for r in rows.itertuples(index=False)]
    assert have == sorted(want)


def test_ratios(spark):
    schema = "Outstanding_Debt double, Annual_Income double, Total_EMI_per_month double, Monthly_Inhand_Salary double, " \
             "Amount_invested_monthly double, Delay_from_due_date double, Num_of_Delayed_Payment double, " \
             "Num_of_Loan double, Num_Credit_Card double"
    rows = [(100.0, 3.0, 50.0, 0.0, 5.0, 4.0, 2.0, 7.0, None), (1.0, 8.0, 1.005, 2.0, None, None, 1.0, -2.0, 3.0)]
    have = features.add_ratios(spark.createDataFrame(rows, schema)).select(
        "debt_to_income", "emi_to_salary", "savings_rate", "payment_stress", "loans_per_credit_card", "monthly_surplus"
    )
    assert [tuple(r) for r in have.collect()] == [
        (33.3333, None, None, 8.0, None, -50.0), (0.125, 0.5025, None, None, -0.6667, 1.0),
    ]


def test_pad_adds_only_what_is_missing(spark):
    df = spark.createDataFrame([(1.5,)], "fe_3 float")
    row = features.pad_clickstream(df).first()
    assert row["fe_3"] == 1.5 and row["fe_1"] is None
    assert {k for _, k in features.pad_clickstream(df).dtypes} == {"double"}
    assert set(features.pad_clickstream(df).columns) == set(CLICKSTREAM_FEATURES)


def test_joins_stay_within_a_snapshot_and_fan_out(spark):
    schema = "Customer_ID string, snapshot_date date, {} int"
    fin = spark.createDataFrame([("a", DAY, 1), ("b", DAY, 2)], schema.format("x"))
    attr = spark.createDataFrame([("a", date(2023, 2, 1), 8), ("a", DAY, 5), ("a", DAY, 6)], schema.format("y"))
    have = sorted((r["Customer_ID"], r["x"], r["y"]) for r in features.join_attributes(fin, attr).collect())
    assert have == [("a", 1, 5), ("a", 1, 6), ("b", 2, None)]


def loans(spark, *rows):
    """Raw loans from (instalment, due, overdue, snapshot)."""
    records = [
        (f"CUS_0x{i}_2023_01_01", f" CUS_0X{i}", "2023-01-01", None, n, "10000", due, "0", over, "1", day)
        for i, (n, due, over, day) in enumerate(rows)
    ]
    return spark.createDataFrame(records, RAW_LOANS)


def test_loan_edge_cases(spark):
    raw = loans(spark, ("6", "100", "250", "2023-07-01"), ("6", "0", "50", "2023-07-01"), ("", "100", None, "2023-07-01"),
                ("6.0", "100", "100", "2023-07-01"), ("6", "100", "x", "2024-03-31"))
    df = silver_loans(raw)
    have = [(r["Customer_ID"], r["tenure"], r["mob"], r["installments_missed"], r["first_missed_date"], r["dpd"])
            for r in df.orderBy("loan_id").collect()]
    assert have == [
        ("cus_0x0", 0, 6, 3, date(2023, 4, 1), 91),
        # Overdue without a due amount: no date, no days, no default.
        ("cus_0x1", 0, 6, 0, None, None),
        # Null numbers are 0 by the time days are counted.
        ("cus_0x2", 0, 0, 0, None, 0),
        ("cus_0x3", 0, 6, 1, date(2023, 6, 1), 30),
        ("cus_0x4", 0, 6, 0, None, 0),
    ]
    labels = {r["loan_id"][:7]: (r["label"], r["label_def"]) for r in label_store(df).collect()}
    assert labels == {
        "CUS_0x0": (1, "30dpd_6mob"), "CUS_0x1": (0, "30dpd_6mob"), "CUS_0x3": (1, "30dpd_6mob"), "CUS_0x4": (0, "30dpd_6mob"),
    }
    assert [tuple(r) for r in bad_rate_by_mob(df).collect()] == [(0, 0.0), (6, 0.5)]


def test_silver_clickstream_does_not_strip(spark):
    columns = ["Customer_ID", *CLICKSTREAM_FEATURES, "snapshot_date"]
    df = spark.createDataFrame([("A ", "1.239_", "2.239", *["3"] * 18, "2023-01-01")], columns)
    row = silver.silver_clickstream(df).first()
    assert (row["Customer_ID"], row["fe_1"], row["fe_2"]) == ("a", None, pytest.approx(2.239))


def test_overlap_quality(spark):
    df = spark.createDataFrame([(DAY, 1.0), (DAY, None), (date(2023, 2, 1), 2.0)], "snapshot_date date, fe_1 double")
    have = {str(r["snapshot_date"]): (r["matched"], r["total"], r["match_pct"], r["warn"]) for r in profile.overlap_quality(df).collect()}
    assert have == {"2023-01-01": (1, 2, 50.0, True), "2023-02-01": (1, 1, 100.0, False)}


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(8)
    frame = pd.DataFrame({"x": rng.lognormal(0, 1, 5000), "k": rng.integers(0, 7, 5000), "same": 3.0, "gaps": np.where(rng.random(5000) < 0.3, np.nan, 2.5)})
    rows = spark.createDataFrame(frame).select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in frame])
    rows = rows.withColumn("nothing", F.lit(None).cast("double"))
    table = profile.histogram(rows, rows.columns).toPandas()
    assert set(table.column) == {"x", "k", "same", "gaps"}
    for c, part in table.sort_values("bin").groupby("column"):
        data = frame[c].dropna()
        low, high = data.quantile(0.01), data.quantile(0.99)
        counts, edges = np.histogram(data, bins=50, range=(low, high))
        assert list(part.row_count) == list(counts), c
        np.testing.assert_allclose(part.lower_edge, edges[:-1])
        assert set(part.outside_count) == {int(((data < low) | (data > high)).sum())}


def test_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(9)
    frame = pd.DataFrame(rng.normal(size=(500, 3)), columns=["a", "b", "c"])
    frame["d"] = 4.0
    frame.loc[rng.random(500) < 0.3, "a"] = None
    frame.loc[rng.random(500) < 0.3, "b"] = None
    have = profile.correlation(spark.createDataFrame(frame.replace({np.nan: None})), list(frame.columns)).toPandas()
    have = have.pivot(index="column_a", columns="column_b", values="r").astype(float)
    np.testing.assert_allclose(have, frame.corr(), rtol=1e-9, equal_nan=True)


def test_value_counts_and_distribution(spark):
    df = spark.createDataFrame([("x", 1), ("y", 0), ("x", 0), (None, 0)], "c string, label int")
    assert [tuple(r) for r in profile.value_counts(df, ["c"]).collect()] == [("c", "x", 2), ("c", "y", 1)]
    assert [tuple(r) for r in profile.distribution(df).collect()] == [(0, 3, 75.0), (1, 1, 25.0)]
    assert tuple(profile.table_shape(df).first()) == (4, 2)
