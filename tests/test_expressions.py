from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.functions import cleaning, delinquency, encoding


def values(spark, expression, inputs):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, c string")
    return [r["x"] for r in rows.select("i", expression.alias("x")).orderBy("i").collect()]


def test_clean_int(spark):
    inputs = ["41_", "-500", "23.7", "", "-", "5-", "1.2.3", "12345678901", None, " 7 ", "-0.9"]
    assert values(spark, cleaning.clean_number(F.col("c"), "int"), inputs) == [
        41, -500, 23, None, None, None, None, None, None, 7, 0,
    ]


def test_clean_float_rounds_to_cents(spark):
    have = values(spark, cleaning.clean_number(F.col("c"), "float"), ["2.", ".5", "5-", "3.146", "$1,234.50", "-2.5_"])
    assert have == [2.0, 0.5, None, pytest.approx(3.15), 1234.5, -2.5]


def test_large_amount_keeps_its_magnitude(spark):
    assert values(spark, cleaning.clean_number(F.col("c"), "float"), ["24198062.0"]) == [24198062.0]


def test_clean_category(spark):
    inputs = [None, "", "  ", "_______", "!@9#%8", " Good "]
    assert values(spark, cleaning.clean_category(F.col("c")), inputs) == ["na"] * 4 + ["!@9#%8", "good"]


def test_loan_list(spark):
    inputs = ["Auto Loan, Student Loan, and Auto Loan", "Not Specified, and Payday Loan", None, "Brandy Loan", " , and "]
    assert values(spark, cleaning.clean_loan_list(F.col("c")), inputs) == [
        "auto loan, student loan", "not specified, payday loan", None, "brandy loan", "",
    ]
    dropped = cleaning.clean_loan_list(F.col("c"), drop_unspecified=True)
    assert values(spark, dropped, inputs[1:2]) == ["payday loan"]


def test_history_months(spark):
    inputs = ["22 Years and 1 Months", "NA", None, "1 Year and 3 Months", "999999999 Years"]
    assert values(spark, cleaning.history_months(F.col("c")), inputs) == [265, 0, 0, 3, None]


def test_whitelists(spark):
    assert values(spark, cleaning.clean_min_amount(F.col("c")), ["Yes", " no ", "NM", None]) == ["yes", "no", "na", "na"]
    assert values(spark, cleaning.clean_behaviour(F.col("c")), ["High_spent_Small_value_payments", "!@9#%8", None]) == [
        "high_spent_small_value_payments", "unknown", "unknown",
    ]


def test_encodings(spark):
    assert values(spark, encoding.credit_mix_code(F.col("c")), ["Bad", "standard", " good", "na", None]) == [0, 1, 2, -1, -1]
    assert values(spark, encoding.min_amount_code(F.col("c")), ["no", "YES", "na", None]) == [0, 1, -1, -1]
    assert values(spark, encoding.occupation_code(F.col("c")), ["Media_Manager", "na", "Writer", "accountant", None]) == [
        10, 15, 16, 0, 15,
    ]
    behaviours = ["high_spent_large_value_payments", "low_spent_small_value_payments", "unknown", None]
    assert values(spark, encoding.spent_level_code(F.col("c")), behaviours) == [1, 0, -1, -1]
    assert values(spark, encoding.payment_size_code(F.col("c")), behaviours) == [2, 0, -1, -1]


@pytest.mark.parametrize(
    "overdue, due, missed", [(250.0, 100.0, 3), (50.0, 0.0, 0), (None, 100.0, 0), (0.0, 100.0, 0), (1.0, 100.0, 1),
     (1000.0, 0.04, 25001), (3e38, 1e-38, 2**31 - 1), (-5.0, 2.0, -2)]
)
def test_missed(one, overdue, due, missed):
    expression = delinquency.installments_missed(F.col("o"), F.col("d"))
    assert one(expression, "o float, d float", overdue, due) == missed


def test_first_missed_clamps_to_month_end(one):
    expression = delinquency.first_missed_date(F.col("s"), F.col("m"))
    schema = "s date, m int"
    assert one(expression, schema, date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert one(expression, schema, date(2024, 3, 31), 0) is None
    days = F.unix_date(expression)
    # 25,000 months are as long 2,400 years later, as the calendar repeats after 400.
    back = date(4424, 3, 1).toordinal() - date(2340, 11, 1).toordinal()
    assert one(days, schema, date(2024, 3, 1), 25_000) == (date(2024, 3, 1) - date(1970, 1, 1)).days - back
    assert one(expression, schema, date(2024, 3, 31), 2**31 - 1) is None


def test_days_past_due(one):
    expression = delinquency.days_past_due(F.col("o"), F.col("s"), F.col("f"), F.col("m"))
    schema = "o float, s date, f date, m int"
    assert one(expression, schema, 10.0, date(2024, 8, 1), date(2024, 7, 1), 1) == 31
    assert one(expression, schema, 0.0, date(2024, 8, 1), None, 0) == 0
    assert one(expression, schema, 50.0, date(2024, 8, 1), None, 0) is None
    assert one(expression, schema, 50.0, date(2024, 8, 1), None, 2**31 - 1) == 2**31 - 1


@pytest.mark.parametrize("missed", [25_000, 100_000, 12 * 5_800_000, 12 * 5_800_000 + 1])
def test_however_long_overdue_a_loan_is_past_due(one, missed):
    first = delinquency.first_missed_date(F.col("s"), F.col("m"))
    days = delinquency.days_past_due(F.col("o"), F.col("s"), first, F.col("m"))
    assert one(delinquency.default_flag(days, 30), "s date, m int, o float", date(2024, 8, 1), missed, 1.0) == 1
    assert one(days, "s date, m int, o float", date(2024, 8, 1), missed, 1.0) > 30 * missed or missed > 12 * 5_800_000


def test_unknown_dpd_is_no_default(one):
    assert [one(delinquency.default_flag(F.col("d"), 30), "d int", d) for d in (None, 29, 30)] == [0, 0, 1]


def test_loan_open_date(spark):
    inputs = ["CUS_0x1_2023_01_01", "CUS_0x1", "CUS_0x1_2023_01", "CUS_0x1_2023_1_1", "CUS_0x1_2023_02_30", None]
    assert values(spark, delinquency.loan_open_date(F.col("c")), inputs) == [date(2023, 1, 1)] + [None] * 5
