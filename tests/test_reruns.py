"""Reruns that rebuild only what changed, against full runs."""

import pytest
from pyspark.sql import functions as F

from catalog import views
from riskmart.plans import backfill, reruns
from riskmart.plans.backfill import BASELINE, FULL, LABELS, Datamart
from riskmart.plans.states import file_marks
from riskmart.schemas import SNAPSHOT
from riskmart.sources.scratch import Staging
from riskmart.sources.snapshots import footer_counts, footer_plan, stored_snapshots

SF = "/root/testdata/sf0.001"
START, END = "1997-01-01", "1997-03-01"
MONTHS = ["1997-01-01", "1997-02-01", "1997-03-01"]
VALID = MONTHS[1:]
TABLES = [*[("silver", t) for t in backfill.SILVER], *[("gold", t) for t in (LABELS, BASELINE, FULL)]]


@pytest.fixture(scope="module")
def raw(spark):
    names = {"loan_daily": "raw_loans", **{t: f"raw_{t}" for t in ("attributes", "financials", "clickstream")}}
    staging = Staging(spark)
    return {t: staging.table(views.raw(spark, SF, view), t) for t, view in names.items()}


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select([F.col(c).cast("string") for c in sorted(df.columns)]).collect())


def files(mart):
    tables = [*[("bronze", t) for t in backfill.SILVER], *TABLES]
    return {f"{layer}/{t}": file_marks(mart.spark, mart.path(layer, t)) for layer, t in tables}


def same_layers(mart, other):
    for layer, table in TABLES:
        assert stored_snapshots(mart.spark, mart.path(layer, table)).keys() == stored_snapshots(mart.spark, other.path(layer, table)).keys()
        assert rows(getattr(mart, layer)(table)) == rows(getattr(other, layer)(table)), table


def test_only_changed_months_are_written(spark, raw, monkeypatch):
    mart = Datamart(spark, Staging(spark).root, START, END)
    first = reruns.refill(mart, raw, clickstream_snapshots=VALID)
    assert all(days == (VALID if table == f"gold/{FULL}" else MONTHS) for table, days in first.items()) and len(first) == 11
    full = Datamart(spark, Staging(spark).root, START, END)
    backfill.backfill(full, raw, clickstream_snapshots=VALID)
    same_layers(mart, full)

    before = files(mart)
    shuffled = {t: df.repartition(3).orderBy(F.rand(1)) for t, df in raw.items()}
    assert not any(reruns.refill(mart, shuffled, clickstream_snapshots=VALID).values()) and files(mart) == before

    month = F.col(SNAPSHOT) == MONTHS[1]
    changed = dict(raw)
    changed["financials"] = raw["financials"].withColumn("Outstanding_Debt", F.when(month, "7.5").otherwise(F.col("Outstanding_Debt")))
    changed["loan_daily"] = raw["loan_daily"].withColumn("overdue_amt", F.when(month, "0.00").otherwise(F.col("overdue_amt")))
    # A run that stops before the record is noted leaves the month to the next run.
    with monkeypatch.context() as patch:
        patch.setattr(reruns, "record", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            reruns.refill(mart, changed, clickstream_snapshots=VALID)
    rebuilt = reruns.refill(mart, changed, clickstream_snapshots=VALID)
    touched = {f"{layer}/{t}" for layer in ("bronze", "silver") for t in ("financials", "loan_daily")}
    touched |= {f"gold/{t}" for t in (LABELS, BASELINE, FULL)}
    assert {table for table, days in rebuilt.items() if days} == touched
    assert all(rebuilt[table] == [MONTHS[1]] for table in touched)
    after = files(mart)
    for table, marks in before.items():
        assert {day for day in marks if marks[day] != after[table][day]} == ({MONTHS[1]} if table in touched else set()), table
    backfill.backfill(full, changed, clickstream_snapshots=VALID)
    same_layers(mart, full)

    # A month that is gone from a source goes from what is built on it; another definition builds its table alone.
    changed["financials"] = changed["financials"].filter(F.col(SNAPSHOT) != MONTHS[2])
    rebuilt = reruns.refill(mart, changed, dpd=60, clickstream_snapshots=VALID)
    assert {t: days for t, days in rebuilt.items() if days} == {
        "bronze/financials": [MONTHS[2]], "silver/financials": [MONTHS[2]], f"gold/{BASELINE}": [MONTHS[2]],
        f"gold/{FULL}": [MONTHS[2]], f"gold/{LABELS}": MONTHS,
    }
    backfill.backfill(full, changed, dpd=60, clickstream_snapshots=VALID)
    same_layers(mart, full)


def test_fingerprints_see_every_change_but_order(spark):
    schema = f"a string, b string, {SNAPSHOT} string"

    def prints(*cells):
        df = spark.createDataFrame([(*c, "2023-01-01") for c in cells], schema)
        return [r["print"] for r in reruns.fingerprints(df.repartition(4)).collect()]

    seen = [prints(*cells) for cells in (
        [("x", "y"), ("u", "v")], [("x", "v"), ("u", "y")], [("x", "y")], [("x", "y")] * 2, [("x", "y")] * 3,
        [(None, "x")], [("x", None)], [("", "x")], [("x", "")], [(None, None)], [("", None)],
    )]
    assert len({p[0] for p in seen}) == len(seen)
    assert prints(("u", "v"), ("x", "y")) == seen[0]
    assert reruns.fingerprints(spark.createDataFrame([], schema)).collect() == []


def test_counts_come_from_footers(spark, tmp_path):
    root = str(tmp_path / "t")
    days = F.expr("add_months(date '2023-01-01', cast(id % 3 as int))")
    backfill.write_snapshots(spark.range(100).withColumn("v", F.rand()).withColumn(SNAPSHOT, days), root)
    plan = footer_plan(spark, root, "2023-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [snapshot_date]" in plan
    assert {str(r[0]): r[1] for r in footer_counts(spark, root, "2023-02-01").collect()} == {"2023-02-01": 33, "2023-03-01": 33}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
