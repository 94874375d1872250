from datetime import date

import pytest
from pyspark.sql import functions as F

from catalog import views
from riskmart.plans import backfill
from riskmart.plans.backfill import BASELINE, FULL, LABELS, Datamart
from riskmart.plans.modelling import run_training, train_evaluate
from riskmart.schemas import RAW_SCHEMAS, SNAPSHOT
from riskmart.sources.scratch import Staging

SF = "/root/testdata/sf0.001"
START, END = "1997-01-01", "1997-04-01"
VALID = ["1997-02-01", "1997-03-01", "2001-01-01"]
MONTHS = ["1997-01-01", "1997-02-01", "1997-03-01", "1997-04-01"]


@pytest.fixture(scope="module")
def raw(spark):
    names = {"loan_daily": "raw_loans", **{t: f"raw_{t}" for t in ("attributes", "financials", "clickstream")}}
    staging = Staging(spark)
    return {t: staging.table(views.raw(spark, SF, view), t) for t, view in names.items()}


@pytest.fixture(scope="module")
def mart(spark, raw):
    mart = Datamart(spark, Staging(spark).root, START, END)
    backfill.backfill(mart, raw, clickstream_snapshots=VALID)
    return mart


def rows(df):
    # As text, since a first missed date may lie before the years Python knows.
    return sorted(tuple(map(str, r)) for r in df.select([F.col(c).cast("string") for c in sorted(df.columns)]).collect())


def test_one_run_equals_a_run_per_month(spark, raw, mart):
    root = Staging(spark).root
    for day in MONTHS:
        backfill.backfill(Datamart(spark, root, day, day), raw, clickstream_snapshots=VALID)
    monthly = Datamart(spark, root, START, END)
    for table in backfill.SILVER:
        assert rows(monthly.silver(table)) == rows(mart.silver(table)), table
    for table in (LABELS, BASELINE, FULL):
        assert rows(monthly.gold(table)) == rows(mart.gold(table)), table


def test_layers_hold_what_they_should(spark, raw, mart):
    for table in backfill.SILVER:
        want = raw[table].filter(F.col(SNAPSHOT).between(START, END)).count()
        assert mart.bronze(table).count() == mart.silver(table).count() == want > 0
        assert mart.bronze(table).columns == RAW_SCHEMAS[table].names
    assert {str(r[0]) for r in mart.gold(BASELINE).select(SNAPSHOT).distinct().collect()} == set(MONTHS)
    assert {str(r[0]) for r in mart.gold(FULL).select(SNAPSHOT).distinct().collect()} == set(VALID[:2])
    assert {"Name", "SSN", "Occupation"}.isdisjoint(mart.gold(BASELINE).columns)
    assert set(mart.gold(FULL).columns) - set(mart.gold(BASELINE).columns) == {f"fe_{i}" for i in range(1, 21)}
    assert dict(mart.gold(BASELINE).dtypes)[SNAPSHOT] == "date"
    counts = {(r["table"], str(r[SNAPSHOT])): r["row_count"] for r in backfill.layer_counts(mart).collect()}
    assert counts["silver/financials", START] == counts["gold/features_baseline", START]
    quality = backfill.clickstream_overlap(mart).collect()
    assert len(quality) == 2 and all(0 <= r["matched"] <= r["total"] for r in quality)


def test_gold_is_written_without_another_shuffle(spark, mart):
    from riskmart.operators.features import feature_table

    base = Staging(spark).table(mart.silver("financials").withColumn("Occupation", F.lit("nurse")), "b", SNAPSHOT)
    plan = feature_table(base)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_silver_is_written_without_a_shuffle(mart):
    for table, build in backfill.SILVER.items():
        assert "Exchange" not in build(mart.bronze(table))._jdf.queryExecution().executedPlan().toString()


def test_missing_feature_set_and_store(spark, tmp_path):
    empty = Datamart(spark, str(tmp_path / "none"), START, END)
    with pytest.raises(ValueError, match="feature_set"):
        run_training(empty, str(tmp_path / "out"), "other")
    with pytest.raises(FileNotFoundError):
        run_training(empty, str(tmp_path / "out"))


@pytest.fixture(scope="module")
def years(spark, raw):
    mart = Datamart(spark, Staging(spark).root, *views.span(spark, SF))
    backfill.backfill(mart, raw, clickstream_snapshots=views.VALID_SNAPSHOTS)
    return mart


def test_training_from_the_stores(spark, years, tmp_path):
    out = str(tmp_path / "out")
    result = run_training(years, out, train_end=views.TRAIN_END, max_iter=50)
    metrics = {r["label"]: r for r in result.metrics.collect()}
    assert set(metrics) == {"LR_baseline_train", "LR_baseline_test"}
    for row in metrics.values():
        assert 0 <= row["accuracy"] <= 1 and 0.4 <= row["roc_auc"] <= 1
        assert (row["feature_set"], row["train_end"]) == ("baseline", views.TRAIN_END)
    assert result.coefficients.count() == 28
    stored = spark.read.option("header", True).csv(f"{out}/coefficients_LR_baseline")
    assert stored.columns == ["feature", "abs_coef", "coef"] and stored.count() == 28
    assert spark.read.option("header", True).csv(f"{out}/metrics_LR_baseline").count() == 2
    cells = result.confusion.groupBy("split").agg(F.sum("row_count").alias("n")).collect()
    assert sum(r["n"] for r in cells) == sum(r["row_count"] for r in result.labels.collect())
    with pytest.raises(ValueError, match="no label was observed after"):
        run_training(years, out, train_end="2030-01-01")


def test_training_without_any_match(years):
    labels = years.gold(LABELS).withColumn("loan_id", F.lit("CUS_0x1"))
    with pytest.raises(ValueError, match="no feature row matches"):
        train_evaluate(years.gold(BASELINE), labels, train_end=views.TRAIN_END)


def test_full_store_can_be_trained_on(years):
    """As it is written: features without a value in the training rows are left out."""
    store, end = years.gold(FULL), "1997-12-01"
    result = train_evaluate(store.withColumn("fe_3", F.lit(None).cast("double")), years.gold(LABELS), "full", end, 20)
    names = {r["feature"] for r in result.coefficients.collect()}
    assert "fe_3" not in names and "fe_4" in names and 30 < len(names) < 48
    assert {r["label"] for r in result.metrics.collect()} == {"LR_full_train", "LR_full_test"}


def test_snapshot_dates_are_dates_in_the_training_set(years):
    from riskmart.operators.training import training_set

    merged = training_set(years.gold(BASELINE), years.gold(LABELS))
    row = merged.first()
    assert row[SNAPSHOT] == row["loan_open_date"] and isinstance(row["label_obs_date"], date)


def test_states_follow_the_months_that_were_run(spark, mart):
    assert backfill.build_states(mart)["financials"] == MONTHS
    month = Datamart(spark, mart.root, MONTHS[1], MONTHS[1])
    backfill.build_silver(month, ["financials"])
    assert backfill.build_states(mart) == {"financials": [MONTHS[1]], "clickstream": []}
    year = backfill.silver_quantiles(mart, "financials", [0.5], exact=True).first()
    wanted = mart.silver("financials").agg(F.percentile("Annual_Income", 0.5)).first()[0]
    assert year["Annual_Income"] == [pytest.approx(wanted)]
