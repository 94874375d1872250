import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskmart.operators import metrics, model, training
from riskmart.operators import newton as solver

FEATURES = ["a", "b", "c", "constant"]


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(11)
    n = 3000
    frame = pd.DataFrame({"a": rng.lognormal(1, 1, n), "b": rng.normal(size=n), "c": rng.integers(0, 4, n), "constant": 2.0})
    frame["label"] = (rng.random(n) < 1 / (1 + np.exp(2 - 0.4 * frame.a + frame.b))).astype(int)
    frame.loc[rng.random(n) < 0.2, "b"] = np.nan
    df = spark.createDataFrame(frame.replace({np.nan: None})).select(
        *[F.col(c).cast("double").alias(c) for c in FEATURES], F.col("label").cast("int")
    )
    return frame, df.repartition(4).cache()


def prepared(frame):
    x = frame[FEATURES].astype(float).to_numpy()
    x = np.clip(x, np.nanpercentile(x, 1, axis=0), np.nanpercentile(x, 99, axis=0))
    x = np.where(np.isnan(x), np.nanmedian(x, axis=0), x)
    std = x.std(axis=0)
    return x, (x - x.mean(axis=0)) / np.where(std > 0, std, 1)


def newton(x, y, penalty):
    """Balanced, L2-penalised logistic regression with a free intercept; last entry is the intercept."""
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    x = np.column_stack([x, np.ones(len(y))])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [0.0])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = x.T @ (weight * (p - y)) + ridge @ beta
        beta -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, gradient)
    return beta


def test_statistics_equal_numpy(train):
    frame, df = train
    x, _ = prepared(frame)
    stats = model.fit_stats(df, FEATURES)
    raw = frame[FEATURES].astype(float)
    np.testing.assert_allclose([s.low for s in stats], np.nanpercentile(raw, 1, axis=0))
    np.testing.assert_allclose([s.high for s in stats], np.nanpercentile(raw, 99, axis=0))
    np.testing.assert_allclose([s.median for s in stats], np.nanmedian(raw, axis=0))
    np.testing.assert_allclose([s.mean for s in stats], x.mean(axis=0))
    np.testing.assert_allclose([s.std for s in stats], x.std(axis=0), atol=1e-12)


def test_coefficients_equal_a_newton_solve(spark, train):
    frame, df = train
    fitted = model.fit_model(df, FEATURES, tolerance=1e-10)
    want = newton(prepared(frame)[1], frame.label.to_numpy(), 1.0)
    np.testing.assert_allclose(fitted.regression.coefficients.toArray(), want[:-1], atol=1e-5)
    assert fitted.regression.intercept == pytest.approx(want[-1], abs=1e-5)
    table = [tuple(r) for r in fitted.coefficients(spark).collect()]
    assert [t[1] for t in table] == sorted((t[1] for t in table), reverse=True)
    assert dict((t[0], t[2]) for t in table)["constant"] == 0.0
    assert model.top_coefficients(fitted.coefficients(spark), 2).count() == 2
    scored = fitted.score(df)
    assert scored.columns == [*df.columns, "probability", "prediction"]
    assert scored.filter((F.col("probability") > 0.5) != (F.col("prediction") == 1)).count() == 0


def test_newton_steps_reach_the_optimum(spark, train):
    frame, df = train
    fitted = model.fit_newton(df, FEATURES)
    want = newton(prepared(frame)[1], frame.label.to_numpy(), 1.0)
    np.testing.assert_allclose(fitted.beta, [want[-1], *want[:-1]], atol=1e-9)
    scored = fitted.score(df)
    assert scored.columns == [*df.columns, "probability", "prediction"]
    other = model.fit_model(df, FEATURES, tolerance=1e-10).score(df).withColumnRenamed("probability", "other").drop("prediction")
    close = fitted.score(other)
    assert close.agg(F.max(F.abs(F.col("probability") - F.col("other")))).first()[0] < 1e-4
    assert fitted.coefficients(spark).count() == len(FEATURES)


def test_newton_halves_steps_that_go_too_far(spark):
    # One far row that a whole step from zero overshoots; with next to no penalty the optimum is remote.
    rows = [([x], float(x > 0.1), w) for x, w in [(-0.1, 1.0), (0.1, 1.0), (0.2, 1.0), (0.05, 3.0), (40.0, 1.0), (-30.0, 500.0), (35.0, 400.0)]]
    beta = solver.fit(spark.createDataFrame(rows, "x array<double>, label double, weight double").repartition(20), 1, 1e-4)
    x, y, w = (np.array(v) for v in zip(*[(r[0][0], r[1], r[2]) for r in rows]))
    p = 1 / (1 + np.exp(-(beta[0] + beta[1] * x)))
    assert abs((w * (p - y)).sum()) < 1e-6 and abs((w * (p - y) * x).sum() + 1e-4 * beta[1]) < 1e-6


def test_newton_tells_when_it_does_not_settle(spark):
    rows = spark.createDataFrame([([float(i)], float(i % 3 == 0), 1.0) for i in range(30)], "x array<double>, label double, weight double")
    with pytest.raises(RuntimeError, match="2 passes"):
        solver.fit(rows, 1, 1.0, most_steps=2)


def test_approximate_statistics_are_close(train):
    frame, df = train
    for exact, rough in zip(model.fit_stats(df, FEATURES), model.fit_stats(df, FEATURES, exact=False)):
        assert rough.median == pytest.approx(exact.median, rel=0.05, abs=0.05)


def test_a_feature_without_values_is_an_error(train):
    _, df = train
    with pytest.raises(ValueError, match="empty"):
        model.fit_stats(df.withColumn("empty", F.lit(None).cast("double")), ["a", "empty"])


def test_one_class_is_an_error(train):
    _, df = train
    with pytest.raises(ValueError, match="labels"):
        model.class_counts(df.filter("label = 1"))


def test_balanced_weights():
    assert model.class_weights({0: 30, 1: 10}) == {0: 40 / 60, 1: 2.0}


def test_auc_is_the_rank_sum(spark):
    rng = np.random.default_rng(2)
    score, label = rng.integers(0, 50, 4000) / 50, rng.integers(0, 2, 4000)
    ranks = pd.Series(score).rank().to_numpy()
    ones = label.sum()
    want = (ranks[label == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(label) - ones))
    df = spark.createDataFrame(pd.DataFrame({"probability": score, "label": label}))
    assert metrics.roc_auc(df) == pytest.approx(want, abs=1e-12)


@pytest.mark.parametrize("seed", range(3))
def test_auc_counts_pairs(spark, seed):
    """Against all pairs, with ties, infinities, both zeros, NaN on top, and rows that lack a label or a score."""
    rng = np.random.default_rng(seed)
    inf, nan = float("inf"), float("nan")
    pool = [-inf, -1.5, -0.0, 0.0, 0.25, 0.25 + 2**-53, 1e300, inf, nan]
    rows = [(pool[i], int(label)) for i, label in zip(rng.integers(0, len(pool), 300), rng.integers(0, 2, 300))]

    def order(x):
        return (1, 0.0) if x != x else (0, x)

    pairs = [(order(a), order(b)) for a, one in rows if one for b, other in rows if not other]
    want = sum(1 if a > b else 0.5 if a == b else 0 for a, b in pairs) / len(pairs)
    df = spark.createDataFrame([*rows, (None, 1), (0.5, None)], "probability double, label int")
    assert metrics.roc_auc(df) == pytest.approx(want, abs=1e-12)


def test_auc_without_both_classes(spark):
    for rows in ([], [(0.5, 1), (0.1, 1)], [(0.5, 0)]):
        df = spark.createDataFrame(rows, "probability double, label int")
        assert metrics.area_under_roc(df).collect() == [(None,)] and np.isnan(metrics.roc_auc(df))


def test_report(spark):
    rows = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3
    df = spark.createDataFrame(rows, "label int, prediction int")
    have = {r["class"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in metrics.class_report(df).collect()}
    assert have["0"] == (1.0, pytest.approx(5 / 7), pytest.approx(10 / 12), 7)
    assert have["1"] == (0.6, 1.0, 0.75, 3)
    assert have["macro avg"] == (0.8, pytest.approx(6 / 7), pytest.approx((10 / 12 + 0.75) / 2), 10)
    assert have["weighted avg"][0] == pytest.approx((7 + 1.8) / 10)
    assert metrics.accuracy(df).first()[0] == 0.8


def test_a_class_never_predicted_has_zero_precision(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    have = {r["class"]: tuple(r)[1:] for r in metrics.class_report(df).collect()}
    assert have["1"] == (0.0, 0.0, 0.0, 1)


def dated(spark, *days):
    return spark.createDataFrame([(d, 1) for d in days], "label_obs_date string, label int").withColumn(
        "label_obs_date", F.col("label_obs_date").cast("date")
    )


def test_split_and_guards(spark):
    df = dated(spark, "2024-05-01", "2024-06-01", "2024-07-01")
    train, test = training.chronological_split(df, "2024-06-01")
    assert (train.count(), test.count()) == training.check_split(df, "2024-06-01") == (2, 1)
    with pytest.raises(ValueError, match="after 2024-07-01"):
        training.check_split(df, "2024-07-01")
    with pytest.raises(ValueError, match="no feature row"):
        training.check_split(df.limit(0), "2024-06-01")


def test_feature_columns(spark):
    df = spark.createDataFrame([("a", 1, 2.0, 0)], "Customer_ID string, Age int, x double, label int")
    assert training.feature_columns(df) == ["Age", "x"]
    with pytest.raises(TypeError, match="Customer"):
        training.feature_columns(df.withColumnRenamed("Customer_ID", "Customer"))
