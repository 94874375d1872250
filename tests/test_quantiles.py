import numpy as np
import pandas as pd
import pytest

from riskmart.operators import sketches
from riskmart.operators.quantiles import approx_quantiles, exact_quantiles
from riskmart.sources.scratch import Staging

SHARES = [0.01, 0.5, 0.99]
COLUMNS = ["normal", "skewed", "mostly_zero", "codes", "constant", "huge"]


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(5)
    n = 30_000
    frame = pd.DataFrame(
        {
            # A third of the rows are in each of two groups, the rest in small ones.
            "g": np.where(rng.random(n) < 0.66, rng.integers(0, 2, n), rng.integers(2, 12, n)),
            "normal": rng.normal(size=n),
            "skewed": rng.lognormal(5, 3, n).round(2),
            "mostly_zero": np.where(rng.random(n) < 0.7, 0.0, rng.random(n)),
            "codes": np.where(rng.random(n) < 0.4, None, rng.integers(-3, 4, n)).astype(float),
            "constant": 7.0,
            "huge": rng.choice([-1.7e308, 0.0, 1.7e308, np.nan], n),
        }
    )
    frame.loc[frame.g == 11, "codes"] = None
    df = spark.createDataFrame(frame).repartition(8).cache()
    return frame, df


def test_interpolated_equals_numpy(sample):
    frame, df = sample
    have = exact_quantiles(df, COLUMNS, SHARES).first()
    for c in COLUMNS:
        np.testing.assert_allclose(have[c], frame[c].dropna().quantile(SHARES), rtol=1e-12, err_msg=c)


def test_discrete_by_group_is_the_value_at_the_rank(sample):
    frame, df = sample
    have = {r["g"]: r for r in exact_quantiles(df, COLUMNS, SHARES, ["g"], interpolate=False).collect()}
    assert sorted(have) == sorted(frame.g.unique())
    for g, rows in frame.groupby("g"):
        for c in COLUMNS:
            values = np.sort(rows[c].dropna())
            if len(values) == 0:
                assert have[g][c] is None
            else:
                assert have[g][c] == [values[max(int(np.ceil(len(values) * p)), 1) - 1] for p in SHARES]


def test_no_values_at_all(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], SHARES).first()["x"] is None


def test_median_of_an_even_count(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (None,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5]).first()["x"] == [2.5]


def test_grouped_approximation_equals_one_call_per_group(sample):
    frame, df = sample
    have = {r["g"]: r["skewed"] for r in approx_quantiles(df, ["skewed"], [0.01, 0.99], ["g"]).collect()}
    for g in have:
        assert have[g] == df.filter(df.g == g).approxQuantile("skewed", [0.01, 0.99], 0.001)


def test_infinities_denormals_and_wide_ranges(spark):
    inf = float("inf")
    columns = {
        "infinite": [inf, -inf, inf] + [float(i) for i in range(97)],
        "tiny": [5e-324 * i for i in range(100)],
        "wide": [(-1) ** i * 10.0 ** (6 * i - 300) for i in range(100)],
        "only": [inf] * 60 + [-inf] * 40,
    }
    df = spark.createDataFrame(list(zip(*columns.values())), list(columns))
    have = exact_quantiles(df, list(columns), [0.01, 0.37, 0.5, 0.98, 1.0], interpolate=False).first()
    for name, values in columns.items():
        assert have[name] == [sorted(values)[max(int(np.ceil(100 * p)), 1) - 1] for p in (0.01, 0.37, 0.5, 0.98, 1.0)], name
    middle = exact_quantiles(df, ["infinite", "only"], [0.0, 0.4, 0.995]).first()
    assert middle["infinite"][0] == -inf and middle["infinite"][2] == inf and middle["only"] == [-inf, -inf, inf]


def test_statistics_too_large_to_broadcast(spark, sample):
    _, df = sample
    want = {r["g"]: r["skewed"] for r in exact_quantiles(df, ["skewed"], SHARES, ["g"], interpolate=False).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        have = exact_quantiles(df, ["skewed"], SHARES, ["g"], interpolate=False).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["g"]: r["skewed"] for r in have} == want


@pytest.mark.parametrize("margin, few", [(None, 3), (0.0, 3), (-0.3, 10**6)])
def test_ranges_of_many_values_and_ranges_that_miss(sample, margin, few):
    """Few values a task narrow what was kept; a margin below nought puts ranks outside their ranges."""
    frame, df = sample
    have = exact_quantiles(df, ["normal", "skewed", "mostly_zero", "huge"], SHARES, margin=margin, few=few).first()
    for c in ["normal", "skewed", "mostly_zero", "huge"]:
        np.testing.assert_allclose(have[c], frame[c].dropna().quantile(SHARES), rtol=1e-12, err_msg=c)


def test_the_table_is_read_twice(spark, sample, tmp_path):
    _, df = sample
    path = str(tmp_path / "stored")
    df.write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        reads.add(1)
        yield from batches

    stored = spark.read.parquet(path).coalesce(1)
    watched = stored.mapInArrow(counted, stored.schema)
    exact_quantiles(watched, COLUMNS, SHARES, ["g"]).collect()
    assert reads.value == 2


def test_merged_states_equal_those_of_all_rows(spark, sample):
    frame, df = sample
    states = Staging(spark).table(sketches.column_states(df, COLUMNS, ["g"]), "states")
    merged = sketches.merged_states(states)
    whole = {r.c: r for r in sketches.column_states(df, COLUMNS).collect()}
    for r in merged.collect():
        assert [r[f] for f in (*sketches.COUNTS, "least", "most")] == [whole[r.c][f] for f in (*sketches.COUNTS, "least", "most")]
    have = sketches.estimated_quantiles(merged, COLUMNS, SHARES).first()
    for c in ("normal", "skewed"):
        ranks = np.searchsorted(np.sort(frame[c]), have[c]) / len(frame)
        assert np.abs(ranks - SHARES).max() < sketches.error_of(sketches.K)
    assert have["constant"] == [7.0] * 3
