from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.operators.sketches import K, error_of
from riskmart.plans import states
from riskmart.schemas import SNAPSHOT
from riskmart.sources.scratch import Staging
from riskmart.sources.snapshots import delete_path, write_snapshots

DAYS = [date(2023, m, 1) for m in range(1, 5)]


@pytest.fixture
def store(spark):
    with Staging(spark) as staging:
        rng = np.random.default_rng(3)
        # The first month holds more than a third of the rows; one column is empty in it.
        rows = [(DAYS[0], float(x), None) for x in rng.lognormal(2, 2, 4000)]
        rows += [(day, float(x), float(i % 9)) for day in DAYS[1:] for i, x in enumerate(rng.lognormal(1, 3, 1500))]
        rows += [(DAYS[1], float("inf"), float("nan")), (DAYS[1], None, None)]
        df = spark.createDataFrame(rows, f"{SNAPSHOT} date, a double, b double")
        write_snapshots(df, staging.path("t"), rebalance=True)
        yield df, staging.path("t"), staging.path("s")


def values(df, name, days):
    x = np.array([r[0] for r in df.filter(F.col(SNAPSHOT).isin(days)).select(name).collect() if r[0] is not None])
    return np.sort(x[~np.isnan(x)])


def test_only_changed_snapshots_are_built_again(spark, store):
    df, root, kept = store
    assert states.refresh(spark, root, kept, ["a", "b"]) == [str(d) for d in DAYS]
    assert states.refresh(spark, root, kept, ["a", "b"]) == []
    write_snapshots(df.filter(F.col(SNAPSHOT) == DAYS[2]).withColumn("a", F.col("a") + 1), root)
    assert states.refresh(spark, root, kept, ["a", "b"], str(DAYS[0]), str(DAYS[1])) == []
    with pytest.raises(ValueError, match="2023-03-01"):
        states.range_states(spark, root, kept, ["a"])
    assert states.refresh(spark, root, kept, ["a", "b"]) == ["2023-03-01"]
    assert states.range_states(spark, root, kept, ["a"]).first()["n"] == 8501


def test_a_removed_snapshot_counts_no_more(spark, store):
    df, root, kept = store
    states.refresh(spark, root, kept, ["a"])
    delete_path(spark, f"{root}/{SNAPSHOT}={DAYS[0]}")
    assert states.refresh(spark, root, kept, ["a"]) == []
    assert states.range_states(spark, root, kept, ["a"]).first()["n"] == 4501


def test_a_further_column_is_added(spark, store):
    _, root, kept = store
    states.refresh(spark, root, kept, ["a"])
    with pytest.raises(ValueError, match="2023-01-01"):
        states.range_states(spark, root, kept, ["b"])
    assert states.refresh(spark, root, kept, ["a", "b"]) == [str(d) for d in DAYS]
    assert states.range_states(spark, root, kept, ["b"]).first()["n"] == 4500


@pytest.mark.parametrize("days", [DAYS, DAYS[1:3], DAYS[:1]])
def test_quantiles_over_a_range(spark, store, days):
    df, root, kept = store
    states.refresh(spark, root, kept, ["a", "b"])
    span = str(days[0]), str(days[-1])
    exact = states.range_quantiles(spark, root, kept, ["a", "b"], [0.0, 0.3, 0.9], *span, exact=True).first()
    near = states.range_quantiles(spark, root, kept, ["a", "b"], [0.0, 0.3, 0.9], *span).first()
    for name in ("a", "b"):
        x = values(df, name, days)
        if not len(x):
            assert exact[name] is None and near[name] is None
            continue
        np.testing.assert_allclose(exact[name], np.quantile(x, [0.0, 0.3, 0.9]), rtol=1e-12)
        for share, estimate in zip([0.0, 0.3, 0.9], near[name]):
            slack = (error_of(K) + 1 / 200) * len(x) + 1
            assert np.searchsorted(x, estimate, "left") - slack <= share * len(x) <= np.searchsorted(x, estimate, "right") + slack


def test_quantiles_from_states_equal_those_from_rows(spark, store):
    _, root, kept = store
    states.refresh(spark, root, kept, ["a"])
    by_day = states.range_quantiles(spark, root, kept, ["a"], [0.5], by=[SNAPSHOT], exact=True)
    seeded = {r[SNAPSHOT]: r["a"] for r in by_day.collect()}
    plain = states.exact_quantiles(states.read_snapshots(spark, root), ["a"], [0.5], [SNAPSHOT])
    assert seeded == {r[SNAPSHOT]: r["a"] for r in plain.collect()}
