import itertools

import pytest
from pyspark.sql import functions as F

from riskmart.operators import joins


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(sorted(df.columns)).collect())


def side(spark, name, hot, n):
    """Keys 0..9 with one row each, ``hot`` with ``n`` equal copies, a null key and a key of its own."""
    keys = [(str(k), 1) for k in range(10)] + [(hot, 1)] * n + [(None, 1), (name, 1)]
    return spark.createDataFrame(keys, "k string, d int").withColumn(name, F.lit(name)).repartition(4)


@pytest.mark.parametrize("how, hot_left, hot_right", list(itertools.product(["inner", "left"], ["3", None, "odd"], ["3", "5"])))
def test_salted_join_equals_plain_join(spark, how, hot_left, hot_right):
    left, right = side(spark, "l", hot_left, 200), side(spark, "r", hot_right, 30)
    have = joins.skew_join(left, right, ["k", "d"], how, rows=20, sample=1.0)
    assert rows(have) == rows(left.join(right, ["k", "d"], how))


def test_salts_follow_the_size_of_a_key(spark):
    left, right = side(spark, "l", "3", 2000).withColumn("id", F.monotonically_increasing_id()), side(spark, "r", "3", 450)
    hot = joins.hot_keys(left, right, ["k", "d"], rows=100, sample=1.0).collect()
    assert [(r["k"], r["_left"], r["_right"]) for r in hot] == [("3", 21, 5)]
    salted = joins._salted(left, spark.createDataFrame(hot), ["k", "d"], "_left", "_a", "_right", "_b")
    dealt = [r["count"] for r in salted.filter("k = '3'").groupBy("_a", "_b").count().collect()]
    assert len(dealt) > 60 and max(dealt) < 3 * 2001 / 21


def test_a_key_hot_on_both_sides(spark):
    left, right = side(spark, "l", "3", 500), side(spark, "r", "3", 300)
    for how in ("inner", "left"):
        have = joins.skew_join(left, right, ["k", "d"], how, rows=50, sample=1.0)
        assert rows(have) == rows(left.join(right, ["k", "d"], how))


def test_thousands_of_hot_keys(spark):
    left = spark.range(6000).select((F.col("id") % 1500).cast("string").alias("k"), F.col("id").alias("x"))
    right = spark.range(1600).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("y"))
    assert joins.hot_keys(left, right, ["k"], rows=2, sample=1.0).count() == 1500
    assert rows(joins.skew_join(left, right, ["k"], "inner", rows=2, sample=1.0)) == rows(left.join(right, "k"))


def test_without_hot_keys_it_is_the_plain_join(spark):
    left, right = side(spark, "l", "3", 1), side(spark, "r", "3", 1)
    plan = joins.skew_join(left, right, ["k", "d"], "left")._jdf.queryExecution().optimizedPlan().toString()
    assert "_a" not in plan


def test_keys_of_different_type_are_refused(spark):
    with pytest.raises(ValueError, match="differ in type"):
        joins.skew_join(spark.range(1), spark.range(1).select(F.col("id").cast("int").alias("id")), ["id"])


def test_lookup_broadcasts_only_what_is_small(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 7)
    stats = df.groupBy("g").agg(F.max("id").alias("m"))
    expected = rows(df.join(stats, "g", "left"))
    small = joins.lookup(df, stats, ["g"])
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    assert rows(small) == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10)
    try:
        large = joins.lookup(df, stats, ["g"])
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert rows(large) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
