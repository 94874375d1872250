"""Joins of bucketed tables: no exchange, the same rows, hot customers salted."""

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.operators.features import join_attributes, join_clickstream
from riskmart.operators.joins import skew_join
from riskmart.schemas import KEYS
from riskmart.settings import CO_LOCATED
from riskmart.sources.bucketed import write_bucketed


@pytest.fixture
def joined_in_place(spark):
    """Joins that are not broadcast, in a session that leaves rows where they lie."""
    settings = {**CO_LOCATED, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def customers(spark, column, n=400, hot=0):
    df = spark.range(n).select(
        F.concat(F.lit("cus_"), (F.col("id") % 90).cast("string")).alias("Customer_ID"),
        F.col("id").cast("int").alias(column),
        F.expr("add_months(date '2023-01-01', cast(id div 90 as int))").alias("snapshot_date"),
    )
    alike = spark.range(hot).select(F.lit("hot").alias("Customer_ID"), F.col("id").cast("int").alias(column), F.lit(date(2023, 1, 1)).alias("snapshot_date"))
    absent = spark.createDataFrame([(None, -1, date(2023, 1, 1))], df.schema)
    return df.unionByName(alike).unionByName(absent)


def bucketed(df, tmp_path, buckets=6):
    name = f"t_{uuid.uuid4().hex}"
    return write_bucketed(df, name, buckets, str(tmp_path / name)), name


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    columns = sorted(a.columns)
    return sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


def test_three_tables_join_without_an_exchange(spark, tmp_path, joined_in_place):
    sources = [customers(spark, c, n) for c, n in (("income", 400), ("Age", 300), ("fe_1", 250))]
    financials, attributes, clickstream = (bucketed(df, tmp_path)[0] for df in sources)
    joined = join_clickstream(join_attributes(financials, attributes), clickstream)
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    wanted = sources[0].join(sources[1], KEYS, "left").join(sources[2], KEYS, "left")
    assert same(joined, wanted)


def test_other_numbers_of_buckets_shuffle_and_agree(spark, tmp_path, joined_in_place):
    left, right = customers(spark, "income"), customers(spark, "Age")
    joined = join_attributes(bucketed(left, tmp_path, 6)[0], bucketed(right, tmp_path, 4)[0])
    assert "Exchange" in plan(joined) and same(joined, left.join(right, KEYS, "left"))


def test_hot_customers_are_salted(spark, tmp_path, joined_in_place):
    left, right = customers(spark, "income", hot=150), customers(spark, "Age", hot=40)
    joined = skew_join(bucketed(left, tmp_path)[0], bucketed(right, tmp_path)[0], KEYS, "left", rows=20, sample=1)
    assert joined.count() == left.join(right, KEYS, "left").count() > 150 * 40
    assert same(joined, left.join(right, KEYS, "left"))


def test_a_rerun_replaces_only_its_snapshots(spark, tmp_path):
    df = customers(spark, "income")
    table, name = bucketed(df, tmp_path)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    month = F.col("snapshot_date") == "2023-02-01"
    rerun = df.filter(month).withColumn("income", -F.col("income"))
    again = write_bucketed(rerun.select("snapshot_date", "income", "Customer_ID"), name, 6)
    assert same(again, df.filter(~month).unionByName(rerun)) and spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    with pytest.raises(ValueError, match="6 buckets"):
        write_bucketed(rerun, name, 5)
    with pytest.raises(ValueError, match="columns"):
        write_bucketed(rerun.drop("income"), name, 6)


def test_a_bucket_is_one_file_of_a_snapshot(spark, tmp_path):
    table, name = bucketed(customers(spark, "income"), tmp_path, 3)
    files = table.select("snapshot_date", F.regexp_extract("_metadata.file_name", r"_(\d+)\.c", 1).alias("bucket"), "_metadata.file_name")
    counts = files.distinct().groupBy("snapshot_date", "bucket").count().collect()
    assert counts and all(r["count"] == 1 for r in counts)
    assert write_bucketed(table.filter("false"), f"{name}_empty", 3, str(tmp_path / "e")).count() == 0
