"""What keeps the jobs in proportion to their input: shared views, packed text, casts that do not throw, compiled stages."""

from pathlib import Path

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from catalog import views
from riskmart.functions.cleaning import as_type, clean_number, history_months, number_of
from riskmart.operators.silver import enforce_types
from riskmart.settings import METHOD_LIMIT
from riskmart.sources.scratch import compiled
from riskmart.sources.snapshots import read_snapshots, write_snapshots

TABLES = {
    "orders": (
        "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double",
        "(1, 7, timestamp'1997-01-05 00:00:00', 100.0D), (2, 7, timestamp'1997-01-09 00:00:00', 50.0D), (3, 8, null, 10.0D), (4, null, timestamp'1997-02-01 00:00:00', null)",
    ),
    "lineitem": (
        "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        "(1, 1, 4.0D, 10.0D, 0.0D, 0.02D, 'R', 'F', timestamp'1997-02-05 00:00:00'), (1, 6, 5.0D, 20.0D, 0.01D, 0.0D, 'N', 'O', null), "
        "(2, 6, 9.0D, 30.0D, 0.05D, 0.01D, 'A', 'F', timestamp'1997-03-05 00:00:00'), (3, 6, null, 5.0D, null, null, null, 'F', timestamp'1997-03-05 00:00:00'), "
        "(4, 2, 1.0D, 1.0D, 0.02D, 0.0D, 'N', 'F', timestamp'1997-04-05 00:00:00'), (9, 1, 1.0D, 1.0D, 0.0D, 0.0D, 'N', 'F', timestamp'1997-04-05 00:00:00')",
    ),
    "customer": (
        "c_custkey long, c_name string, c_acctbal double, c_nationkey int, c_mktsegment string",
        "(7, 'a', 9500.0D, 3, 'MACHINERY'), (8, 'b', 1.0D, 4, 'BUILDING')",
    ),
    "events": ("user_id long, ts timestamp, value double", "(7, timestamp'1997-01-01 05:00:00', 3.0D), (7, timestamp'1997-01-01 19:00:00', 60.0D)"),
}


def stored_tables(spark, folder):
    for name, (schema, rows) in TABLES.items():
        names = [column.split()[0] for column in schema.split(", ")]
        columns = [F.col(n).cast(kind.split()[1]).alias(n) for n, kind in zip(names, schema.split(", "))]
        spark.sql(f"select * from values {rows} as t({', '.join(names)})").select(columns).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_shared_views_are_the_views_without_their_joins(spark, tmp_path):
    folder = stored_tables(spark, tmp_path)
    names = ["lines", "raw_loans", "raw_financials", "raw_attributes", "raw_clickstream"]
    shared = views.raws(spark, folder, names)
    for name in names:
        assertDataFrameEqual(shared[name], views.raw(spark, folder, name))
        assert shared[name].count() > 0
        plan = shared[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "lineitem.parquet" not in plan and "l_orderkey" not in plan
    assert "Join" not in shared["raw_loans"]._jdf.queryExecution().optimizedPlan().toString()
    assert views.span(spark, folder, shared["lines"]) == views.span(spark, folder)


def test_bronze_text_is_packed_and_reads_back(spark, tmp_path):
    rows = spark.createDataFrame([(" a ", "", "1997-01-01"), ('x,"y', None, "1997-01-01"), ("5_", "0", "1997-02-01")], "k string, v string, snapshot_date string")
    rows = rows.withColumn("snapshot_date", F.col("snapshot_date").cast("date"))
    root = str(tmp_path / "bronze")
    write_snapshots(rows, root, "csv", rebalance=True)
    files = [f for f in Path(root).rglob("part-*") if not f.name.startswith(".")]
    assert files and all(f.name.endswith(".csv.gz") and f.read_bytes()[:2] == b"\x1f\x8b" for f in files)
    back = read_snapshots(spark, root, "csv", rows.schema)
    assertDataFrameEqual(back, rows.withColumn("v", F.nullif("v", F.lit(""))))


ODD = ["", " ", "_", "n/a", "NaN", "nan", " inf", "-Infinity", "+INF", "1e3", "1d", "5-", ".", "-", "--5", "0x1p3", "٣", "1,000", "12_", "-.5", "null", "true", None]


def test_numbers_of_odd_text_are_those_of_the_plain_cast(spark):
    rows = spark.createDataFrame([(t,) for t in ODD], "t string")
    for kind in ("int", "float", "double"):
        plain = as_type(F.col("t"), kind)
        stripped = as_type(F.regexp_replace("t", r"[^0-9.\-]", ""), kind)
        stripped = F.round(stripped, 2) if kind == "float" else stripped
        found = rows.select(number_of(F.col("t"), kind).cast("string"), plain.cast("string"), clean_number(F.col("t"), kind).cast("string"), stripped.cast("string")).collect()
        for text, (guarded, cast, cleaned, unguarded) in zip(ODD, found):
            assert guarded == cast, (kind, text)
            assert cleaned == unguarded, (kind, text)
    assert [r[0] for r in rows.select(history_months(F.col("t"))).collect()] == [0] * len(ODD)


def test_columns_that_are_no_text_are_cast_as_they_are(spark):
    rows = spark.createDataFrame([(True, 2.7), (None, float("nan"))], "a boolean, b double")
    assert [tuple(r) for r in enforce_types(rows, {"a": "float", "b": "int"}).collect()] == [(1.0, 2), (None, None)]


def test_method_limit_holds_within_a_write_only(spark):
    name, limit = METHOD_LIMIT
    before = spark.conf.get(name)
    with compiled(spark):
        assert int(spark.conf.get(name)) == min(int(limit), int(before))
    assert spark.conf.get(name) == before
