from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.schemas import RAW_ATTRIBUTES
from riskmart.sources.calendar import snapshot_calendar
from riskmart.sources.scratch import Staging, settled, shared_folder
from riskmart.sources import snapshots
from riskmart.sources.snapshots import (
    read_raw,
    read_snapshots,
    snapshot_range,
    stored_snapshots,
    write_result,
    write_snapshots,
)


def months(spark, *rows):
    return spark.createDataFrame([(v, date.fromisoformat(d)) for v, d in rows], "v string, snapshot_date date")


@pytest.mark.parametrize(
    "start, end, count", [("2023-01-15", "2024-12-01", 24), ("2023-01-01", "2023-01-01", 1), ("2024-01-01", "2023-01-01", 0)]
)
def test_calendar(spark, start, end, count):
    days = [r[0] for r in snapshot_calendar(spark, start, end).collect()]
    assert len(days) == count
    assert all(d.day == 1 for d in days)
    assert days[:1] == ([date.fromisoformat(start).replace(day=1)] if count else [])


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_rerun_replaces_only_its_snapshots(spark, tmp_path, fmt):
    root = str(tmp_path / "t")
    df = months(spark, ("a", "2023-01-01"), (" b ", "2023-02-01"), (None, "2023-02-01"), ("c", "2023-03-01"))
    write_snapshots(df, root, fmt, rebalance=True)
    write_snapshots(months(spark, ("x", "2023-02-01")), root, fmt, rebalance=True)
    have = read_snapshots(spark, root, fmt, df.schema).collect()
    assert sorted((r["v"], str(r["snapshot_date"])) for r in have) == [
        ("a", "2023-01-01"), ("c", "2023-03-01"), ("x", "2023-02-01"),
    ]


class Stopped(Exception):
    pass


def stop_at(monkeypatch, name, call):
    """Stop the next write at the given call of a step."""
    step, calls = getattr(snapshots, name), []

    def stopping(*args, **kwargs):
        calls.append(args)
        if len(calls) == call:
            raise Stopped
        return step(*args, **kwargs)

    monkeypatch.setattr(snapshots, name, stopping)


def content(df):
    return sorted((r["v"], str(r["snapshot_date"])) for r in df.collect())


# Moves and deletions in the order of a write: all up to the move of the journal into its place, and all after it.
STEPS = [("_note", 1, "before"), ("_move", 1, "before"), ("delete_path", 1, "before"), ("_move", 2, "after"), ("_move", 3, "after"),
         *[("delete_path", i, "after") for i in range(2, 7)]]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
@pytest.mark.parametrize("name, call, state", STEPS)
def test_a_stopped_write_leaves_one_state(spark, tmp_path, monkeypatch, fmt, name, call, state):
    root = str(tmp_path / "t")
    df = months(spark, ("a", "2023-01-01"), ("b", "2023-02-01"), ("c", "2023-03-01"), ("d", "2023-05-01"))
    write_snapshots(df, root, fmt)
    rerun = months(spark, ("x", "2023-02-01"), ("y", "2023-04-01"))
    with monkeypatch.context() as patch:
        stop_at(patch, name, call)
        with pytest.raises(Stopped):
            write_snapshots(rerun, root, fmt, span=("2023-02-01", "2023-04-01"))
    before = [("a", "2023-01-01"), ("b", "2023-02-01"), ("c", "2023-03-01"), ("d", "2023-05-01")]
    after = [("a", "2023-01-01"), ("d", "2023-05-01"), ("x", "2023-02-01"), ("y", "2023-04-01")]
    want = before if state == "before" else after
    read = read_snapshots(spark, root, fmt, df.schema)
    assert content(read) == want
    assert sorted(stored_snapshots(spark, root)) == sorted(day for _, day in want)
    if fmt == "parquet":
        # The next write, of rows read from where the stopped one left them, settles it.
        write_snapshots(read.filter("snapshot_date = '2023-02-01'").withColumn("v", F.upper("v")), root)
        want = [(v.upper() if day == "2023-02-01" else v, day) for v, day in want]
    else:
        snapshots.settle_writes(spark, root)
    assert content(read_snapshots(spark, root, fmt, df.schema)) == sorted(want)
    assert {p.name for p in (tmp_path / "t").iterdir()} == {f"snapshot_date={day}" for _, day in want}


def test_a_first_write_that_stopped(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    for name, call, found in (("_note", 1, False), ("_move", 2, True)):
        with monkeypatch.context() as patch:
            stop_at(patch, name, call)
            with pytest.raises(Stopped):
                write_snapshots(months(spark, ("a", "2023-01-01")), root)
        assert bool(stored_snapshots(spark, root)) == found
    assert content(read_snapshots(spark, root)) == [("a", "2023-01-01")]


def test_rows_without_a_snapshot_are_replaced_and_removed_by_day(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    write_snapshots(spark.createDataFrame([("a", None), ("b", date(2023, 1, 1))], "v string, snapshot_date date"), root)
    with monkeypatch.context() as patch:
        stop_at(patch, "_move", 2)
        with pytest.raises(Stopped):
            write_snapshots(spark.createDataFrame([("n", None)], "v string, snapshot_date date"), root, days=["2023-01-01", "2023-02-01"])
    assert content(read_snapshots(spark, root)) == [("n", "None")]
    snapshots.settle_writes(spark, root)
    assert content(read_snapshots(spark, root)) == [("n", "None")]


def test_csv_keeps_blanks_and_reads_empty_cells_as_null(spark, tmp_path):
    root = str(tmp_path / "t")
    df = months(spark, (" b ", "2023-01-01"), (None, "2023-01-01"), ("", "2023-01-01"), ('say "hi", ok', "2023-01-01"))
    write_snapshots(df, root, "csv")
    have = {r["v"] for r in read_snapshots(spark, root, "csv", df.schema).collect()}
    assert have == {" b ", None, 'say "hi", ok'}


def test_rerun_drops_a_snapshot_without_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshots(months(spark, ("a", "2023-01-01"), ("b", "2023-02-01"), ("c", "2023-03-01")), root)
    write_snapshots(months(spark, ("x", "2023-01-01")), root, span=("2023-01-01", "2023-02-01"))
    assert sorted(stored_snapshots(spark, root)) == ["2023-01-01", "2023-03-01"]
    write_snapshots(months(spark, ("x", "2023-01-01")).limit(0), root, span=("2023-01-01", "2023-02-01"))
    assert sorted(stored_snapshots(spark, root)) == ["2023-03-01"]


def test_reading_a_range_prunes_partitions(spark, tmp_path):
    root = str(tmp_path / "t")
    write_snapshots(months(spark, ("a", "2023-01-01"), ("b", "2023-02-01"), ("c", "2023-03-01")), root)
    df = read_snapshots(spark, root, start="2023-02-01", end="2023-03-01")
    assert dict(df.dtypes)["snapshot_date"] == "date"
    assert sorted(r["v"] for r in df.collect()) == ["b", "c"]
    assert len(df.inputFiles()) == 3 and "PartitionFilters: [isnotnull(snapshot_date" in (
        df._jdf.queryExecution().executedPlan().toString()
    )


def test_missing_root(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_snapshots(spark, str(tmp_path / "none"))


def test_raw_columns_are_matched_by_name_and_stay_text(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("snapshot_date,Age,Customer_ID,Name,SSN,Occupation\n2023-01-01,23_,CUS_0x1,A B,1,Lawyer\n")
    df = read_raw(spark, str(path), RAW_ATTRIBUTES)
    assert df.schema == RAW_ATTRIBUTES
    assert df.first()["Age"] == "23_"
    assert snapshot_range(df, "2023-01-01", "2023-01-01").count() == 1
    assert snapshot_range(df, "2023-01-02").count() == 0
    path.write_text("Age,Customer_ID\n1,2\n")
    with pytest.raises(ValueError, match="Occupation"):
        read_raw(spark, str(path), RAW_ATTRIBUTES)


def test_write_result_is_one_file(spark, tmp_path):
    write_result(spark.range(100).repartition(8), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("*.csv"))) == 1


def test_staging_reads_back_and_cleans_up(spark):
    with Staging(spark) as staging:
        df = staging.table(spark.range(10).withColumn("snapshot_date", F.lit("2023-01-01").cast("date")), "t", "snapshot_date")
        assert df.columns == ["id", "snapshot_date"] and df.count() == 10
        root = staging.root
    assert stored_snapshots(spark, root + "/t") == {}


def test_settled_is_computed_once_and_its_size_is_known(spark):
    df = settled(spark.range(6).select(F.col("id").cast("string").alias("id"), F.rand().alias("x")))
    assert sorted(df.collect()) == sorted(df.collect()) and df.count() == 6
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert 0 < size < 10_000


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), type("Conf", (), {"get": staticmethod(lambda *_: None)})

    with pytest.raises(ValueError, match="shared"):
        shared_folder(Session())


def test_raw_files_are_read_by_their_own_headers(spark, tmp_path):
    schema = "Name string, Age string"
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text('Name,Age\nn1, 20\n"x, y",\n')
    (folder / "b.csv").write_text("Age,extra,Name\n30,e,n2\n")
    (folder / "empty.csv").write_text("")
    wanted = spark.createDataFrame([], schema).schema
    found = sorted(tuple(r) for r in read_raw(spark, str(folder), wanted).collect())
    assert found == [("n1", " 20"), ("n2", "30"), ("x, y", None)]
    assert read_raw(spark, str(folder / "b.csv"), wanted).collect()[0]["Name"] == "n2"
    (folder / "c.csv").write_text("Name\nn3\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        read_raw(spark, str(folder), wanted)
