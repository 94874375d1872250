"""Sources, sinks, calendar and backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query
from catalog.views import MISSED_DAY, VALID_SNAPSHOTS, days_for_dates, duck, plain, raw, raws, span
from riskmart.operators.profile import snapshot_counts as count_snapshots
from riskmart.plans import backfill, reruns
from riskmart.schemas import CLICKSTREAM_FEATURES, RAW_SCHEMAS
from riskmart.sources.calendar import month_starts
from riskmart.sources.scratch import Staging
from riskmart.sources.snapshots import footer_counts, read_snapshots, snapshot_range, write_snapshots


@query(duck("""
    select d.snapshot_date, count(o_orderkey) as row_count
    from (select cast(unnest(generate_series(min(snapshot_date), max(snapshot_date), interval 1 month)) as date)
                 as snapshot_date from orders_by_month) d
    left join orders_by_month o on o.snapshot_date = d.snapshot_date group by d.snapshot_date"""))
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = raw(spark, sf_dir, "orders_by_month")
    span = orders.agg(F.min("snapshot_date").alias("first"), F.max("snapshot_date").alias("last"))
    days = span.select(F.explode(month_starts(F.col("first"), F.col("last"))).alias("snapshot_date"))
    return days.join(count_snapshots(orders), "snapshot_date", "left").fillna(0)


@query(duck("select * from orders_by_month where snapshot_date between date '1997-01-01' and date '1998-06-01'"))
def snapshot_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_range(raw(spark, sf_dir, "orders_by_month"), "1997-01-01", "1998-06-01")


@query(duck("select snapshot_date, count(*) as row_count from orders_by_month group by snapshot_date"))
def snapshot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_snapshots(raw(spark, sf_dir, "orders_by_month"))


@query(duck("select snapshot_date, count(*) as row_count from orders_by_month where snapshot_date >= date '1997-01-01' group by snapshot_date"))
def stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of stored snapshots by their file footers."""
    root = Staging(spark).path("orders")
    write_snapshots(raw(spark, sf_dir, "orders_by_month"), root, rebalance=True)
    return footer_counts(spark, root, start="1997-01-01")


def datamart(spark: SparkSession, sf_dir: str, views: dict[str, DataFrame]) -> backfill.Datamart:
    """An empty datamart of all months of the views."""
    return backfill.Datamart(spark, Staging(spark).root, *span(spark, sf_dir, views["lines"]))


@query(duck("select * replace (cast(snapshot_date as date) as snapshot_date, nullif(paid_amt, '') as paid_amt) "
            "from raw_loans"))
def roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text written by snapshot and read back; an empty cell comes back as null."""
    views = raws(spark, sf_dir, ["lines", "raw_loans"])
    mart, loans = datamart(spark, sf_dir, views), views["raw_loans"]
    backfill.land_bronze(mart, {"loan_daily": loans.withColumn("paid_amt", F.nullif("paid_amt", F.lit("")))})
    return mart.bronze("loan_daily").select(RAW_SCHEMAS["loan_daily"].names)


@query(duck(f"select {MISSED_DAY} from loans where snapshot_date between date '1997-01-01' and date '1998-06-01'"))
def roundtrip_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver loans written by snapshot; a range of snapshots read back."""
    root = Staging(spark).path("loans")
    write_snapshots(backfill.silver_loans(raw(spark, sf_dir, "raw_loans")), root, rebalance=True)
    return plain(days_for_dates(read_snapshots(spark, root, start="1997-01-01", end="1998-06-01")))


@query(duck("""
    select * replace (case when snapshot_date = date '1997-03-01' then 'rerun' else o_orderpriority end
                      as o_orderpriority) from orders_by_month"""))
def overwrite_one_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All snapshots written, then one of them again with other values; the rest survive."""
    root = Staging(spark).path("orders")
    orders = raw(spark, sf_dir, "orders_by_month")
    write_snapshots(orders, root, rebalance=True)
    day = ("1997-03-01", "1997-03-01")
    rerun = snapshot_range(orders, *day).withColumn("o_orderpriority", F.lit("rerun"))
    write_snapshots(rerun, root, rebalance=True, span=day)
    return read_snapshots(spark, root)


@query(duck("select * from labels_mob6"))
def backfill_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw loans to the stored label store through every layer."""
    views = raws(spark, sf_dir, ["lines", "raw_loans"])
    mart = datamart(spark, sf_dir, views)
    backfill.land_bronze(mart, {"loan_daily": views["raw_loans"]})
    backfill.build_silver(mart, ["loan_daily"])
    backfill.build_labels(mart)
    return mart.gold(backfill.LABELS)


@query(duck("""
    select * replace (case when snapshot_date = date '1997-03-01' then 0 else label end as label),
           snapshot_date = date '1997-03-01' as rebuilt from labels_mob6"""))
def rerun_changed_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels from all months, then again after one month of loans was corrected; only that month is built again."""
    views = raws(spark, sf_dir, ["lines", "raw_loans"])
    mart, loans = datamart(spark, sf_dir, views), views["raw_loans"]
    reruns.refill(mart, {"loan_daily": loans})
    paid = F.when(F.col("snapshot_date") == "1997-03-01", "0.00").otherwise(F.col("overdue_amt"))
    rebuilt = reruns.refill(mart, {"loan_daily": loans.withColumn("overdue_amt", paid)})
    again = F.col("snapshot_date").cast("string").isin(rebuilt[f"gold/{backfill.LABELS}"])
    return mart.gold(backfill.LABELS).withColumn("rebuilt", again)


def stored_features(spark: SparkSession, sf_dir: str) -> backfill.Datamart:
    tables = ["financials", "attributes", "clickstream"]
    views = raws(spark, sf_dir, ["lines", *[f"raw_{t}" for t in tables]])
    mart = datamart(spark, sf_dir, views)
    backfill.land_bronze(mart, {t: views[f"raw_{t}"] for t in tables})
    backfill.build_silver(mart, tables)
    backfill.build_features(mart, VALID_SNAPSHOTS, exact=True)
    return mart


@query(duck(f"""
    select b.*, {', '.join(f'f.{c}' for c in CLICKSTREAM_FEATURES)}, f.Customer_ID is not null as in_full
    from base_gold b left join full_base_gold f
      on b.Customer_ID = f.Customer_ID and b.snapshot_date = f.snapshot_date"""))
def backfill_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sources to both stored feature stores; the full store's columns next to the baseline."""
    mart = stored_features(spark, sf_dir)
    full = mart.gold(backfill.FULL).select(
        "Customer_ID", "snapshot_date", *CLICKSTREAM_FEATURES, F.lit(True).alias("in_full")
    )
    joined = mart.gold(backfill.BASELINE).join(full, ["Customer_ID", "snapshot_date"], "left")
    return plain(joined.fillna(False, ["in_full"]))


_SOURCES = {"loan_daily": "raw_loans", "attributes": "raw_attributes", "financials": "raw_financials", "clickstream": "raw_clickstream"}
_LAYERS = (
    [(f"bronze/{t}", f"(select cast(snapshot_date as date) as snapshot_date from {view})") for t, view in _SOURCES.items()]
    + [(f"silver/{t}", {"loan_daily": "loans"}.get(t, t)) for t in _SOURCES]
    + [("gold/label_store", "labels_mob6"), ("gold/features_baseline", "base"), ("gold/features_full", "full_base")]
)


@query(duck(
    " union all ".join(f"select '{name}' as \"table\", snapshot_date, count(*) as row_count from {view} group by snapshot_date"
                       for name, view in _LAYERS)
    + "".join(f" union all select 'unreadable/{t}', null, count(case when try_cast(snapshot_date as date) is null then 1 end) "
              f"from {view}" for t, view in _SOURCES.items())))
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every stored table by snapshot, and raw rows whose date cannot be read."""
    views = raws(spark, sf_dir, ["lines", *_SOURCES.values()])
    mart = datamart(spark, sf_dir, views)
    sources = {t: views[view] for t, view in _SOURCES.items()}
    backfill.backfill(mart, sources, clickstream_snapshots=VALID_SNAPSHOTS)
    lost = backfill.unreadable_dates(sources).withColumn("table", F.concat(F.lit("unreadable/"), "table"))
    return backfill.layer_counts(mart).unionByName(lost.withColumn("snapshot_date", F.lit(None).cast("date")))
