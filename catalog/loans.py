"""Delinquency, labels and bad rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query
from catalog.views import MISSED_DAY, days_for_dates, duck, plain, raw
from riskmart.functions.delinquency import loan_open_date as open_date
from riskmart.operators import loans
from riskmart.plans.backfill import silver_loans


def daily_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_loans(raw(spark, sf_dir, "raw_loans_daily"))


def monthly_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_loans(raw(spark, sf_dir, "raw_loans"))


@query(duck(f"select {MISSED_DAY} from loans_daily"))
def loan_dpd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(days_for_dates(daily_loans(spark, sf_dir)))


@query(duck("select * from labels_mob6"))
def label_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans.label_store(monthly_loans(spark, sf_dir), dpd=30, mob=6)


@query(duck("""
    select loan_id, Customer_ID, case when dpd >= 60 then 1 else 0 end as label, '60dpd_4mob' as label_def,
           snapshot_date from loans where mob = 4"""))
def label_store_other_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loans.label_store(monthly_loans(spark, sf_dir), dpd=60, mob=4)


@query(duck("""
    select mob, avg(case when dpd >= 30 then 1 else 0 end) as bad_rate
    from loans where loan_start_date < date '2000-01-01' group by mob"""))
def bad_rate_by_mob(spark: SparkSession, sf_dir: str) -> DataFrame:
    started = loans.started_before(monthly_loans(spark, sf_dir), "2000-01-01")
    return loans.bad_rate_by_mob(started, dpd=30)


@query(duck("""
    select loan_id, dpd, case when dpd >= 30 then 1 else 0 end as dpd_flag
    from loans where installment_num = 7"""))
def terminal_delinquency(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = loans.flag_delinquent(monthly_loans(spark, sf_dir), 30)
    return loans.at_installment(flagged, 7).select("loan_id", "dpd", "dpd_flag")


@query(duck("""
    select loan_id, case when split_part(loan_id, '_', 4) <> ''
           then cast(split_part(loan_id, '_', 3) || '-' || split_part(loan_id, '_', 4) || '-'
                     || split_part(loan_id, '_', 5) as date) end as opened, count(*) as row_count
    from (select case when mob = 7 then left(loan_id, 8) else loan_id end as loan_id from loans)
    group by loan_id"""))
def loan_open_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open dates out of loan ids, some of them cut short."""
    cut = F.when(F.col("mob") == 7, F.left("loan_id", F.lit(8))).otherwise(F.col("loan_id"))
    ids = monthly_loans(spark, sf_dir).groupBy(cut.alias("loan_id")).agg(F.count("*").alias("row_count"))
    return ids.withColumn("opened", open_date(F.col("loan_id")))
