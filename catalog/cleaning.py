"""Typing and cleaning of raw text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query
from catalog.views import (
    duck,
    duck_category,
    duck_float,
    duck_int,
    duck_loan_list,
    duck_months,
    plain,
    raw,
    table,
)
from riskmart.functions import cleaning as clean
from riskmart.operators import silver

KEYED = "Customer_ID, snapshot_date"


@query(duck("""
    select loan_id, trim(lower(Customer_ID)) as Customer_ID, cast(loan_start_date as date) as loan_start_date,
           cast(tenure as integer) as tenure, cast(trunc(cast(installment_num as double)) as integer)
           as installment_num, cast(cast(loan_amt as float) as double) as loan_amt,
           cast(cast(due_amt as float) as double) as due_amt, cast(try_cast(paid_amt as float) as double) as paid_amt,
           cast(cast(overdue_amt as float) as double) as overdue_amt,
           cast(cast(balance as float) as double) as balance, cast(snapshot_date as date) as snapshot_date
    from raw_loans_daily"""))
def type_enforce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan text typed; an empty amount is null."""
    return plain(silver.silver_loans_typed(raw(spark, sf_dir, "raw_loans_daily")))


@query(duck("select trim(lower(Customer_ID)) as Customer_ID, count(*) as row_count from raw_attributes group by 1"))
def key_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = silver.normalise_customer(raw(spark, sf_dir, "raw_attributes"))
    return keyed.groupBy("Customer_ID").agg(F.count("*").alias("row_count"))


@query(duck("select Customer_ID, Age, Occupation, snapshot_date from raw_attributes"))
def drop_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.drop_identity(raw(spark, sf_dir, "raw_attributes"))


@query(duck("select o_orderkey, o_orderpriority, "
            + duck_int("o_orderpriority") + " as as_int, "
            + duck_float("cast(o_custkey as varchar) || 'x.5_'") + " as as_float from orders"))
def clean_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    dirty = F.concat(F.col("o_custkey").cast("string"), F.lit("x.5_"))
    return orders.select(
        "o_orderkey",
        "o_orderpriority",
        clean.clean_number(F.col("o_orderpriority"), "int").alias("as_int"),
        clean.clean_number(dirty, "float").cast("double").alias("as_float"),
    )


_SEGMENT = "case c_nationkey when 1 then null when 2 then '' when 3 then '  ' when 4 then '_______' " \
           "when 5 then '!@9#%8' else ' ' || c_mktsegment || ' ' end"


@query(f"select c_custkey, {duck_category(f'({_SEGMENT})')} as segment from customer")
def clean_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", clean.clean_category(F.expr(_SEGMENT)).alias("segment")
    )


_LOAN_LIST = "p_name || ' and ' || p_type || ', ' || p_name || ',, Not Specified'"


@query(f"select p_partkey, {duck_loan_list(f'({_LOAN_LIST})')} as loans from part")
def clean_loan_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", clean.clean_loan_list(F.expr(_LOAN_LIST)).alias("loans")
    )


_HISTORY = "case when p_size = 1 then null when p_size = 2 then 'NA' when p_size = 3 then '1 Year and 3 Months' " \
           "else cast(p_size as string) || ' Years and ' || cast(p_partkey % 12 as string) || ' Months' end"


@query(f"select p_partkey, {duck_months(f'({_HISTORY})')} as months from part")
def history_to_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", clean.history_months(F.expr(_HISTORY)).alias("months")
    )


@query(duck(f"""
    select {KEYED}, case when trim(lower(Payment_of_Min_Amount)) in ('yes', 'no')
           then trim(lower(Payment_of_Min_Amount)) else 'na' end as min_amount from raw_financials"""))
def min_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "raw_financials").select(
        "Customer_ID", "snapshot_date", clean.clean_min_amount(F.col("Payment_of_Min_Amount")).alias("min_amount")
    )


@query(duck(f"""
    select {KEYED}, case when lower(Payment_Behaviour) like '%_value_payments' then lower(Payment_Behaviour)
           else 'unknown' end as behaviour from raw_financials"""))
def behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "raw_financials").select(
        "Customer_ID", "snapshot_date", clean.clean_behaviour(F.col("Payment_Behaviour")).alias("behaviour")
    )


@query(duck("select * from financials"))
def silver_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver.silver_financials(raw(spark, sf_dir, "raw_financials")))


@query(duck("select * from attributes"))
def silver_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_attributes(raw(spark, sf_dir, "raw_attributes"))


@query(duck("select * from clickstream"))
def silver_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(silver.silver_clickstream(raw(spark, sf_dir, "raw_clickstream")))
