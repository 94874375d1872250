"""Feature joins, repairs, clamping, encodings, ratios and the feature stores."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query
from catalog.views import VALID_SNAPSHOTS, duck, duck_round, plain, raw, raws, table
from riskmart.functions import encoding
from riskmart.operators import features, silver
from riskmart.operators.joins import lookup
from riskmart.schemas import CLICKSTREAM_FEATURES
from riskmart.sources.bucketed import write_bucketed
from riskmart.sources.scratch import Staging


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_financials(raw(spark, sf_dir, "raw_financials"))


def stored(spark: SparkSession, sf_dir: str, source: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """The silver table of a feature source, written and read back as the layers do."""
    view = views[f"raw_{source}"] if views else raw(spark, sf_dir, f"raw_{source}")
    build = {
        "financials": silver.silver_financials,
        "attributes": silver.silver_attributes,
        "clickstream": silver.silver_clickstream,
    }[source]
    return Staging(spark).table(build(view), source)


def base(spark: SparkSession, sf_dir: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    views = views or raws(spark, sf_dir, ["raw_financials", "raw_attributes"])
    return features.join_attributes(stored(spark, sf_dir, "financials", views), stored(spark, sf_dir, "attributes", views))


def full_base(spark: SparkSession, sf_dir: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    views = views or raws(spark, sf_dir, ["raw_financials", "raw_attributes", "raw_clickstream"])
    financials, attributes, clickstream = (
        features.in_snapshots(stored(spark, sf_dir, source, views), VALID_SNAPSHOTS)
        for source in ("financials", "attributes", "clickstream")
    )
    joined = features.join_clickstream(features.join_attributes(financials, attributes), clickstream)
    return features.pad_clickstream(joined)


def gold(spark: SparkSession, sf_dir: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """The baseline feature store, its base written by snapshot first."""
    stored = Staging(spark).table(base(spark, sf_dir, views), "base", "snapshot_date")
    return features.feature_table(stored, exact=True)


@query(duck("select * from base"))
def feature_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(base(spark, sf_dir))


def bucketed(spark: SparkSession, sf_dir: str, source: str, buckets: int) -> DataFrame:
    """The silver table of a feature source in buckets by customer, under a name of its own in the catalogue."""
    name = f"{source}_{uuid.uuid4().hex}"
    return write_bucketed(stored(spark, sf_dir, source), name, buckets, Staging(spark).path(name))


@query(duck("select * from base"))
def feature_base_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined base from bucketed tables; only their writing shuffles."""
    financials, attributes = (bucketed(spark, sf_dir, source, 4) for source in ("financials", "attributes"))
    return plain(features.join_attributes(financials, attributes))


@query(duck("select * from full_base"))
def feature_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(full_base(spark, sf_dir))


@query(duck("select *, " + ", ".join(f"cast(null as double) as {c}" for c in CLICKSTREAM_FEATURES) + " from attributes"))
def pad_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clickstream columns added to a table that has none of them."""
    return features.pad_clickstream(silver.silver_attributes(raw(spark, sf_dir, "raw_attributes")))


@query(duck("select * exclude (Age, Occupation, Credit_Mix, Payment_of_Min_Amount, Payment_Behaviour, "
            "Credit_Utilization_Ratio) from base_fixed"))
def fix_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = features.fix_negatives(financials(spark, sf_dir))
    return plain(fixed.select("Customer_ID", *features.CLAMP_COLUMNS, "snapshot_date"))


_CLAMPED = """
    select c_custkey, c_mktsegment,
           case when c_acctbal < lo then lo when c_acctbal > hi then hi else c_acctbal end as c_acctbal
    from customer
    join (select c_mktsegment, quantile_disc(c_acctbal, 0.01) as lo, quantile_disc(c_acctbal, 0.99) as hi
          from customer group by c_mktsegment) b using (c_mktsegment)"""


@query(_CLAMPED)
def clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return features.clamp_outliers(customers, ["c_acctbal"], ["c_mktsegment"], exact=True)


@query("""
    select l_orderkey, l_linenumber, l_returnflag,
           case when l_extendedprice < lo then lo when l_extendedprice > hi then hi else l_extendedprice end
               as l_extendedprice,
           case when l_quantity < qlo then qlo when l_quantity > qhi then qhi else l_quantity end as l_quantity
    from lineitem
    join (select l_returnflag, quantile_disc(l_extendedprice, 0.01) as lo, quantile_disc(l_extendedprice, 0.99) as hi,
                 quantile_disc(l_quantity, 0.01) as qlo, quantile_disc(l_quantity, 0.99) as qhi
          from lineitem group by l_returnflag) b using (l_returnflag)""")
def clamp_large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three groups of a third of the rows each, bounds by counting passes alone."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_quantity"
    )
    return features.clamp_outliers(lines, ["l_extendedprice", "l_quantity"], ["l_returnflag"], exact=True)


@query(duck("""
    select Customer_ID, snapshot_date,
           case Credit_Mix when 'bad' then 0 when 'standard' then 1 when 'good' then 2 else -1 end as credit_mix
    from financials"""))
def encode_credit_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = encoding.credit_mix_code(F.col("Credit_Mix"))
    return financials(spark, sf_dir).select("Customer_ID", "snapshot_date", code.alias("credit_mix"))


@query(duck("""
    select Customer_ID, snapshot_date, case Payment_of_Min_Amount when 'yes' then 1 when 'no' then 0 else -1 end
           as min_amount from financials"""))
def encode_min_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = encoding.min_amount_code(F.col("Payment_of_Min_Amount"))
    return financials(spark, sf_dir).select("Customer_ID", "snapshot_date", code.alias("min_amount"))


@query(duck("select Customer_ID, snapshot_date, pb_spent_level, pb_payment_size from base_gold"))
def encode_behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("Payment_Behaviour")
    return financials(spark, sf_dir).select(
        "Customer_ID",
        "snapshot_date",
        encoding.spent_level_code(text).alias("pb_spent_level"),
        encoding.payment_size_code(text).alias("pb_payment_size"),
    )


@query(duck("select Customer_ID, snapshot_date, Occupation_encoded from base_gold"))
def encode_occupation(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.encode_categories(base(spark, sf_dir))
    return df.select("Customer_ID", "snapshot_date", "Occupation_encoded")


_RATIO_INPUTS = """select l_orderkey, l_linenumber, l_extendedprice as Outstanding_Debt,
    l_quantity * 1000 - 2000 as Annual_Income, l_quantity as Total_EMI_per_month,
    l_discount * 1000 - 10 as Monthly_Inhand_Salary, l_tax * 100 as Amount_invested_monthly,
    l_linenumber as Delay_from_due_date, l_quantity as Num_of_Delayed_Payment,
    l_quantity as Num_of_Loan, l_linenumber - 2 as Num_Credit_Card from lineitem"""


def _rounded_ratio(top: str, bottom: str) -> str:
    return f"case when {bottom} > 0 then {duck_round(f'{top} / {bottom}', 4)} end"


@query(f"""
    select *, {_rounded_ratio("Outstanding_Debt", "Annual_Income")} as debt_to_income,
           {_rounded_ratio("Total_EMI_per_month", "Monthly_Inhand_Salary")} as emi_to_salary,
           {_rounded_ratio("Amount_invested_monthly", "Monthly_Inhand_Salary")} as savings_rate,
           Delay_from_due_date * Num_of_Delayed_Payment as payment_stress,
           {_rounded_ratio("Num_of_Loan", "Num_Credit_Card")} as loans_per_credit_card,
           {duck_round("(Monthly_Inhand_Salary - Total_EMI_per_month)", 2)} as monthly_surplus
    from ({_RATIO_INPUTS})""")
def ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.sql(_RATIO_INPUTS.replace("from lineitem", "from {lineitem}"),
                      lineitem=table(spark, sf_dir, "lineitem"))
    return features.add_ratios(lines)


@query(duck("select * from base_gold"))
def gold_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(gold(spark, sf_dir))


@query(duck("select * from full_base_gold"))
def gold_features_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = Staging(spark).table(full_base(spark, sf_dir), "full", "snapshot_date")
    return plain(features.feature_table(stored, exact=True))


_CLAMPED_NAMES = [c for c in features.CLAMP_COLUMNS if c not in CLICKSTREAM_FEATURES]


@query(duck(" union all ".join(
    f"select snapshot_date, '{c}' as \"column\", true as low_within, true as high_within from base_fixed "
    f"group by snapshot_date having count({c}) > 0" for c in _CLAMPED_NAMES)))
def gold_features_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the approximate bounds of the default run are as near to their ranks as promised."""
    stored = Staging(spark).table(features.fix_negatives(base(spark, sf_dir)), "base", "snapshot_date")
    bounds = features.clamp_bounds(stored, _CLAMPED_NAMES)
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in _CLAMPED_NAMES]
    limits = [F.struct(F.lit(c).alias("column"), F.col(c).alias("bounds")) for c in _CLAMPED_NAMES]
    long = stored.select("snapshot_date", F.inline(F.array(*entries))).filter("v is not null")
    near = lookup(long, bounds.select("snapshot_date", F.inline(F.array(*limits))), ["snapshot_date", "column"])

    def within(i: int, share: float) -> Column:
        n, slack = F.count("*"), 0.001 * F.count("*") + 1
        bound = F.col("bounds")[i]
        return (F.count_if(F.col("v") < bound) <= share * n + slack) & (F.count_if(F.col("v") <= bound) >= share * n - slack)

    return near.groupBy("snapshot_date", "column").agg(within(0, 0.01).alias("low_within"), within(1, 0.99).alias("high_within"))
