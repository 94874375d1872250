"""Training set, fitted statistics, model quality and the model itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import query
from catalog.features import full_base, gold
from catalog.views import TRAIN_END, VALID_SNAPSHOTS, duck, plain, raw, raws
from riskmart.operators import features, metrics, model, profile, training
from riskmart.operators.features import CLAMP_COLUMNS
from riskmart.operators.loans import label_store
from riskmart.plans.backfill import silver_loans
from riskmart.plans.modelling import Evaluation
from riskmart.plans.modelling import train_evaluate as run_train_evaluate
from riskmart.sources.scratch import Staging
from riskmart.sources.snapshots import write_result


def stores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The baseline feature store and the label store, written."""
    views = raws(spark, sf_dir, ["raw_financials", "raw_attributes", "raw_loans"])
    staging = Staging(spark)
    store = staging.table(gold(spark, sf_dir, views), "gold")
    return store, staging.table(label_store(silver_loans(views["raw_loans"])), "labels")


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Staging(spark).table(training.training_set(*stores(spark, sf_dir)), "training")


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.chronological_split(merged(spark, sf_dir), TRAIN_END)[0]


@query(duck("select * from training"))
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(merged(spark, sf_dir))


@query(duck("select label, count(*) as row_count, count(*) / (select count(*) from training) * 100 as pct "
            "from training group by label"))
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distribution(merged(spark, sf_dir))


@query(duck(f"""
    select case when label_obs_date <= date '{TRAIN_END}' then 'train' else 'test' end as split, label_obs_date,
           count(*) as row_count from training group by 1, 2"""))
def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = training.chronological_split(merged(spark, sf_dir), TRAIN_END)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.groupBy("split", "label_obs_date").agg(F.count("*").alias("row_count"))


# Columns of the baseline store that the model reads.
_MODEL_FEATURES = ["Age", "Credit_Utilization_Ratio", *CLAMP_COLUMNS, "Credit_Mix_encoded",
                   "Payment_of_Min_Amount_encoded", "pb_spent_level", "pb_payment_size", "Occupation_encoded",
                   "debt_to_income", "emi_to_salary", "savings_rate", "payment_stress", "loans_per_credit_card",
                   "monthly_surplus"]
_LONG = f"""(from (select {", ".join(f"cast({c} as double) as {c}" for c in _MODEL_FEATURES)} from training
    where label_obs_date <= date '{TRAIN_END}') unpivot include nulls (v for feature in ({", ".join(_MODEL_FEATURES)})))"""


@query(duck(f"""
    select feature, round(low, 4) as low, round(high, 4) as high, round(fill, 4) as median,
           round(avg(prepared), 4) as mean, round(stddev_pop(prepared), 4) as std
    from (select u.feature, low, high, fill, case when v < low then low when v > high then high
                 else coalesce(v, fill) end as prepared
          from {_LONG} u join (select feature, quantile_cont(v, 0.01) as low, quantile_cont(v, 0.99) as high,
                                      median(v) as fill from {_LONG} group by feature) q on u.feature = q.feature)
    group by feature, low, high, fill"""))
def fit_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = train_rows(spark, sf_dir)
    stats = model.stats_table(spark, model.fit_stats(train, training.feature_columns(train)))
    return stats.select("feature", *[F.round(c, 4).alias(c) for c in ("low", "high", "median", "mean", "std")])


@query(duck(f"""
    select label, (select count(*) from training where label_obs_date <= date '{TRAIN_END}') / (2 * count(*)) as weight
    from training where label_obs_date <= date '{TRAIN_END}' group by label"""))
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = model.class_weights(model.class_counts(train_rows(spark, sf_dir)))
    return spark.createDataFrame(list(weights.items()), "label int, weight double")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a label and a score that both engines compute alike."""
    return raw(spark, sf_dir, "scored")


@query(duck("select avg(case when label = prediction then 1 else 0 end) as accuracy from scored"))
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.accuracy(scored(spark, sf_dir))


@query(duck("select label, prediction, count(*) as row_count from scored group by label, prediction"))
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(scored(spark, sf_dir))


_CLASSES = """(select cast(c as varchar) as class, hits / predicted as precision, hits / support as recall,
           2 * hits / (predicted + support) as f1, support
    from (select c, count(case when label = c and prediction = c then 1 end) as hits,
                 count(case when prediction = c then 1 end) as predicted,
                 count(case when label = c then 1 end) as support
          from scored, (select unnest([0, 1]) as c) group by c))"""


@query(duck(f"""
    select class, round(precision, 10) as precision, round(recall, 10) as recall, round(f1, 10) as f1, support
    from {_CLASSES}
    union all select 'macro avg', round(avg(precision), 10), round(avg(recall), 10), round(avg(f1), 10),
        cast(sum(support) as bigint) from {_CLASSES}
    union all select 'weighted avg', round(sum(precision * support) / sum(support), 10),
        round(sum(recall * support) / sum(support), 10), round(sum(f1 * support) / sum(support), 10),
        cast(sum(support) as bigint) from {_CLASSES}"""))
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.class_report(scored(spark, sf_dir))
    return report.withColumns({c: F.round(c, 10) for c in ("precision", "recall", "f1")})


@query(duck("""
    select round(sum(positives * (lower_negatives + negatives / 2)) / (sum(positives) * sum(negatives)), 8) as roc_auc
    from (select positives, negatives,
                 sum(negatives) over (order by probability) - negatives as lower_negatives
          from (select probability, count(case when label = 1 then 1 end) as positives,
                       count(case when label = 0 then 1 end) as negatives from scored group by probability))"""))
def auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.area_under_roc(scored(spark, sf_dir)).select(F.round("roc_auc", 8).alias("roc_auc"))


def evaluated(spark: SparkSession, sf_dir: str, solver: str = "lbfgs") -> Evaluation:
    return run_train_evaluate(*stores(spark, sf_dir), "baseline", TRAIN_END, solver=solver)


def _newton_sql(wanted: str, steps: int = 12) -> str:
    """SQL over ``scaled`` (test rows and train rows with x0, the constant, x1, ...) and ``fitted`` (beta), by Newton steps.

    Each step of the recursion adds up gradient and Hessian and solves for the step by Gauss and Jordan's elimination.
    """
    names, places = sorted(_MODEL_FEATURES), range(len(_MODEL_FEATURES) + 1)
    xs = [f"(coalesce(case when {c} < lows[{i}] then lows[{i}] when {c} > highs[{i}] then highs[{i}] else {c} end, fills[{i}]) - means[{i}])"
          f" / case when stds[{i}] > 0 then stds[{i}] else 1 end as x{i}" for i, c in enumerate(names, 1)]
    z = " + ".join(f"beta[{i + 1}] * x{i}" for i in places)
    # The penalty leaves the constant alone.
    row = [", ".join([f"sum(h * x{i} * x{j})" + (" + 1" if i == j > 0 else "") for j in places]
                     + [f"sum(g * x{i})" + (f" + any_value(beta[{i + 1}])" if i > 0 else "")]) for i in places]
    system = "[" + ", ".join(f"[{r}]" for r in row) + "]"
    size = len(places)
    swept = f"""list_reduce([[[cast(k as double)]] for k in range(1, {size + 1})], lambda m, k:
        list_transform(m, lambda r, i: case when i = k[1][1] then r else
            list_transform(r, lambda v, j: v - r[cast(k[1][1] as int)] / m[cast(k[1][1] as int)][cast(k[1][1] as int)] * m[cast(k[1][1] as int)][j]) end), m)"""
    return duck(f"""
    , wide as materialized (select Customer_ID, label_obs_date, label, {", ".join(f"cast({c} as double) as {c}" for c in names)} from training),
    quantiles as materialized (select feature, quantile_cont(v, 0.01) as low, quantile_cont(v, 0.99) as high, median(v) as fill
        from {_LONG.replace("from training", "from wide")} group by feature),
    stats as materialized (select list(low order by feature) as lows, list(high order by feature) as highs, list(fill order by feature) as fills,
            list(mean order by feature) as means, list(std order by feature) as stds
        from (select feature, low, high, fill, avg(prepared) as mean, stddev_pop(prepared) as std
              from (select q.*, case when v < low then low when v > high then high else coalesce(v, fill) end as prepared
                    from {_LONG.replace("from training", "from wide")} u join quantiles q on u.feature = q.feature) group by all)),
    scaled as materialized (select Customer_ID, label_obs_date, label, 1.0::double as x0, {", ".join(xs)},
            label_obs_date <= date '{TRAIN_END}' as known,
            count(*) over (partition by known) / (2 * count(*) over (partition by known, label)) as weight from wide, stats),
    steps as (select 0 as step, list_transform(range(0, {size}), lambda i: 0.0::double) as beta
        union all
        select step + 1, list_transform(beta, lambda b, i: b - m[i][{size + 1}] / m[i][i])
        from (select step, beta, {swept} as m
              from (select step, any_value(beta) as beta, {system} as m
                    from (select *, weight * (p - label) as g, weight * p * (1 - p) as h
                          from (select *, 1 / (1 + exp(-({z}))) as p from scaled, steps where known and step < {steps})) group by step))),
    fitted as materialized (select beta from steps where step = {steps})
    {wanted.replace("<z>", z)}""").replace("with ", "with recursive ", 1).replace("\n\n    , wide", ",\n    wide")


@query(_newton_sql("""
    select Customer_ID, label_obs_date, label, cast(p > 0.5 as integer) as prediction, round(p, 6) as probability
    from (select *, 1 / (1 + exp(-(<z>))) as p from scaled, fitted where not known)"""))
def lr_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and probability of every test row by the model fitted on the train rows."""
    train, test = training.chronological_split(merged(spark, sf_dir), TRAIN_END)
    fitted = model.fit_newton(train, training.feature_columns(train))
    return fitted.score(test).select("Customer_ID", "label_obs_date", "label", "prediction", F.round("probability", 6).alias("probability"))


@query(_newton_sql(f"""
    select unnest({sorted(_MODEL_FEATURES)}) as feature, round(abs(unnest(beta[2:])), 6) as abs_coef, round(unnest(beta[2:]), 6) as coef
    from fitted order by abs_coef desc, feature limit 20"""))
def coef_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest coefficients, by way of the stored result table."""
    result = evaluated(spark, sf_dir, "newton")
    path = Staging(spark).path("coefficients")
    write_result(result.coefficients, path)
    stored = spark.read.schema(result.coefficients.schema).option("header", True).csv(path)
    return model.top_coefficients(stored, 20).withColumns({c: F.round(c, 6) for c in ("abs_coef", "coef")})


@query()
def train_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluated(spark, sf_dir).metrics.drop("run_ts")


@query()
def train_evaluate_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of a model fitted on the full store as it is written, clickstream gaps included."""
    views = raws(spark, sf_dir, ["raw_financials", "raw_attributes", "raw_clickstream", "raw_loans"])
    staging = Staging(spark)
    store = staging.table(features.feature_table(staging.table(full_base(spark, sf_dir, views), "base", "snapshot_date"), exact=True), "full")
    labels = staging.table(label_store(silver_loans(views["raw_loans"])), "labels")
    result = run_train_evaluate(store, labels, "full", VALID_SNAPSHOTS[-3])
    return result.metrics.select("label", "feature_set", "accuracy", "roc_auc")


@query()
def train_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class quality of the fitted model on the train and test rows."""
    return evaluated(spark, sf_dir).report
