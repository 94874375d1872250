"""Training and evaluation of the default model on a feature store and the label store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.operators.metrics import class_report, confusion, metrics_row, metrics_table
from riskmart.operators.model import DefaultModel, NewtonModel, fit_model, fit_newton
from riskmart.operators.profile import distribution
from riskmart.operators.training import check_split, chronological_split, columns_with_values, feature_columns, training_set
from riskmart.plans.backfill import BASELINE, FULL, LABELS, Datamart
from riskmart.sources.scratch import Staging, settled
from riskmart.sources.snapshots import write_result


@dataclass(frozen=True)
class Evaluation:
    """A fitted model and small result tables; ``split`` is train or test in those that have it."""

    model: DefaultModel | NewtonModel
    metrics: DataFrame
    coefficients: DataFrame
    labels: DataFrame
    confusion: DataFrame
    report: DataFrame


def train_evaluate(
    features: DataFrame,
    labels: DataFrame,
    feature_set: str = "baseline",
    train_end: str = "2024-06-01",
    max_iter: int = 1000,
    exact: bool = True,
    solver: str = "lbfgs",
) -> Evaluation:
    """Fit on labels observed up to ``train_end`` and evaluate before and after it.

    The joined rows are written once, since fitting reads them many times, and so are the
    scores. A column without a value in any training row, such as a clickstream feature that began
    later, cannot be fitted and is left out of the model. ``exact=False`` estimates the clip bounds and medians in one aggregate.
    ``solver`` is lbfgs, or newton for the optimum itself in a few passes.
    """
    if solver not in ("lbfgs", "newton"):
        raise ValueError(f"no solver {solver}")
    spark = features.sparkSession
    with Staging(spark) as staging:
        merged = staging.table(training_set(features, labels), "training")
        check_split(merged, train_end)
        train, _ = chronological_split(merged, train_end)
        names = columns_with_values(train, feature_columns(merged))
        model = fit_newton(train, names, exact=exact) if solver == "newton" else fit_model(train, names, max_iter, exact=exact)

        is_train = F.col("label_obs_date") <= F.lit(train_end).cast("date")
        split = F.when(is_train, "train").otherwise("test")
        scores = model.score(merged).select(split.alias("split"), "label", "prediction", "probability")
        scores = staging.table(scores, "scores")
        parts = {name: scores.filter(F.col("split") == name) for name in ("train", "test")}
        rows = [metrics_row(part, f"LR_{feature_set}_{name}") for name, part in parts.items()]
        tables = {
            kind: [table(part).withColumn("split", F.lit(name)) for name, part in parts.items()]
            for kind, table in (("confusion", confusion), ("report", class_report))
        }
        return Evaluation(
            model,
            metrics_table(spark, rows, feature_set, train_end),
            model.coefficients(spark),
            settled(distribution(merged)),
            settled(tables["confusion"][0].unionByName(tables["confusion"][1])),
            settled(tables["report"][0].unionByName(tables["report"][1])),
        )


def run_training(
    mart: Datamart,
    output: str,
    feature_set: str = "baseline",
    train_end: str = "2024-06-01",
    max_iter: int = 1000,
    exact: bool = True,
) -> Evaluation:
    """Train on the stores of a datamart and write coefficients and metrics under ``output``."""
    if feature_set not in ("baseline", "full"):
        raise ValueError(f"feature_set must be baseline or full, not {feature_set}")
    store = mart.gold(BASELINE if feature_set == "baseline" else FULL)
    result = train_evaluate(store, mart.gold(LABELS), feature_set, train_end, max_iter, exact)
    write_result(result.coefficients, f"{output}/coefficients_LR_{feature_set}")
    write_result(result.metrics, f"{output}/metrics_LR_{feature_set}")
    return result
