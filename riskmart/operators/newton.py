"""Weighted logistic regression with an L2 penalty by Newton steps, each one aggregate of the rows.

A task adds up the loss, the gradient and the Hessian of its rows as one array; the arrays are summed place by place, so what meets is
as small as the square of the number of features, whatever the rows. The driver solves the small system. Steps that do not lower the loss are halved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.sources.scratch import Staging

MOST_STEPS, MOST_HALVINGS = 50, 30


def sums(rows: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of ``rows`` (x, label, weight) at ``beta``, whose first entry is the intercept."""
    width, size = len(beta), 1 + len(beta) + len(beta) ** 2

    def add_up(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                values = batch.column("x").flatten().to_numpy().reshape(-1, width - 1)
                x = np.hstack([np.ones((len(values), 1)), values])
                y, w = batch.column("label").to_numpy(), batch.column("weight").to_numpy()
                z = x @ beta
                p = np.exp(-np.logaddexp(0, -z))
                loss = (w * (np.logaddexp(0, z) - y * z)).sum()
                hessian = (x * (w * p * (1 - p))[:, None]).T @ x
                total += np.concatenate([[loss], x.T @ (w * (p - y)), hessian.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["total"])

    parts = rows.select("x", "label", "weight").mapInArrow(add_up, "total array<double>")
    added = parts.select(F.posexplode("total").alias("place", "v")).groupBy("place").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(size)
    total[[r.place for r in added]] = [r.v for r in added]
    return total[0], total[1 : width + 1], total[width + 1 :].reshape(width, width)


def fit(rows: DataFrame, width: int, penalty: float, tolerance: float = 1e-9, most_steps: int = MOST_STEPS) -> np.ndarray:
    """Intercept and coefficients with the least ``weight``-ed loss plus half of ``penalty`` times the squared coefficients.

    ``rows`` hold ``x`` (``width`` doubles without gaps), ``label`` (0.0 or 1.0) and ``weight``; they are written once. Ends when no
    entry moves by more than ``tolerance``; an error tells that it did not.
    """
    pull = np.array([0.0] + [penalty] * width)
    beta, step, least, halvings = np.zeros(width + 1), np.zeros(width + 1), np.inf, 0
    with Staging(rows.sparkSession) as staging:
        kept = staging.table(rows.select("x", F.col("label").cast("double"), F.col("weight").cast("double")), "rows")
        for _ in range(most_steps):
            loss, gradient, hessian = sums(kept, beta + step)
            loss += (pull * (beta + step) ** 2).sum() / 2
            if loss > least + 1e-12 * abs(least) and halvings < MOST_HALVINGS:
                step, halvings = step / 2, halvings + 1
                continue
            beta, least, halvings = beta + step, loss, 0
            step = -np.linalg.lstsq(hessian + np.diag(pull), gradient + pull * beta, rcond=None)[0]
            if np.abs(step).max() <= tolerance:
                return beta + step
    raise RuntimeError(f"the regression did not settle in {most_steps} passes")


def probability(scaled: list[Column], beta: list[float]) -> Column:
    """Chance of label 1 of rows with the scaled features."""
    z = F.lit(float(beta[0]))
    for column, c in zip(scaled, beta[1:]):
        z = z + column * F.lit(float(c))
    return 1 / (1 + F.exp(-z))
