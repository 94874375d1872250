"""The default model: clip, impute, scale and a class-balanced logistic regression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.operators import newton
from riskmart.operators.quantiles import approx_quantiles, exact_quantiles

CLIP_SHARES = (0.01, 0.99)


@dataclass(frozen=True)
class FeatureStats:
    """What one feature's training values fix: clip bounds, fill value, centre and spread."""

    feature: str
    low: float
    high: float
    median: float
    mean: float
    std: float

    def prepared(self) -> Column:
        """Clipped and filled value."""
        value = F.col(self.feature).cast("double")
        value = F.when(value < self.low, self.low).when(value > self.high, self.high).otherwise(value)
        return F.coalesce(F.when(~F.isnan(value), value), F.lit(self.median))

    def scaled(self) -> Column:
        # A constant column has no spread to scale by.
        return (self.prepared() - F.lit(self.mean)) / F.lit(self.std if self.std > 0 else 1.0)


def fit_stats(train: DataFrame, features: list[str], exact: bool = True) -> list[FeatureStats]:
    """Statistics of the training rows, one entry per feature.

    The fill value is the median of the clipped values. Clipping keeps the order of values
    and never reaches the middle, so that is the median of the raw ones and comes from the
    same passes as the bounds. ``exact=False`` estimates all three in one aggregate.
    """
    shares = [CLIP_SHARES[0], 0.5, CLIP_SHARES[1]]
    quantiles = (exact_quantiles if exact else approx_quantiles)(train, features, shares).first()
    empty = [c for c in features if quantiles[c] is None or quantiles[c][0] is None]
    if empty:
        raise ValueError(f"no training value in {empty}")
    rough = [FeatureStats(c, quantiles[c][0], quantiles[c][2], quantiles[c][1], 0.0, 1.0) for c in features]
    entries = [F.struct(F.lit(i).alias("i"), s.prepared().alias("x")) for i, s in enumerate(rough)]
    moments = train.select(F.inline(F.array(*entries))).groupBy("i").agg(F.avg("x"), F.stddev_pop("x"))
    found = {i: (mean, std) for i, mean, std in moments.collect()}
    return [FeatureStats(s.feature, s.low, s.high, s.median, *found[i]) for i, s in enumerate(rough)]


def class_counts(train: DataFrame) -> dict[int, int]:
    counts = {row["label"]: row["count"] for row in train.groupBy("label").count().collect()}
    if len(counts) < 2:
        raise ValueError(f"training rows hold only the labels {sorted(counts)}")
    return counts


def class_weights(counts: dict[int, int]) -> dict[int, float]:
    """Weight per label that gives every class the same total, summing to the row count."""
    return {label: sum(counts.values()) / (len(counts) * n) for label, n in sorted(counts.items())}


@dataclass(frozen=True)
class DefaultModel:
    """Fitted statistics and coefficients; ``score`` applies them to any rows with the features."""

    stats: list[FeatureStats]
    regression: LogisticRegressionModel

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with the ``probability`` of label 1 and the ``prediction`` it gives."""
        scored = self.regression.transform(_assembled(df, self.stats))
        return scored.select(
            *[F.col(c) for c in df.columns],
            vector_to_array("class_probability")[1].alias("probability"),
            F.col("predicted").cast("int").alias("prediction"),
        )

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """Features ranked by the size of their coefficient."""
        rows = [(s.feature, abs(c), c) for s, c in zip(self.stats, self.regression.coefficients.toArray().tolist())]
        return ranked(spark.createDataFrame(rows, "feature string, abs_coef double, coef double"))

    def statistics(self, spark: SparkSession) -> DataFrame:
        return stats_table(spark, self.stats)


@dataclass(frozen=True)
class NewtonModel:
    """As ``DefaultModel``, with coefficients found by Newton steps; scores are plain expressions."""

    stats: list[FeatureStats]
    beta: list[float]

    def score(self, df: DataFrame) -> DataFrame:
        chance = newton.probability([s.scaled() for s in self.stats], self.beta)
        return df.withColumn("probability", chance).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))

    def coefficients(self, spark: SparkSession) -> DataFrame:
        rows = [(s.feature, abs(c), c) for s, c in zip(self.stats, self.beta[1:])]
        return ranked(spark.createDataFrame(rows, "feature string, abs_coef double, coef double"))

    def statistics(self, spark: SparkSession) -> DataFrame:
        return stats_table(spark, self.stats)


def fit_newton(train: DataFrame, features: list[str], strength: float = 1.0, tolerance: float = 1e-9, exact: bool = True) -> NewtonModel:
    """The same model as ``fit_model``, to the optimum: a few passes, each one aggregate with a state of the features' number squared.

    For up to some hundred features; ``fit_model`` keeps a state of their number only.
    """
    stats = fit_stats(train, features, exact)
    weight = _balanced(class_counts(train))
    rows = train.select(F.array(*[s.scaled() for s in stats]).alias("x"), F.col("label"), weight.alias("weight"))
    return NewtonModel(stats, newton.fit(rows, len(stats), 1.0 / strength, tolerance).tolist())


def _balanced(counts: dict[int, int]) -> Column:
    return F.coalesce(*[F.when(F.col("label") == label, F.lit(w)) for label, w in class_weights(counts).items()])


def fit_model(
    train: DataFrame,
    features: list[str],
    max_iter: int = 1000,
    strength: float = 1.0,
    tolerance: float = 1e-6,
    exact: bool = True,
) -> DefaultModel:
    """Fit on rows with a 0/1 ``label``. ``strength`` is the inverse of the L2 penalty.

    The penalty is on the weighted sum of losses, whose weights sum to the row count; the
    solver averages the losses, hence the division. ``tolerance`` ends the iterations.
    """
    stats = fit_stats(train, features, exact)
    counts = class_counts(train)
    weight = _balanced(counts)
    rows = _assembled(train, stats).select(
        "scaled_features", F.col("label").cast("double").alias("label"), weight.alias("weight")
    )
    solver = LogisticRegression(
        featuresCol="scaled_features",
        labelCol="label",
        weightCol="weight",
        predictionCol="predicted",
        probabilityCol="class_probability",
        maxIter=max_iter,
        regParam=1.0 / (strength * sum(counts.values())),
        elasticNetParam=0.0,
        standardization=False,
        tol=tolerance,
    )
    return DefaultModel(stats, solver.fit(rows))


def ranked(coefficients: DataFrame) -> DataFrame:
    return coefficients.orderBy(F.desc("abs_coef"), "feature")


def top_coefficients(coefficients: DataFrame, n: int = 20) -> DataFrame:
    return ranked(coefficients).limit(n)


def _assembled(df: DataFrame, stats: list[FeatureStats]) -> DataFrame:
    scaled = df.select("*", *[s.scaled().alias(f"scaled_{i}") for i, s in enumerate(stats)])
    names = [f"scaled_{i}" for i in range(len(stats))]
    return VectorAssembler(inputCols=names, outputCol="scaled_features").transform(scaled).drop(*names)


def stats_table(spark: SparkSession, stats: list[FeatureStats]) -> DataFrame:
    rows = [(s.feature, s.low, s.high, s.median, s.mean, s.std) for s in stats]
    schema = "feature string, low double, high double, median double, mean double, std double"
    return spark.createDataFrame(rows, schema)
