"""Quality of scored rows, which carry ``label``, ``prediction`` and ``probability``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskmart.sources.scratch import Staging, settled


def accuracy(scored: DataFrame) -> DataFrame:
    hit = (F.col("label") == F.col("prediction")).cast("int")
    return scored.agg(F.avg(hit).alias("accuracy"))


def area_under_roc(scored: DataFrame) -> DataFrame:
    """One row ``roc_auc``: the chance that a positive row scores above a negative one, ties counting half.

    Rows without a label or a score are left out, NaN ranks above every number, and without both classes the area is null.
    Counts of the distinct scores are dealt over ranges of the score. A score has below it the negatives of the ranges before
    its own, one small running sum, and those of its own range that are lower, one running sum for each range; so no task
    orders all scores.
    """
    with Staging(scored.sparkSession) as staging:
        positive = F.col("label") > 0.5
        known = scored.filter(F.col("label").isNotNull() & F.col("probability").isNotNull())
        counts = known.groupBy("probability").agg(
            F.count_if(positive).cast("double").alias("positives"), F.count_if(~positive).cast("double").alias("negatives")
        )
        parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # Written with the range, as a second look at it must find the same ranges.
        ranged = staging.table(
            counts.repartitionByRange(parts, "probability").withColumn("range", F.spark_partition_id()), "scores"
        )
        lower = F.sum("negatives").over(Window.partitionBy("range").orderBy("probability")) - F.col("negatives")
        inside = ranged.withColumn("area", F.col("positives") * (lower + F.col("negatives") / 2))
        ranges = inside.groupBy("range").agg(*[F.sum(c).alias(c) for c in ("area", "positives", "negatives")])
        # One row for each range from here on.
        before = F.sum("negatives").over(Window.orderBy("range")) - F.col("negatives")
        area = F.sum(F.col("area") + F.col("positives") * F.col("before"))
        pairs = F.sum("positives") * F.sum("negatives")
        result = ranges.withColumn("before", before).agg(F.try_divide(area, pairs).alias("roc_auc"))
        return scored.sparkSession.createDataFrame(result.collect(), "roc_auc double")


def roc_auc(scored: DataFrame) -> float:
    """Area under the ROC curve through every distinct score; NaN without rows of both classes."""
    area = area_under_roc(scored).first()[0]
    return float("nan") if area is None else area


def confusion(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label", "prediction").agg(F.count("*").alias("row_count"))


def class_report(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, and their plain and weighted averages.

    A ratio without any row to count is 0.
    """
    return report_of(settled(confusion(scored)))


def report_of(cells: DataFrame) -> DataFrame:
    """The report from the counts of each label and prediction."""
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("row_count")).otherwise(0))
    actual = cells.groupBy(F.col("label").alias("class")).agg(hits.alias("hits"), F.sum("row_count").alias("support"))
    predicted = cells.groupBy(F.col("prediction").alias("class")).agg(F.sum("row_count").alias("predicted"))

    # One row per class from here on.
    counts = actual.join(predicted, "class", "full").fillna(0)

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    classes = counts.select(
        F.col("class").cast("string").alias("class"),
        share(F.col("hits"), F.col("predicted")).alias("precision"),
        share(F.col("hits"), F.col("support")).alias("recall"),
        share(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )
    names = ["precision", "recall", "f1"]
    weighted = [F.try_divide(F.sum(F.col(n) * F.col("support")), F.sum("support")).alias(n) for n in names]
    macro = classes.agg(F.lit("macro avg").alias("class"), *[F.avg(n).alias(n) for n in names],
                        F.sum("support").alias("support"))
    overall = classes.agg(F.lit("weighted avg").alias("class"), *weighted, F.sum("support").alias("support"))
    return classes.unionByName(macro).unionByName(overall)


def metrics_row(scored: DataFrame, name: str) -> tuple[str, float, float]:
    """(name, accuracy, AUC) with four decimals."""
    return name, round(accuracy(scored).first()[0], 4), round(roc_auc(scored), 4)


def metrics_table(
    spark: SparkSession, rows: list[tuple[str, float, float]], feature_set: str, train_end: str
) -> DataFrame:
    table = spark.createDataFrame(rows, "label string, accuracy double, roc_auc double")
    # Fixed here, so that every use of the table shows the same time.
    now = spark.sql("select date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss')").first()[0]
    return table.withColumns({"feature_set": F.lit(feature_set), "train_end": F.lit(train_end), "run_ts": F.lit(now)})
