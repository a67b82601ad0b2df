"""Classification scores from one confusion matrix."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkprep.functions import column


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, prediction, n)``."""
    return df.groupBy(
        column(label).cast("double").alias("label"),
        column(prediction).cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("n"))


def _share(part: str, whole: Column) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), whole.cast("double")), F.lit(0.0))


def scores_by_label(matrix: DataFrame, beta: float = 1.0) -> DataFrame:
    """Per class: counts, true and false positive rate, precision, recall and F-measure."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    zero = F.lit(0).cast("long")
    as_label = F.struct(
        F.col("label").alias("class"), F.col("n").alias("actual"), zero.alias("predicted"), hit.alias("tp")
    )
    as_prediction = F.struct(
        F.col("prediction").alias("class"), zero.alias("actual"), F.col("n").alias("predicted"), zero.alias("tp")
    )
    counts = (
        matrix.select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("class")
        .agg(*(F.sum(c).alias(c) for c in ("actual", "predicted", "tp")))
    )
    # Over all the classes: one row each.
    total = F.sum("actual").over(Window.partitionBy())
    rated = counts.select(
        "class",
        "actual",
        "predicted",
        "tp",
        _share("tp", F.col("predicted")).alias("precision"),
        _share("tp", F.col("actual")).alias("recall"),
        F.coalesce(
            F.try_divide(
                (F.col("predicted") - F.col("tp")).cast("double"),
                (total - F.col("actual")).cast("double"),
            ),
            F.lit(0.0),
        ).alias("false_positive_rate"),
    )
    squared = beta * beta
    f_measure = F.try_divide(
        F.lit(1.0 + squared) * F.col("precision") * F.col("recall"),
        F.lit(squared) * F.col("precision") + F.col("recall"),
    )
    return rated.withColumn("f_measure", F.coalesce(f_measure, F.lit(0.0)))


def scores(matrix: DataFrame) -> DataFrame:
    """``(metric, score)`` with the evaluator's metric names, all from the same matrix."""
    by_label = scores_by_label(matrix)
    weight = F.sum("actual").cast("double")

    def weighted(name: str) -> Column:
        return F.try_divide(F.sum(F.col("actual") * F.col(name)), weight)

    row = by_label.agg(
        F.try_divide(F.sum("tp").cast("double"), weight).alias("accuracy"),
        weighted("precision").alias("weightedPrecision"),
        weighted("recall").alias("weightedRecall"),
        weighted("recall").alias("weightedTruePositiveRate"),
        weighted("false_positive_rate").alias("weightedFalsePositiveRate"),
        weighted("f_measure").alias("f1"),
        (F.lit(1.0) - F.try_divide(F.sum("tp").cast("double"), weight)).alias("hammingLoss"),
    )
    return row.unpivot([], row.columns, "metric", "score")


def get_score(df: DataFrame, metric_name: str, label_col: str, prediction_col: str) -> float:
    """One metric by Spark's evaluator, which also knows the per-label ones."""
    return MulticlassClassificationEvaluator(
        labelCol=label_col, predictionCol=prediction_col, metricName=metric_name
    ).evaluate(df)
