"""Score calibration: min-max per query, or isotonic / Platt fitted to labels."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinseek.operators.ranking import min_max_in_group

METHODS = ("minmax", "isotonic", "platt")


def _weighted(labels: DataFrame) -> DataFrame:
    """Equal (score, label) rows as one weighted row: what the fits work on."""
    return (
        labels.select(F.col("score").cast("double"), F.col("label").cast("double"))
        .groupBy("score", "label")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def fit_isotonic(labels: DataFrame):
    """Monotone fit of label on score, from (score, label) rows.

    Rows with one score are pooled into their mean before fitting.
    """
    pooled = (
        _weighted(labels)
        .groupBy("score")
        .agg(
            (F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("label"),
            F.sum("weight").alias("weight"),
        )
    )
    return IsotonicRegression(
        featuresCol="score", labelCol="label", weightCol="weight", predictionCol="_fitted"
    ).fit(pooled)


def fit_platt(labels: DataFrame, max_iter: int = 200, tol: float = 1e-12):
    """Logistic fit of label on score, from (score, label) rows."""
    vector = VectorAssembler(inputCols=["score"], outputCol="_score_vector")
    return LogisticRegression(
        featuresCol="_score_vector",
        labelCol="label",
        weightCol="weight",
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        predictionCol="_class",
        maxIter=max_iter,
        tol=tol,
    ).fit(vector.transform(_weighted(labels)))


def calibrate(
    df: DataFrame,
    method: str = "minmax",
    labels: DataFrame | None = None,
    score: str = "raw_xenc_score",
    out: str = "calibrated_score",
) -> DataFrame:
    """Add the calibrated score.

    Without labels every method is min-max over the query's rows, which a top-K has
    already bounded. With labels (score, label) isotonic and Platt are fitted to them.
    """
    if method not in METHODS:
        raise ValueError(f"unknown calibration method: {method}")
    if method == "minmax" or labels is None:
        return df.withColumn(out, min_max_in_group(score, ["query_id"]))
    plain = df.withColumn("score", F.col(score).cast("double"))
    if method == "isotonic":
        fitted = fit_isotonic(labels).transform(plain)
        return fitted.withColumnRenamed("_fitted", out).drop("score")
    vector = VectorAssembler(inputCols=["score"], outputCol="_score_vector")
    fitted = fit_platt(labels).transform(vector.transform(plain))
    return fitted.withColumn(out, vector_to_array("_probability")[1]).drop(
        "score", "_score_vector", "_probability", "_raw", "_class"
    )
