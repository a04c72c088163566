"""Classifier fit and scoring (M01, M03) with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch_path


def fit_classifier(df: DataFrame, features: Sequence[str], label: str, max_iter: int = 20) -> PipelineModel:
    """Logistic regression on numeric columns.

    The model is saved to the shared folder and loaded back: the loaded one carries no training
    summary, which would tie it to this session when it is shipped to the executors.
    """
    stages = [VectorAssembler(inputCols=list(features), outputCol="_features"),
              LogisticRegression(featuresCol="_features", labelCol="_label", maxIter=max_iter)]
    path = scratch_path(df.sparkSession, "model")
    Pipeline(stages=stages).fit(df.withColumn("_label", F.col(label).cast("double"))).write().save(path)
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predictions for a batch or a stream."""
    return model.transform(df).withColumn("prediction", F.col("prediction").cast("int")).drop("_features", "rawPrediction", "probability")
