"""Linear regression of converted sizes, with the scaler fitted on the training rows alone."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, functions as F


@dataclass
class SizeModel:
    model: PipelineModel
    report: DataFrame

    def total(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df).agg(F.sum("prediction").alias("predicted_total"))


def size_model(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], training: float = 0.8) -> SizeModel:
    """Split by a hash of the keys (the same rows each run), fit, and report r2, mae and row counts of the test rows."""
    share = F.pmod(F.xxhash64(*keys), F.lit(1000)) < int(training * 1000)
    rows = df.dropna(subset=[*features, target]).withColumn("_train", share)
    stages = [VectorAssembler(inputCols=list(features), outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True), LinearRegression(featuresCol="_x", labelCol=target)]
    model = Pipeline(stages=stages).fit(rows.where("_train"))
    tested = model.transform(rows.where("not _train"))
    score = {m: RegressionEvaluator(labelCol=target, metricName=m).evaluate(tested) for m in ("r2", "mae")}
    report = tested.agg(F.count("*").alias("test_rows")).select("test_rows", F.lit(score["r2"]).alias("r2"), F.lit(score["mae"]).alias("mae"))
    return SizeModel(model, report)
