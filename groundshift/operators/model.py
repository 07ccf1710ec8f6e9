"""Random forests on Spark ML."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from groundshift import config as c
from groundshift.functions.naming import era_of

ERAS = ["legacy", "2020"]


def assembler(features: list[str] = c.FEATURES, invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid=invalid)


def train_rf(train: DataFrame, features: list[str] = c.FEATURES, **params) -> PipelineModel:
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", **{**c.FOREST, **params})
    return Pipeline(stages=[assembler(features), forest]).fit(train)


def in_era(df: DataFrame, era: str) -> DataFrame:
    return df.where(era_of(F.col("yr")) == era)


def score(px: DataFrame, model: PipelineModel, features: list[str] = c.FEATURES) -> DataFrame:
    """Add ``urban_prob`` to every row; NULL where a feature is missing."""
    complete = reduce(lambda a, b: a & b, [F.col(f).isNotNull() for f in features])
    filled = px.withColumns({f"_{f}": F.coalesce(f, F.lit(0.0)) for f in features}).withColumn("_ok", complete)
    stages = [assembler([f"_{f}" for f in features]), model.stages[-1]]
    out = PipelineModel(stages).transform(filled)
    prob = F.when(F.col("_ok"), vector_to_array("probability")[1])
    return out.select(*px.columns, prob.alias("urban_prob"))


def score_by_era(px: DataFrame, models: dict[str, PipelineModel], features: list[str] = c.FEATURES) -> DataFrame:
    """Each raster by the model of its era."""
    parts = [score(in_era(px, era), models[era], features) for era in ERAS]
    return parts[0].unionByName(parts[1])


def feature_importance(model: PipelineModel, features: list[str] = c.FEATURES) -> DataFrame:
    """Features by falling importance (as many rows as features)."""
    from pyspark.sql import SparkSession

    values = model.stages[-1].featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    rows = spark.createDataFrame([(f, float(v)) for f, v in zip(features, values)], "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
