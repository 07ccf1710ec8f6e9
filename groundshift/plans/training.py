"""Clean, balance, split, fit and evaluate."""

from __future__ import annotations

from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from groundshift import config as c
from groundshift.operators.model import ERAS, in_era, train_rf
from groundshift.operators.sampling import balance_downsample, hash_split, union_all
from groundshift.operators.small import settle
from groundshift.operators.stats import classification_metrics

ROWS_PER_TASK = 100_000


@dataclass
class Trained:
    models: dict[str, PipelineModel]
    metrics: DataFrame
    predictions: DataFrame


def fit_stable(train: DataFrame, key: str, features: list[str], rows: int) -> PipelineModel:
    """Fit on rows placed and ordered by key, so that a rerun, or a task redone
    after a lost executor, draws the same bootstrap."""
    parts = 1 + rows // ROWS_PER_TASK
    return train_rf(train.repartition(parts, key).sortWithinPartitions(key), features)


def balanced_split(
    clean: DataFrame, era: str, key: str = "sample_id", features: list[str] = c.FEATURES, seed: int = 42
) -> DataFrame:
    """The balanced samples of one era, marked train or validation in ``part``."""
    balanced = balance_downsample(in_era(clean, era), seed=seed, key=key)
    return hash_split(balanced, key, seed).select(key, *features, "label", "part")


def train_era(
    clean: DataFrame, era: str, key: str = "sample_id", features: list[str] = c.FEATURES, seed: int = 42
) -> Trained:
    """A balanced, validated forest for one era; the balanced samples are computed once."""
    parts = balanced_split(clean, era, key, features, seed).persist()
    try:
        model = fit_stable(parts.where("part = 'train'"), key, features, parts.count())
        preds = model.transform(parts.where("part = 'validation'")).select(F.lit(era).alias("era"), key, "label", "prediction")
        metrics = settle(classification_metrics(preds).select(F.lit(era).alias("era"), "*"))
    finally:
        parts.unpersist()
    return Trained({era: model}, metrics, preds)


def train_models(
    clean: DataFrame, key: str = "sample_id", features: list[str] = c.FEATURES, seed: int = 42
) -> Trained:
    """One forest per era, fitted side by side."""
    task = inheritable_thread_target(clean.sparkSession)(lambda era: train_era(clean, era, key, features, seed))
    with ThreadPool(len(ERAS)) as pool:
        done = pool.map(task, ERAS)
    return Trained(
        {era: d.models[era] for era, d in zip(ERAS, done)},
        union_all(*[d.metrics for d in done]),
        union_all(*[d.predictions for d in done]),
    )
