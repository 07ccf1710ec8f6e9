import pytest
from pyspark.sql import functions as F

from groundshift.operators import model as m
from groundshift.plans.training import balanced_split, fit_stable, train_models
from groundshift.session import scratch_path

FEATURES = ["red", "nir"]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.range(1200).selectExpr(
        "id as sample_id",
        "cast(id % 3 = 0 as double) as label",
        "cast(1990 + 10 * (id % 4) as int) as yr",
        "if(id % 3 = 0, 0.6, 0.2) + (id * 7919 % 100) / 400 as red",
        "if(id % 3 = 0, 0.3, 0.5) + (id * 6101 % 100) / 400 as nir",
    )


def probs(df):
    return [r.urban_prob for r in df.orderBy("sample_id").collect()]


def test_same_rows_give_the_same_forest(samples):
    a = fit_stable(samples.repartition(5), "sample_id", FEATURES, 1200)
    b = fit_stable(samples.repartition(3, "yr"), "sample_id", FEATURES, 1200)
    assert probs(m.score(samples, a, FEATURES)) == probs(m.score(samples, b, FEATURES))


def test_saved_model_scores_alike(spark, samples):
    model, path = m.train_rf(samples, FEATURES, numTrees=5), scratch_path(spark, "m")
    m.save_model(model, path)
    assert probs(m.score(samples, model, FEATURES)) == probs(m.score(samples, m.load_model(path), FEATURES))


def test_both_classes_are_validated(samples):
    counts = {(r.part, r.label): r["count"] for r in balanced_split(samples, "legacy", features=FEATURES).groupBy("part", "label").count().collect()}
    for label in (0.0, 1.0):
        share = counts["validation", label] / (counts["validation", label] + counts["train", label])
        assert 0.12 < share < 0.28


def test_training_report_and_routing(samples):
    done = train_models(samples, features=FEATURES)
    got = {r.era: r for r in done.metrics.collect()}
    assert set(got) == {"legacy", "2020"} and all(r.accuracy > 0.9 for r in got.values())
    scored = m.score_by_era(samples, done.models, FEATURES)
    assert scored.count() == samples.count()
    late = m.score(samples.where("yr = 2020"), done.models["2020"], FEATURES)
    assert probs(scored.where("yr = 2020")) == probs(late)


def test_missing_features_are_not_scored(samples):
    model = m.train_rf(samples, FEATURES, numTrees=3)
    gaps = samples.withColumn("red", F.when(F.col("sample_id") > 5, F.col("red")))
    assert m.score(gaps, model, FEATURES).where("urban_prob is null").count() == 6


def test_importance_is_ranked(samples):
    rows = m.feature_importance(m.train_rf(samples, FEATURES, numTrees=5), FEATURES).collect()
    assert {r.feature for r in rows} == set(FEATURES)
    assert rows[0].importance >= rows[1].importance and sum(r.importance for r in rows) == pytest.approx(1.0)
