import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from groundshift.operators import stats


def test_correlation_against_pandas(spark):
    rng = random.Random(2)
    rows = []
    for s in ("x", "y"):
        for _ in range(60):
            a = rng.random()
            rows.append((s, a, None if rng.random() < 0.2 else a * 2 + rng.random(), 5.0 if s == "x" else rng.random()))
    rows.append((None, 1.0, 1.0, 1.0))
    cols = ["a", "b", "k"]
    out = stats.correlation_matrix(spark.createDataFrame(rows, "subclass string, a double, b double, k double"), cols)
    got = {(r.subclass, r.feature_a, r.feature_b): r["corr"] for r in out.collect()}
    assert len(got) == 18
    pdf = pd.DataFrame(rows, columns=["subclass", *cols])
    for s in ("x", "y"):
        want = pdf[pdf.subclass == s][cols].corr()
        for a in cols:
            for b in cols:
                if math.isnan(want.loc[a, b]):
                    assert got[s, a, b] is None
                else:
                    assert got[s, a, b] == pytest.approx(want.loc[a, b])


def test_density_against_the_formula(spark):
    rng = random.Random(5)
    groups = {"wide": [rng.gauss(0, 1) for _ in range(300)], "few": [0.1, 0.4, 0.9], "flat": [0.3] * 4, "single": [0.7]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("wide", None), ("wide", float("nan")), (None, 0.5)]
    out = stats.grouped_kde(spark.createDataFrame(rows, "g string, v double"), "g", "v", points=20).collect()
    for g, vs in groups.items():
        mine = sorted((r for r in out if r.g == g), key=lambda r: r.point)
        assert len(mine) == 20 and mine[0].n == len(vs) and mine[0].mean == pytest.approx(np.mean(vs))
        xs = np.linspace(min(vs), max(vs), 20)
        assert [r.x for r in mine] == pytest.approx(list(xs))
        if min(vs) == max(vs):
            assert [r.density for r in mine] == [1.0] * 20
            continue
        h = np.std(vs, ddof=1) * len(vs) ** -0.2
        want = [np.exp(-0.5 * ((x - np.array(vs)) / h) ** 2).sum() / (len(vs) * h * np.sqrt(2 * np.pi)) for x in xs]
        assert [r.density for r in mine] == pytest.approx(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_metrics_equal_the_evaluator(spark, seed):
    rng = random.Random(seed)
    rows = [(float(rng.randrange(3)), float(rng.choice([0, 0, 1]))) for _ in range(300)]
    preds = spark.createDataFrame(rows, "label double, prediction double")
    got = stats.classification_metrics(preds).first()
    for mine, theirs in [("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall")]:
        assert got[mine] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(preds))


def test_histograms(spark):
    df = spark.createDataFrame([("u", 1), ("u", 0), ("w", 1), (None, 1)], "s string, l int")
    assert stats.histogram_map(df, "s").first().histogram == {"u": 2, "w": 1}
    got = {(r.property, r.value): r.n for r in stats.histogram(df, ["s", "l"]).collect()}
    assert got == {("s", "u"): 2, ("s", "w"): 1, ("s", None): 1, ("l", "1"): 3, ("l", "0"): 1}


def test_subclasses(spark):
    df = spark.createDataFrame([("water", 1990, 0.1), ("urban", 1990, None), ("alga", 2000, 0.3), (None, 2000, 0.2)], "subclass string, yr int, red double")
    assert [r.subclass for r in stats.ordered_subclasses(df).orderBy("position").collect()] == ["urban", "water", "alga"]
    assert sorted((r.subclass, r.yr) for r in stats.subclass_year_means(df, ["red"]).collect()) == [("alga", 2000), ("water", 1990)]
    prints = stats.spectral_fingerprint(df, ["red"]).where("subclass = 'water'").orderBy("yr").collect()
    assert [(r.yr, r.red) for r in prints] == [(1990, 0.1), (2000, None), (2010, None), (2020, None)]
    assert [r.red for r in stats.preview(df, 2, ["red"]).collect()] == [None, 0.1]


def test_density_counts_equal_values_and_stays_in_generated_code(spark):
    vs = [round(random.Random(3).gauss(0, 1), 1) for _ in range(500)] + [0.25] * 300
    df = spark.createDataFrame([("g", v) for v in vs], "g string, v double")
    out = stats.grouped_kde(df, "g", "v")
    assert stats.SLICE <= 50
    rows = sorted(out.collect(), key=lambda r: r.point)
    assert len(rows) == 100
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert all(re.search(r"\*\(\d+\) HashAggregate", x) for x in final.splitlines() if "HashAggregate" in x)
    h = np.std(vs, ddof=1) * len(vs) ** -0.2
    for r in rows[::9]:
        want = sum(math.exp(-((r.x - v) ** 2) / (2 * h * h)) for v in vs) / (len(vs) * h * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(want)


def test_histogram_maps_hold_every_value_once(spark):
    df = spark.createDataFrame([(i % 700 if i % 9 else None,) for i in range(5000)], "a int")
    (whole,) = stats.histogram_map(df, "a").collect()
    parts = [r.histogram for r in stats.histogram_map(df, "a", most=100).collect()]
    assert 5 <= len(parts) <= 7 and max(map(len, parts)) < 150
    assert sum(map(len, parts)) == len(whole.histogram) and {k: v for p in parts for k, v in p.items()} == whole.histogram
