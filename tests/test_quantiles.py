import random

import numpy as np
import pytest

from groundshift.operators import quantiles
from groundshift.operators.quantiles import exact_percentiles

INF = float("inf")
PROBS = [0.0, 0.02, 0.5, 0.98, 1.0]


@pytest.mark.parametrize("accuracy", [20, 400, 50_000])
def test_against_numpy(spark, accuracy):
    rng = random.Random(11)
    groups = {
        "hot": [rng.gauss(0, 1) for _ in range(4000)],
        "copies": [1.0] * 900 + [2.0] * 100 + [rng.random() for _ in range(50)],
        "two": [1.0, 5.0],
        "edge": [0.0] * 500 + [1.0] * 500,
        "one": [3.5],
        "far": [1e-12 * i for i in range(200)] + [1e9],
        "same": [2.0] * 700,
        "spread": [10.0 ** rng.uniform(-300, 300) for _ in range(1500)],
        "tiny": [5e-324 * i for i in range(300)],
        "huge": [-1.7e308, 1.7e308, 0.0] * 50,
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    rows += [("hot", None), ("hot", float("nan")), ("none", None)]
    rng.shuffle(rows)
    out = exact_percentiles(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", PROBS, accuracy)
    got = {(r.g, r.prob): r.value for r in out.collect()}
    assert len(got) == len(groups) * len(PROBS)
    for g, vs in groups.items():
        for p in PROBS:
            assert got[g, p] == pytest.approx(float(np.percentile(vs, p * 100)), rel=1e-9, abs=1e-320)


@pytest.mark.parametrize("accuracy", [10, 50_000])
def test_infinite_values_are_the_ends(spark, accuracy):
    ends = [-INF] * 10 + [float(i) for i in range(181)] + [INF] * 10
    rows = [("a", v) for v in ends] + [("b", INF)] * 300 + [("c", -INF), ("c", INF)] + [("d", 1.0), ("d", INF)]
    out = exact_percentiles(spark.createDataFrame(rows, "g string, x double"), ["g"], "x", [0.0, 0.02, 0.5, 1.0], accuracy)
    got = {(r.g, r.prob): r.value for r in out.collect()}
    assert [got["a", p] for p in (0.0, 0.02, 0.5, 1.0)] == [-INF, -INF, 90.0, INF]
    assert {got["b", p] for p in (0.0, 0.02, 0.5, 1.0)} == {INF}
    assert got["c", 0.5] is None and got["d", 0.5] == INF and got["d", 0.0] == 1.0


def test_passes_are_few(spark, monkeypatch):
    passes = []
    monkeypatch.setattr(quantiles, "_ranked", lambda *a, f=quantiles._ranked: passes.append(1) or f(*a))
    df = spark.range(200_000).selectExpr("id % 2 as g", "if(id % 1000 = 0, double('infinity'), exp(id % 700)) as x")
    assert exact_percentiles(df, ["g"], "x", [0.02, 0.98]).count() == 4
    assert len(passes) == 1
