import math

import numpy as np
from pyspark.sql import functions as F

from groundshift.llm import ann

KIND = "vec_id long, embedding array<float>, score int, node string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], KIND)


def exact(vectors, asked, k):
    out = []
    for q in asked:
        scored = sorted((-float(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return out


def test_recall_on_the_given_vectors(spark):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: np.array(r.embedding, np.float64) for r in given.collect()}
    asked = [i for i in vectors if i % 20 == 0]
    got = ann.nearest(given, F.col("vec_id") % 20 == 0).collect()
    want = exact(vectors, asked, 20)
    assert len(got) == len(want)
    found = {(r.query_id, r.vec_id) for r in got}
    assert sum((q, i) in found for q, _, i, _ in want) >= 0.9 * len(want)
    for r in got:
        assert math.isclose(r.score, float(np.dot(vectors[r.query_id], vectors[r.vec_id])), rel_tol=1e-12)


def test_norms_ties_and_what_takes_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4) * (1 + i % 5)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)]  # copies of one vector
    valid = dict(rows)
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [math.nan, 0.0, 0.0, 0.0]), (204, [math.inf, 0.0, 0.0, 1.0])]
    rows += [(None, [1.0, 0.0, 0.0, 0.0]), (205, [1.0]), (0, rows[0][1])]
    out = ann.nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k=7, width=200, pool=200, degree=120).collect()  # all are neighbours
    want = exact(valid, [i for i in valid if i % 20 == 0], 7)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out)
    assert [g[:3] for g in got] == sorted(w[:3] for w in want)
    assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)], rtol=1e-12)


def test_small_and_empty_tables(spark):
    few = table(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])])
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2), (0, 2, 1)]
    assert ann.nearest(few.limit(0), F.col("vec_id") == 0).count() == 0
    assert ann.nearest(few.where("vec_id = 0"), F.col("vec_id") == 0).count() == 0


def tight(rng, groups, each, spread=0.01):
    """Vectors in tight groups of near but unequal ones; the groups' norms differ."""
    centres = [rng.normal(size=8) for _ in range(groups)]
    centres = [c / np.linalg.norm(c) * (1 + g % 7) for g, c in enumerate(centres)]
    rows = [[float(np.float32(x)) for x in c + spread * rng.normal(size=8)] for c in centres for _ in range(each)]
    return list(enumerate(rows))


def test_two_tight_groups_give_all_that_are_asked_for(spark):
    rows = tight(np.random.default_rng(2), 2, 12)
    got = ann.nearest(table(spark, rows), F.col("vec_id") % 5 == 0).collect()
    want = exact(dict(rows), [i for i, _ in rows if i % 5 == 0], 20)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == sorted(w[:3] for w in want)


def test_recall_over_tight_groups(spark):
    rows = tight(np.random.default_rng(3), 12, 40)
    got = ann.nearest(table(spark, rows), F.col("vec_id") % 10 == 0).collect()
    want = exact(dict(rows), [i for i, _ in rows if i % 10 == 0], 20)
    assert len(got) == len(want)
    found = {(r.query_id, r.vec_id) for r in got}
    assert sum((q, i) in found for q, _, i, _ in want) >= 0.9 * len(want)
