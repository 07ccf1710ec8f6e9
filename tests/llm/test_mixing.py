import math
import re
from collections import defaultdict

from pyspark.sql import functions as F

from groundshift.llm import mixing


def slow_targets(sizes, total, weights=(1, 2, 3), epochs=3):
    """Share, cut what is above the limit, share the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = {}, set()
    while True:
        left = total - sum(epochs * sizes[s] for s in full)
        pull = sum(weight[s] for s in names if s not in full)
        target = {s: epochs * sizes[s] if s in full else left * weight[s] / pull for s in names}
        over = {s for s in names if s not in full and target[s] > epochs * sizes[s]}
        if not over:
            return target
        full |= over


def rows():
    out = [(i, "w " * (i % 17), f"s{i % 9}") for i in range(400)]
    out += [(1000 + i, "w " * 5, "hot") for i in range(600)]
    out += [(3000, "one", "tiny"), (3001, "", "void"), (3002, None, "void"), (None, "a b c", None), (3003, "a b c", None), (3003, "a b c", None)]
    return [*out, (3004, "w\t" * 3000, "s1")]


def test_targets_and_what_is_taken(docs):
    given = rows()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in given:
        sizes[s] += size(t)
    want = slow_targets(dict(sizes), sum(sizes.values()))
    got = mixing.mix_sizes(docs(given)).collect()
    assert len(got) == len(given)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12) and r.source_size == sizes[r.source]
        assert 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
        largest[r.source] = max(largest[r.source], r.size)
    assert sum(taken.values()) <= sum(want.values()) + 1e-6
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_rows_of_the_mix(docs):
    given = docs(rows())
    plan = mixing.mix_sizes(given).groupBy("doc_id").agg(F.sum("copies").alias("n")).where("n > 0")
    out = mixing.mixed(given)
    assert out.schema == given.schema
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == {r.doc_id: r.n for r in plan.collect()}


def test_reruns_agree_whatever_the_partitions(docs, same_rows):
    given = docs(rows())
    a = mixing.mix_sizes(given.repartition(7)).select("doc_id", "source", "copies").collect()
    same_rows(a, [tuple(r) for r in mixing.mix_sizes(given.coalesce(1)).select("doc_id", "source", "copies").collect()])


def test_empty_tables(docs):
    assert mixing.mix_sizes(docs([(1, "a")]).limit(0)).count() == 0
    assert mixing.mixed(docs([(1, "a")]).limit(0)).count() == 0
    assert [r.copies for r in mixing.mix_sizes(docs([(1, ""), (2, None)])).collect()] == [0, 0]
