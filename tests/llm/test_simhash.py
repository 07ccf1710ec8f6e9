import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from groundshift.llm import graph, simhash


def slow_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_classes(nodes, linked):
    parent = list(range(len(nodes)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(nodes)):
        for j in range(i + 1, len(nodes)):
            if linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(nodes))]


def family(rng, bases, each, flips):
    out = set()
    for base in (rng.getrandbits(64) for _ in range(bases)):
        for _ in range(each):
            x = base
            for _ in range(rng.randint(0, flips)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


def test_fingerprint():
    words = " ".join(f"w{i * i % 97}" for i in range(300))
    for text in ["a", "a b", "A b C d e f É ü\n\t x", words, None, " \t\n", "x y z", "A" * 100_000]:
        for k in (1, 3, 5):
            assert simhash.fingerprint(text, k) == slow_fingerprint(text, k)


def test_within_every_radius():
    rng = random.Random(3)
    fps = np.array(family(rng, 5, 40, 8), np.uint64)
    planes = simhash.bit_planes(fps)
    for radius in (0, 1, 2, 3, 4, 7):
        for i, fp in enumerate(fps):
            for block in range(len(planes)):
                lanes = simhash.within(planes, fps[i : i + 1], np.array([block]), np.array([simhash.FULL]), radius)[0]
                for lane in range(min(64, len(fps) - 64 * block)):
                    near = bin(int(fp) ^ int(fps[64 * block + lane])).count("1") <= radius
                    assert bool(int(lanes) >> lane & 1) == near


def test_links_match_all_pairs_also_in_parts(spark, monkeypatch):
    fps = family(random.Random(5), 60, 12, 4)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    want = slow_classes(fps, lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)
    smallest = {}
    for x, c in zip(signed, want):
        smallest[c] = min(x, smallest.get(c, x))
    want = {x: smallest[c] for x, c in zip(signed, want)}
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for part in (simhash.PART, 4):
        monkeypatch.setattr(simhash, "PART", part)
        found = {r.node: r.root for r in graph.components(simhash.links(df)).collect()}
        assert {x: found.get(x, x) for x in signed} == want


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(7, x) for x in range(500, 560)] + [(3, 3), (7, 500)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {x: 7 for x in [7, *range(500, 560)]}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_in_one_task_and_in_rounds(spark, monkeypatch):
    rng = random.Random(3)
    pairs = [(rng.randrange(-90, 90), rng.randrange(-90, 90)) for _ in range(70)] * 2 + [(-(1 << 63), (1 << 63) - 1)]
    nodes = sorted({x for p in pairs for x in p if p[0] != p[1]})
    linked = {(a, b) for a, b in pairs} | {(b, a) for a, b in pairs}
    want = {x: nodes[r] for x, r in zip(nodes, slow_classes(nodes, lambda i, j: (nodes[i], nodes[j]) in linked))}
    for block in (graph.BLOCK, 10):
        monkeypatch.setattr(graph, "BLOCK", block)
        got = graph.components(spark.createDataFrame(pairs, "a long, b long").repartition(5)).collect()
        assert sorted(map(tuple, got)) == sorted(want.items())


def test_classes_of_odd_rows(docs, same_rows):
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    rows = [(5, None), (9, ""), (2, " "), (3, "A b c d"), (8, "a B c\td"), (8, "a B c\td"), (None, "a b c d"), (11, long), (10, long + " end"), (12, "other words here")]
    out = simhash.classes(docs(rows), 3, 3).select("doc_id", "fp", "component_id").collect()
    signed = lambda t: int(np.array(slow_fingerprint(t, 3), np.uint64).view(np.int64))
    least = {5: 2, 9: 2, 2: 2, 3: 3, 8: 3, None: 3, 11: 10, 10: 10, 12: 12}
    same_rows(out, [(i, signed(t), least[i]) for i, t in rows])
    kept = simhash.deduplicated(docs(rows), 3, 3)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 10, 12]
    assert kept.columns == docs(rows).columns
    assert simhash.classes(docs(rows).limit(0)).count() == 0


def test_hot_bucket_gives_no_pairs(spark):
    fps = spark.range(3000).select((F.col("id") % 64 + 64 * F.floor(F.col("id") / 1500)).alias("fp")).distinct()
    n = fps.count()
    assert simhash.links(fps).count() <= 10 * n
