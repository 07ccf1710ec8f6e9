import hashlib
import math
import random

import pytest

import corpus_pipeline
from groundshift.llm import quality, simhash


def test_encoding_returns_all_scores_and_a_digest_of_the_decoded_text(spark, docs):
    texts = {1: "Some words, and  more é中 😀\n", 2: "", 3: "a"}
    out = {r.doc_id: r for r in corpus_pipeline.to_pieces(spark, docs(list(texts.items())), "").collect()}
    assert sorted(out) == sorted(texts)
    for i, text in texts.items():
        assert out[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert out[i].n_pieces == len(out[i].ids) and out[i].score == out[i].scores[0]
    assert len(out[1].scores) == len(out[1].crcs) == 3


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture
def folder(spark, docs, tmp_path):
    """A folder of input tables with the given documents and labels."""

    def build(rows, labels=()):
        docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
        spark.createDataFrame(list(labels), LABELS).write.parquet(str(tmp_path / "labels.parquet"))
        return str(tmp_path)

    return build


def words(rng, kind, n):
    return " ".join(f"{kind}{rng.randrange(300)}" for _ in range(n))


def corpus():
    """Good and bad texts with copies and near copies, null ids and texts, and repeated rows."""
    rng = random.Random(3)
    rows = [(i, words(rng, "good" if i % 3 else "bad", rng.randint(20, 60)), "ab"[i % 2]) for i in range(240)]
    rows += [(500 + i, rows[1][1], "a") for i in range(60)]  # a third are copies of one text
    rows += [(600 + i, " ".join(rows[2][1].split()[:-1] + [f"new{i}"]), "b") for i in range(5)]
    rows += [(None, words(rng, "good", 30), "a"), (700, None, None), (701, "", "b"), (702, rows[4][1].upper(), "a"), rows[7], rows[7]]
    labels = [(i, int(i % 3 > 0), 0) for i in range(240)] + [(None, 1, 0), (3, None, 0)]
    return rows, labels


def one_by_one(texts):
    """Rows by the smallest id, then place, of their component at three bits of 64."""
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    prints = [simhash.fingerprint(t, 3) for t in texts]
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                root[top(i)] = top(j)
    return [top(i) for i in range(len(texts))]


def test_every_stage_against_a_plain_version(spark, folder):
    rows, labels = corpus()
    sf = folder(rows, labels)
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    model = quality.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    kept = corpus_pipeline.keep_good(spark, docs, sf)
    assert kept.columns == docs.columns

    def accepted(text):
        found, counts = quality.text_features(text)
        logit = model.bias + float(quality.shares(counts).astype(float) @ model.weights[found])
        return 1 / (1 + math.exp(-logit)) >= quality.ACCEPT

    want = [(i, t, s) for i, t, s in rows if accepted(t)]
    assert sorted(((r.doc_id, r.text, r.source) for r in kept.collect()), key=repr) == sorted(want, key=repr)
    assert sum(i is not None and i < 240 for i, _, _ in want) > 100

    single = corpus_pipeline.one_of_each(spark, docs, sf)
    assert single.columns == docs.columns
    groups = {}
    for (i, t, s), root in zip(rows, one_by_one([t for _, t, _ in rows])):
        groups.setdefault(root, []).append((i is None, i or 0))
    got = sorted(((r.doc_id is None, r.doc_id or 0) for r in single.collect()))
    assert got == sorted(min(g) for g in groups.values())

    mix = corpus_pipeline.mix_sources(spark, docs, sf)
    assert mix.columns == docs.columns
    taken = [(r.source, len(r.text.split())) for r in mix.collect()]
    sizes = {s: sum(len((t or "").split()) for _, t, x in rows if x == s) for s in ("a", "b")}
    longest = max(n for _, n in taken)
    # weights 1 and 2 of all words; neither reaches three times its source
    for source, weight in (("a", 1), ("b", 2)):
        target = min(sum(sizes.values()) * weight / 3, 3 * sizes[source])
        assert abs(sum(n for s, n in taken if s == source) - target) <= longest


def test_empty_and_odd_tables_pass_through(spark, folder):
    sf = folder([])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_whole_pipeline_without_labels_keeps_what_it_can(spark, folder):
    """Without labels every score is 0.5, so nothing is accepted; with one class only, its share decides."""
    rows = [(1, "a few words here", "s"), (2, None, None), (None, "other words there", "s")]
    sf = folder(rows, [(1, 1, 0), (2, 1, 0)])
    out = corpus_pipeline.run(spark, sf).collect()
    assert sorted((r.doc_id for r in out), key=repr) == [1, None] and all(len(r.ids) == r.n_pieces for r in out)
