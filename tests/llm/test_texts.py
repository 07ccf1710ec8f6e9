"""I-Match, license scan, classifier and pieces against plain versions of themselves."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from groundshift.llm import imatch, licenses, pieces, quality
from groundshift.llm.memo import Memo

MODEL = public_tokenizers.path(pieces.MODEL)
LONG = " ".join(f"w{i % 700}x" for i in range(50_000))


def corpus(n=120, seed=4):
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(400)]
    return [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 200)))) for i in range(n)]


def test_lexicon_is_counted_over_all_documents(spark, docs):
    rows = corpus() + [(900, None), (901, "T1, t1 T2!")]
    count = Counter(t for _, text in rows for t in set(imatch.terms(text or "")))
    want = sorted(imatch.term_hash(t) for t, n in count.items() if 0.1 * len(rows) <= n <= 0.2 * len(rows))
    assert imatch.lexicon(docs(rows), (0.1, 0.2)).tolist() == want
    assert imatch.lexicon(docs(rows).limit(0), (0.1, 0.2)).tolist() == []


def test_neighbours_and_edits(spark, docs):
    rows = corpus() + [(None, "first"), (500, None), (501, ""), (502, LONG), (503, LONG), (504, "same text"), (504, "same text")]
    out = imatch.compared(docs(rows).repartition(5), (0.001, 0.9)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    of = imatch.Fingerprinter(imatch.lexicon(docs(rows), (0.001, 0.9)))
    want = Counter()
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        n = len(text) // 4
        new = text[: len(text) - n] + after[:n]
        near = (imatch.likeness(of(text), of(new)), imatch.likeness(of(text), of(after)))
        want[(i, len(text), hashlib.sha256(new.encode()).hexdigest(), imatch.shown(of(text)), imatch.shown(of(new)), *near)] += 1
    assert Counter(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in out) == want
    assert imatch.compared(docs(rows).limit(0)).count() == 0
    alone = imatch.compared(docs([(1, "one two three four")]), (0.5, 1.0)).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_near_edits_are_liker_than_neighbours(spark):
    found = imatch.compared(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    near = found.agg(F.avg("near_edited").alias("e"), F.avg("near_next").alias("n")).first()
    assert near.e > 0.1 and near.n < 0.05


def slow_scan(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        phrase = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(phrase)] == phrase:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_phrases(spark, docs):
    rng = random.Random(2)
    vocabulary = "cc by CC-BY general public License all rights Reserved é x. the".split()
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 25)))) for i in range(250)]
    rows += [(None, None), (700, ""), (701, "cc by cc by cc by"), (701, "cc by cc by cc by"), (None, "all rights reserved"), (702, LONG + " cc by")]
    out = licenses.scan(docs(rows)).collect()
    got = Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in out)
    assert got == Counter((i, *slow_scan(t)) for i, t in rows)
    assert licenses.scan(docs(rows).limit(0)).count() == 0


def test_notices_with_changed_words(spark, docs):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    rows = [(1, f"x y {mit} z"), (2, mit.replace("hereby ", "").replace("person", "legal person")), (3, "permission to copy is granted to any person"), (4, "Released under the MIT License.")]
    out = {r.doc_id: r for r in licenses.scan(docs(rows)).collect()}
    assert [out[i].labels for i in (1, 2, 3, 4)] == ["mit", "mit", "", "mit"]
    assert out[1].score == 1.0 and 0.6 <= out[2].score < 1.0 and out[3].score == 0.0


def test_every_phrase_gram_has_a_vote():
    for t, (words, _, exact) in enumerate(licenses.TEMPLATES):
        assert not exact or licenses.voting(t) == len(words) - licenses.K + 1


def test_memo_keeps_values_and_bounds():
    calls = Counter()

    def fn(key):
        calls[key] += 1
        return key + "!"

    memo = Memo(fn, limit=10, longest=3)
    for _ in range(3):
        assert [memo[k] for k in ("a", "b", "long key")] == ["a!", "b!", "long key!"]
    assert calls == {"a": 1, "b": 1, "long key": 3}
    for i in range(100):
        memo[str(i)]
        assert len(memo) + len(memo.older) <= 10


def test_classifier(spark, docs):
    rng = random.Random(9)
    good, bad = ["sun", "moon", "stars", "river"], ["spam", "offer", "click", "winner"]
    rows = [(i, " ".join(rng.choices(good if i % 2 else bad, k=rng.randint(5, 40)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "sun moon"), (1002, "moon " * 40_000), (1003, "sun"), (1003, "sun")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (5, None), (7777, 0), (9, 0)], "doc_id long, quality int")
    model = quality.train(docs(rows), labels)
    scores = [(r.doc_id, r.quality_score) for r in quality.score(docs(rows), model, ["doc_id", "SIZE"]).collect()]
    assert len(scores) == len(rows) and all(0 <= s <= 1 for _, s in scores)
    held = [(i, s) for i, s in scores if i is not None and i < 400 and zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and sum((s >= 0.7) == i % 2 for i, s in held) >= 0.95 * len(held)
    texts = dict(rows)
    for i, s in scores[::40]:
        found, counts = quality.text_features(texts[i])
        shares = quality.shares(counts)
        assert s == pytest.approx(1 / (1 + np.exp(-(model.bias + float(shares.astype(float) @ model.weights[found])))), abs=1e-4)
    assert quality.score(docs(rows).limit(0), model, ["doc_id"]).count() == 0
    again = quality.train(docs(rows).repartition(7), labels.repartition(3))
    assert np.array_equal(again.weights, model.weights) and again.bias == model.bias


def test_classifier_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(docs([(1, "a")]), none)
    assert [r.quality_score for r in quality.score(docs([(1, "a"), (2, None)]), model, ["doc_id"]).collect()] == [0.5, 0.5]


def slow_paths(arcs, n):
    out = []

    def go(node, score, label):
        if node == 0:
            out.append((label, score))
        for i, part, s in arcs[node] if node else []:
            go(i, score + s, part + label)

    go(len(arcs) - 1, 0.0, b"")
    return sorted(out, key=lambda p: -p[1])[:n]


def alike(got, want):
    assert len(got) == len(want) and len({p for p, _ in got}) == len(got)
    assert all(abs(a[1] - b[1]) < 1e-9 for a, b in zip(got, want))


def test_best_paths_match_all_paths():
    known = pieces.Pieces(MODEL, 4)
    for word in ["the", "tion", "▁antionea", "Überß", "zß中😀x", "aaaaaaaa", "▁▁▁▁▁the"]:
        arcs, ahead = known.lattice(word)
        assert np.allclose(ahead, pieces.forward(arcs))
        for n in (1, 2, 3, 9, 200):
            alike(pieces.best_paths(arcs, n), slow_paths(arcs, n))
    for text in ["a the  b", "the of", " x", "x ", "a", "a a", "\n"]:
        alike(known.segmentations(text), slow_paths(known.lattice("▁" + text.replace(" ", "▁"))[0], 4))


def test_words_side_by_side_are_segmented_like_one_by_one():
    known, rng = pieces.Pieces(MODEL, 3), random.Random(8)
    words = ["".join(rng.choices("aeiothnsré,.\n1 é中😀", k=rng.randrange(12))) for _ in range(3000)] + ["the", "", "mentêé", "x" * 40]
    keys, ids, sizes, scores, losses = known._learn(words)
    assert sorted(keys) == sorted(words)
    ends = np.cumsum(sizes)
    for i, word in enumerate(keys):
        label, score, loss = known._word(word)
        mine = ids[ends[i] - sizes[i] : ends[i]]
        assert scores[i] == pytest.approx(score, abs=1e-9) and losses[i] == pytest.approx(loss, abs=1e-9)
        assert mine.astype("<u4").tobytes() == label or loss < 1e-9


def test_encode_and_decode(spark, docs):
    texts = ["", None, "plain words", " two  spaces ", "line\nbreak\t", "é中文 😀 \x00", "a▁b", "same", "same", "w " * 30_000, "x" * 3000]
    rows = list(enumerate(texts)) + [(None, "no id")]
    out = {r.doc_id: r for r in pieces.encode(docs(rows), MODEL, nbest=3, ids=True).collect()}
    for i, text in rows:
        r = out[i]
        assert r.decoded == (text or "").replace("▁", " ")
        assert r.n_pieces == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.crcs[0]
        assert r.scores == sorted(r.scores, reverse=True) and r.score == r.scores[0]
    assert (out[7].ids, out[7].score) == (out[8].ids, out[8].score)
    assert pieces.encode(docs(rows).limit(0), MODEL).count() == 0


def test_pieces_hold_little_beside_a_batch():
    """Memory while a batch of 8 MB of text is begun: it goes with the slice, not with the batch."""
    known, rng = pieces.Pieces(MODEL, 3), random.Random(6)
    vocabulary = ["".join(rng.choices("aeiothnsr", k=6)) for _ in range(500)]
    text = " ".join(rng.choices(vocabulary, k=300))
    batch = pa.record_batch({"doc_id": range(4000), "text": [text] * 4000})
    names = [c.split()[0] for c in pieces.SCHEMA.split(", ")] + ["ids"]
    tracemalloc.start()
    try:
        first = next(pieces.encoded([batch], known, names))
        assert 0 < first.num_rows < 4000 and tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()
