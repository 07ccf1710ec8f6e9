import random
import re
from collections import Counter

import numpy as np

from groundshift.llm import phrases

SCHEMA = "text string, lang string, phrase string, n int"


def table(spark, rows):
    return spark.createDataFrame([(t, lang, "x", 1) for t, lang in rows], SCHEMA)


def plain(rows, least, share=80, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3, 4):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, seen in f.items():
        found = {p: a for p, a in seen.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in found.items():
            score, k = min((2000000 * a // (seen[p[:k]] + seen[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            if not inside:
                rows_.append((-score, -a, " ".join(p).encode(), seen[p[:k]], seen[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def found(spark, rows, **how):
    return sorted(tuple(r) for r in phrases.collocations(table(spark, rows), **how).collect())


def corpus():
    rng = random.Random(2)
    words = ["Alpha", "beta", "gamma", "Δelta", "epsi lon", "a", "b", "The", "the", "x"]
    rows = []
    for i in range(160):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"]) for _ in range(rng.randrange(40)))
        rows.append((text + " of the old house, " * (i % 3), rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" .,\n", "fr")] + [rows[0]] * 3


def test_equals_plain_counts(spark, monkeypatch):
    rows = corpus()
    assert found(spark, rows, least=4) == plain(rows, 4)
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 60)
    monkeypatch.setattr(phrases, "BUCKET_WORDS", 100)
    assert found(spark, rows, least=3, share=50, top=7) == plain(rows, 3, 50, 7)


def test_collisions_are_told_apart_by_text(spark, monkeypatch):
    """With all fingerprints equal, blocks and the final counts must still go by words."""
    monkeypatch.setattr(phrases.Block, "fingerprints", lambda self, n, starts: np.zeros(len(starts), np.uint64))
    data = phrases.Block("en", b"a\nb", np.array([0, 1, 0, 1, -1, 1, 1], np.int32).tobytes())
    got = {tuple(data.ids[p : p + 2].tolist()): int(n) for _, c, at in data.entries(2, data.starts(2)) for n, p in zip(c, at)}
    assert got == {(0, 1): 2, (1, 0): 1, (1, 1): 1}


def test_without_phrases(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None), ("one two", "en")]) == []
    assert found(spark, [("a b", "en")] * 30, least=30) == [("en", 1, "a b", 30, 30, 30, 60, 1000000)]


def test_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    grams = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big), ("en", "b", 1, big - 1)], "lang string, phrase string, words int, f long")
    (row,) = phrases.scored(grams).collect()
    assert row.score == 2000000 * big // (2 * big - 1)
