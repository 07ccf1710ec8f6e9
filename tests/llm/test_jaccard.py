import random

import numpy as np
import pytest

from groundshift.llm import graph, jaccard

WORDS = [f"w{i}" for i in range(4000)]


def grams(text, k=5):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain(rows, least=80, k=5):
    """All pairs, then components over rows."""
    sets, root = [grams(t, k) for _, t in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= least * len(a | sets[j]):
                root[top(i)] = top(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[top(i)] = min(d, best.get(top(i), d))
    return sorted(((d, len(sets[i]), best.get(top(i))) for i, (d, _) in enumerate(rows)), key=repr)


def found(docs, rows, **how):
    return sorted((tuple(r) for r in jaccard.classes(docs(rows), **how).collect()), key=repr)


def edited(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = rng.choice(WORDS)
    return out


@pytest.fixture(scope="module")
def corpus():
    """Loose texts, groups of near copies around the threshold, and passages that many texts share."""
    rng = random.Random(4)
    passage = rng.choices(WORDS, k=60)
    rows = []
    for i in range(60):
        own = rng.choices(WORDS, k=rng.choice([3, 8, 40, 200]))
        rows.append(own + passage if i % 2 else own)
    for size in (6, 12, 25, 60, 300):
        base = rng.choices(WORDS, k=size)
        for n in range(6):
            rows.append(edited(rng, base, min(size, n * max(1, size // 60))))
        rows.append(base[: size * 82 // 100])
    return [(i, " ".join(r)) for i, r in enumerate(rows)]


def test_equals_all_pairs(docs, corpus):
    assert found(docs, corpus) == plain(corpus)


def test_exactly_at_the_threshold(docs):
    base = [f"a{i}" for i in range(104)]  # 100 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:84])), (3, " ".join(base[:83]))]  # 80 and 79 of them
    want = [(1, 100, 1), (2, 80, 1), (3, 79, 1)]  # 79 of 80 links with the second only
    assert found(docs, rows) == want == plain(rows)
    assert found(docs, [rows[0], rows[2]]) == [(1, 100, 1), (3, 79, 3)]


def test_odd_rows(docs):
    text = "One two  three\tfour five\nsix seven"
    rows = [(9, text), (4, text.upper()), (4, text), (None, text), (5, None), (6, ""), (7, " \n"), (8, "one two"), (3, "ONE Two"), (2, "É b c d e f"), (1, "é b c d e f")]
    assert found(docs, rows) == plain(rows)
    assert found(docs, []) == []


def test_many_near_copies_and_parts(docs, monkeypatch):
    """Gatherings larger than a part: hubs connect most, the rest meets the others."""
    rng = random.Random(6)
    monkeypatch.setattr(jaccard, "PART", 16)
    base = rng.choices(WORDS, k=120)
    rows = [(i, " ".join(edited(rng, base, 1))) for i in range(90)]
    far = edited(rng, base, 9)  # shares prefixes with the group, links with few
    rows += [(200 + i, " ".join(edited(rng, far, 1))) for i in range(30)]
    assert found(docs, rows) == plain(rows)


def test_heavy_tokens_small_blocks_and_buckets_change_nothing(docs, corpus, monkeypatch):
    for name, value in {"SAMPLE": 20, "HEAVY": 10, "BLOCK": 100, "BUCKET_BYTES": 1000}.items():
        monkeypatch.setattr(jaccard, name, value)
    assert found(docs, corpus) == plain(corpus)


def test_linked_sets_share_a_prefix_token_under_every_order():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a = rng.choice(10_000, n, replace=False).astype(np.uint64)
        b = a.copy()
        for at in rng.choice(n, int(rng.integers(0, max(1, n // 8) + 1)), replace=False):
            b[at] = rng.integers(20_000, 30_000)
        b, count = np.unique(b), {t: int(rng.integers(2, 50)) for t in {*a.tolist(), *b.tolist()}}
        if 100 * len(set(a) & set(b)) < 80 * len(set(a) | set(b)):
            continue
        for k in range(jaccard.ORDERS):
            first = []
            for s in (a, b):
                p = len(s) - int(jaccard.least_shared(np.array([len(s)]), 80)[0]) + 1
                first.append(set(s[jaccard.ordered(s, np.array([count[t] for t in s.tolist()]), k)[:p]].tolist()))
            assert first[0] & first[1]


@pytest.fixture
def tables(monkeypatch):
    """The names of the tables that a run writes on its way."""
    names = []
    for module in (graph, jaccard):
        monkeypatch.setattr(module, "stored", lambda df, name, write=module.stored: names.append(name) or write(df, name))
    return names


def near_copies(rng, parts):
    """A long chain, a dense group, and a group some of whose texts only their neighbours link with."""
    base, rows = rng.choices(WORDS, k=120), []
    for i in range(3 * parts):
        base = edited(rng, base, 1)
        rows.append(" ".join(base))
    rows += [" ".join(edited(rng, base, 2)) for _ in range(2 * parts)]
    return [(i, text) for i, text in enumerate(rows)]


def test_few_links_take_no_rounds(docs, monkeypatch, tables):
    """However long the chains, a run of few links writes a fixed number of tables."""
    monkeypatch.setattr(jaccard, "PART", 16)
    rows = near_copies(random.Random(8), 16)
    assert found(docs, rows) == plain(rows)
    assert len(tables) <= 18 and not {"least", "large-stars", "small-stars"} & set(tables)


def test_many_links_go_in_rounds(docs, monkeypatch, tables):
    monkeypatch.setattr(jaccard, "PART", 16)
    monkeypatch.setattr(graph, "BLOCK", 20)
    rows = near_copies(random.Random(8), 16)
    assert found(docs, rows) == plain(rows)
    assert "small-stars" in tables
