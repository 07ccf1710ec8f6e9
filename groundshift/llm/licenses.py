"""License scan by diagonal voting.

Every rolling word k-gram hash of every text is joined with the positions of
that gram in the templates. A hit votes for the diagonal "place in the text minus
place in the template"; the votes of a text, template and diagonal are counted,
diagonals beside each other are merged (a word more or less shifts the
diagonal), and what remains is verified word by word against the template.

A phrase is found where its words stand consecutively: all its grams lie on one
diagonal. A notice is found where a merged span holds at least ``NOTICE`` of its
grams and verification matches at least that share of its words in order. The
score is the best share of matched words of any place, 1 for a phrase.

Grams of two function words carry no vote: they are everywhere. The template
positions are a fixed list of a few hundred rows, so the join needs no shuffle;
only hits are shuffled, and texts only to be verified.

Nulls: a null text is an empty one and has no words; a null id is carried along.
Rows that agree in id and text get the same result each. An empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from groundshift.llm.memo import Memo
from groundshift.llm.scratch import stored

# Phrases that are found exactly, with their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Words of public license notices, with their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "this work is licensed under the gnu general public license": "gpl",
    "you can redistribute it and or modify it under the terms of the gnu general public license": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by nc": "cc-by-nc",
    "licensed under a creative commons attribution": "cc-by",
}
# English function words.
FUNCTION_WORDS = frozenset("a an and any are as at be by for from in is it not of on or that the this to under was with you".split())

K = 2
NOTICE = 0.6
#: Diagonals this far apart are one span, if no more than so many words lie between their ends.
DRIFT, GAP = 2, 4
#: Odd multiplier of the rolling hash.
BASE = np.uint64(0x9E3779B97F4A7C15)
TEMPLATES = [(words.split(), label, exact) for table, exact in ((PHRASES, True), (NOTICES, False)) for words, label in table.items()]

_BYTES = bytes(c | 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, ASCII letters lowered."""
    return (text or "").encode("utf-8", "replace").translate(_BYTES).split()


def rolling(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of all k-grams of words, from the words' hashes."""
    out = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    for i in range(k):
        out = out * BASE + hashes[i : i + len(out)]
    return out


def word_hashes(words: list[bytes], memo: Memo) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def template_grams(spark: SparkSession) -> DataFrame:
    """``gram, template, place``: every gram of every template but those of function words."""
    memo, rows = Memo(xxhash.xxh64_intdigest), []
    for t, (words, _, _) in enumerate(TEMPLATES):
        grams = rolling(word_hashes([w.encode() for w in words], memo)).view(np.int64).tolist()
        rows += [(g, t, i) for i, g in enumerate(grams) if not FUNCTION_WORDS.issuperset(words[i : i + K])]
    return spark.createDataFrame(rows, "gram long, template int, place int")


def voting(t: int) -> int:
    """Grams of a template that carry a vote."""
    words = TEMPLATES[t][0]
    return sum(not FUNCTION_WORDS.issuperset(words[i : i + K]) for i in range(len(words) - K + 1))


def hits(docs: DataFrame) -> DataFrame:
    """One row per text without template, and one per gram of it that a template holds: ``at`` and ``place``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(xxhash.xxh64_intdigest, 400_000)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                counts, grams, ends = [], [], [0]
                for text in part.column(2):
                    words = words_of(text.as_py())
                    found = rolling(word_hashes(words, memo))
                    counts.append(len(words))
                    grams += [np.zeros(1, np.uint64), found]  # the first place is the text's own row
                    ends.append(ends[-1] + 1 + len(found))
                flat = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(grams).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts, pa.int64()), flat], names)

    names = ["doc_id", "text_key", "n_words", "grams"]
    rows = docs.select("doc_id", "text_key", "text").mapInArrow(run, "doc_id long, text_key long, n_words long, grams array<long>")
    rows = rows.select("doc_id", "text_key", "n_words", F.posexplode("grams").alias("at", "gram"))
    found = rows.join(F.broadcast(template_grams(docs.sparkSession)), "gram", "left")  # a fixed list
    found = found.where((F.col("at") == 0) | F.col("template").isNotNull())
    template = F.when(F.col("at") > 0, F.col("template")).alias("template")
    return found.select("doc_id", "text_key", "n_words", (F.col("at") - 1).alias("at"), template, "place")


def spans(found: DataFrame) -> DataFrame:
    """``doc_id, text_key, template, start, stop`` of merged diagonals with enough votes."""
    key = ["doc_id", "text_key", "template"]
    found = found.where(F.col("template").isNotNull()).withColumn("diagonal", F.col("at") - F.col("place"))
    lines = found.groupBy(*key, "diagonal").agg(F.collect_set("place").alias("places"), F.min("at").alias("start"), F.max("at").alias("stop"))
    order = Window.partitionBy(*key).orderBy("start", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > F.col("drift")) | (F.col("start") - F.lag("stop").over(order) > GAP)
    exact = F.array(*[F.lit(e) for _, _, e in TEMPLATES])
    needed = F.array(*[F.lit(voting(t) if e else max(1, int(NOTICE * voting(t)))) for t, (_, _, e) in enumerate(TEMPLATES)])
    lines = lines.withColumn("drift", F.when(F.element_at(exact, F.col("template") + 1), 0).otherwise(DRIFT))
    lines = lines.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("new").over(order))
    merged = lines.groupBy(*key, "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("votes"),
        F.min("start").alias("start"),
        (F.max("stop") + K).alias("stop"),
    )
    return merged.where(F.col("votes") >= F.element_at(needed, F.col("template") + 1)).drop("span", "votes")


def matched(words: list[bytes], template: list[bytes]) -> float:
    """Share of the template's words that stand in the text in its order."""
    blocks = SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks()
    return sum(b.size for b in blocks) / len(template)


RESULT = "n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words`` and what was found, for every row of ``docs``.

    ``n_base`` counts the places of phrases, ``first_word`` and ``last_word``
    are the smallest and largest first word of them, from 0; null without any.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    found = stored(hits(docs), "license-hits")
    known = [([w.encode() for w in words], label, exact) for words, label, exact in TEMPLATES]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, key, text, places in zip(*batch.columns, strict=True):
                words, base, labels, starts, score = words_of(text.as_py()), set(), set(), [], 0.0
                for t, start, stop in (p.values() for p in places.as_py()):
                    template, label, exact = known[t]
                    if exact:
                        # a phrase's outer grams may be without vote, so its place is that of its diagonal
                        if words[start : start + len(template)] == template:
                            starts.append(start)
                            base.add(label)
                            score = 1.0
                    elif (share := matched(words[max(0, start - DRIFT) : stop + DRIFT], template)) >= NOTICE:
                        labels.add(label)
                        score = max(score, share)
                shown = [",".join(sorted(x)) for x in (base, base | labels)]
                rows.append((doc_id.as_py(), key.as_py(), len(starts), min(starts, default=None), max(starts, default=None), *shown, score))
            kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = ["doc_id", "text_key", *[c.split()[0] for c in RESULT.split(", ")]]
    places = spans(found).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("template", "start", "stop")).alias("places"))
    a, b = docs.alias("a"), places.alias("b")
    same = (F.col("a.text_key") == F.col("b.text_key")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
    checked = a.join(b, same).select("a.doc_id", "a.text_key", "a.text", "b.places").dropDuplicates(["doc_id", "text_key"])
    checked = checked.mapInArrow(verify, f"doc_id long, text_key long, {RESULT}")
    c, d = found.where(F.col("template").isNull()).alias("a"), checked.alias("b")
    return c.join(d, same, "left").select(
        "a.doc_id",
        "a.n_words",
        F.coalesce("b.n_base", F.lit(0)).alias("n_base"),
        "b.first_word",
        "b.last_word",
        F.coalesce("b.base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("b.labels", F.lit("")).alias("labels"),
        F.coalesce("b.score", F.lit(0.0)).alias("score"),
    )
