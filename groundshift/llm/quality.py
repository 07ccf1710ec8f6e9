"""Quality classifier on learned subword embeddings.

Every word and every character n-gram of it (word ends marked) is hashed to a
row of one embedding table. Of the word bigrams, those of a word with itself
share a row of their own; other bigrams have none. A text is the average of its
rows, a softmax layer gives the classes. Table and layer are learned by stochastic gradient descent.

Labels come from a bounded sample: the ``TRAIN_ROWS`` labelled documents with
the smallest hash of their id, up to ``TRAIN_CHARS`` characters in that order, so
a rerun learns from the same rows. Whole texts
are read, in training and in scoring. Since the layer is linear in the average,
a text's logit is the average of one number per feature, so scoring carries one
number per table row and keeps sums by word.

Nulls: a null text is scored like an empty one, by the layer's bias alone; null
ids and null labels are not learned from; of several labels of one id the
smallest counts. Without labels of both classes every score is the share of
label 1 (0.5 without labels). Rows are scored one by one, so repeated rows score
the same, an empty table gives an empty result. Ids, sources, languages and
other columns are never inputs.
"""

from __future__ import annotations

import gc
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from groundshift.llm.memo import Memo
from groundshift.llm.scratch import columns, fresh

#: Labelled documents learned from, and characters of these, at most.
TRAIN_ROWS, TRAIN_CHARS = 4000, 1 << 25
BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
#: The table row of a word that follows itself.
AGAIN = BUCKETS
ACCEPT = 0.7


def word_features(word: bytes) -> list[int]:
    """Table rows of a word: its own and those of its character n-grams."""
    mask, crc, marked = BUCKETS - 1, zlib.crc32, b"<" + word + b">"
    out = [crc(marked, 1) & mask]
    for n in GRAMS:
        out += [crc(marked[i : i + n]) & mask for i in range(len(marked) - n + 1)]
    return out


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def repeats(words: list[bytes]) -> int:
    return sum(map(eq, words, islice(words, 1, None)))


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table rows of a text and how often it has them."""
    words = words_of(text)
    found = Counter({AGAIN: again}) if (again := repeats(words)) else Counter()
    for word, n in Counter(words).items():
        for f in word_features(word):
            found[f] += n
    return np.fromiter(found.keys(), np.int32, len(found)), np.fromiter(found.values(), np.int32, len(found))


def shares(counts: np.ndarray) -> np.ndarray:
    out = counts.astype(np.float32)
    return out / max(1.0, float(out.sum()))


@dataclass
class Model:
    """``logit = mean(weights[features]) + bias``; the score is its logistic function."""

    weights: np.ndarray
    bias: float


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], dim: int = 8, epochs: int = 6, rate: float = 0.5, seed: int = 7) -> Model:
    """Learn from ``(rows, shares, label)``; every step moves along one text's gradient, scaled by its spread over rows."""
    positive = sum(label for _, _, label in samples)
    if not 0 < positive < len(samples):
        share = positive / len(samples) if samples else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(BUCKETS + 1), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (BUCKETS + 1, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, 2), np.float32), np.log(np.array([len(samples) - positive, positive], np.float32) / len(samples))
    step, steps = 0, epochs * len(samples)
    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            rows, shares, label = samples[k]
            now = rate * (1 - step / steps)
            step += 1
            mean = shares @ table[rows]
            logits = mean @ layer + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = layer @ error
            spread = float(shares @ shares)
            layer -= now * np.outer(mean, error)
            bias -= now * 0.01 * error
            if spread:
                table[rows] -= (now / spread * shares)[:, None] * back
    return Model((table @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: those whose crc32 of the id leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = TRAIN_ROWS, max_chars: int = TRAIN_CHARS) -> Model:
    """Fit a model to labelled rows that are not held out: at most ``max_rows``, and ``max_chars`` characters of them.

    Features are made in parallel and learned from in one task, which is all that
    ever holds the sample; the driver gets the finished weights.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    lengths = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    known = known.join(lengths.groupBy("doc_id").agg(F.max("chars").alias("chars")), "doc_id")
    known = known.where(F.col("chars") <= max_chars).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("chars").alias("chars"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    upto = F.sum("chars").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))  # max_rows rows
    known = known.withColumn("upto", upto).where(F.col("upto") <= max_chars).select("doc_id", "label")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows, counts = text_features(batch.column(1)[i].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(2).slice(i, 1), pa.array([rows]), pa.array([counts])],
                    ["doc_id", "label", "rows", "counts"],
                )

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = []
        for batch in batches:
            for i in range(batch.num_rows):
                samples.append((batch.column(1)[i].values.to_numpy(), shares(batch.column(2)[i].values.to_numpy()), batch.column(0)[i].as_py()))
        if samples:
            model = fit(samples)
            yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()]), pa.array([model.bias])], ["weights", "bias"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")  # max_rows rows
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    found = texts.mapInArrow(features, "doc_id long, label int, rows array<int>, counts array<int>")
    found = found.repartition(1).sortWithinPartitions("doc_id").select("label", "rows", "counts")
    model = found.mapInArrow(learned, "weights binary, bias double").first()
    return Model(np.frombuffer(model.weights, np.float64), model.bias) if model else fit([])


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``quality_score``, between 0 and 1."""
    (name,) = fresh(docs, "quality_score")
    weights, bias = docs.sparkSession.sparkContext.broadcast(model.weights), model.bias  # BUCKETS + 1 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = weights.value.tolist()
        gc.disable()  # the words kept hold no cycles

        def of(word: bytes) -> tuple[float, int]:
            rows = word_features(word)
            return sum([table[r] for r in rows]), len(rows)

        memo = Memo(of, 400_000)
        for batch in batches:
            logits = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                words = words_of(text.as_py())
                found, again = list(map(memo.__getitem__, words)), repeats(words)
                total = sum([f[0] for f in found]) + again * table[AGAIN]
                logits[i] = bias + total / max(1, sum([f[1] for f in found]) + again)
            scores = pa.array(1 / (1 + np.exp(-np.clip(logits, -500, 500))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], [*keep, name])

    kept = columns(docs, keep)
    rows = docs.select(*kept, F.col("text").alias("quality_text"))
    schema = docs.select(*kept, F.lit(0.0).alias(name)).schema
    return rows.mapInArrow(run, schema)
