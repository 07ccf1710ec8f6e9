"""I-Match document fingerprints over randomised lexicons.

The lexicon holds the terms whose share of documents lies in a band, that is
whose inverse document frequency does. A document's distinct lexicon terms are
sorted and, for each of several random subsets of the lexicon, those in the
subset are hashed. Subsets come in several sizes, because a document of few
terms is only seen by a large subset and one of many is only kept alike by a
small one. Two fingerprints are as alike as the share of agreeing hashes among
the subsets that hold a term of either.

The lexicon is broadcast. Terms that are in at least the share ``least`` of all
documents number at most the mean count of distinct terms per document divided
by ``least``, whatever the number of documents; that bound is checked.

Nulls: a null text is an empty one; it has no terms, and equal fingerprints are
alike to 1 even if they hold none. Null ids come first. Rows of equal id come by
text hash; repeated rows follow each other. The row after the last
is the first. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from groundshift.llm.memo import Memo
from groundshift.llm.scratch import stored

#: Share of documents that hold a term of the lexicon, at least and at most.
BAND = (0.001, 0.5)
#: Subsets of the lexicon hold one term in so many; so many subsets of each size.
ONE_IN, OF_EACH = (16, 64, 256), 12
#: Lexicon terms that are broadcast at most (eight octets each).
LEXICON_ROWS = 8_000_000
_WORD_BYTES = bytes(c | 32 if 65 <= c <= 90 else c if chr(c).isalnum() and c < 128 or c > 127 else 32 for c in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, ASCII letters lowered."""
    return text.encode("utf-8", "replace").translate(_WORD_BYTES).split()


def term_hash(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term)


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> np.ndarray:
    """Sorted hashes of the terms in the band, counted over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Memo(term_hash, 400_000)
        for batch in batches:
            found: Counter[bytes] = Counter()
            for text in batch.column(0):
                found.update(set(terms(text.as_py() or "")))
            keys = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found)).view(np.int64)
            counts = np.fromiter(found.values(), np.int64, len(found))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["term", "n"])

    total = docs.count()
    counted = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    kept = counted.where((F.col("n") >= band[0] * total) & (F.col("n") <= band[1] * total)).select("term")
    found = kept.limit(LEXICON_ROWS + 1).toArrow().column(0).to_numpy()
    if len(found) > LEXICON_ROWS:
        raise ValueError(f"the band {band} holds over {LEXICON_ROWS} terms: raise its lower end")
    return np.sort(found.view(np.uint64))


class Fingerprinter:
    """Fingerprints of texts under one lexicon: one 32-bit hash per subset, 0 where the subset holds no term."""

    def __init__(self, known: np.ndarray, seed: int = 11):
        self.known = frozenset(known.tolist())
        self.terms = Memo(self._known, 400_000)
        rng = np.random.default_rng(seed)
        self.seeds = rng.integers(1, 1 << 63, len(ONE_IN) * OF_EACH, np.uint64)[:, None] | np.uint64(1)
        self.limits = np.repeat(np.array([(1 << 64) // n - 1 for n in ONE_IN], np.uint64), OF_EACH)[:, None]

    def _known(self, term: bytes) -> int:
        """The term's hash, 0 if it is not in the lexicon."""
        found = term_hash(term)
        return found if found in self.known else 0

    def __call__(self, text: str) -> np.ndarray:
        found = set(map(self.terms.__getitem__, set(terms(text))))
        found.discard(0)
        out = np.zeros(len(self.seeds), np.uint32)
        if found:
            hashes = np.sort(np.fromiter(found, np.uint64, len(found)))
            mixed = (hashes ^ (hashes >> np.uint64(29))) * self.seeds
            inside = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) <= self.limits
            for k in np.flatnonzero(inside.any(axis=1)):
                out[k] = xxhash.xxh32_intdigest(hashes[inside[k]].tobytes(), int(k)) or 1
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    held = (a != 0) | (b != 0)
    return float((a == b)[held].mean()) if held.any() else 1.0


def shown(fingerprint: np.ndarray) -> bytes:
    return fingerprint.astype(">u4").tobytes()


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by the first as many of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
EDGES = "shard int, edge string, text string"


def compared(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike they and the next document's are.

    Documents are dealt out by ranges of id, their texts compressed on the way, so
    all but the last of a range meet the next one in their task. The last of each range is kept aside with its
    text, and so is the first; these two per range are paired afterwards.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = docs.sparkSession.sparkContext.broadcast(lexicon(docs, band))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
    names = [c.split()[0] for c in f"{RESULT}, {EDGES}".split(", ")]

    def result(of: Fingerprinter, doc_id: int | None, text: str, own: np.ndarray, after: str, after_own: np.ndarray) -> tuple:
        new = edited(text, after)
        new_own = own if new == text else of(new)
        digest = hashlib.sha256(new.encode()).hexdigest()
        return (doc_id, len(text), digest, shown(own), shown(new_own), likeness(own, new_own), likeness(own, after_own))

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds)], names[: len(rows[0])])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([packer.compress((t.as_py() or "").encode()) for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), packed], ["doc_id", "text_key", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # the terms kept hold no cycles
        of, shard, before = Fingerprinter(known.value), TaskContext.get().partitionId(), None
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(2)):
                text = unpacker.decompress(packed.as_py()).decode()
                now = (doc_id, text, of(text))
                if before is None:
                    rows.append((None,) * 7 + (shard, "first", text))
                else:
                    rows.append((*result(of, *before, *now[1:]), shard, None, None))
                before = now
            yield table(rows)
        if before is not None:
            yield table([(before[0],) + (None,) * 6 + (shard, "last", before[1])])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Fingerprinter(known.value)
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, text, after = (c[i].as_py() for c in batch.columns)
                yield table([result(of, doc_id, text, of(text), after, of(after))])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    rows = rows.mapInArrow(pack, "doc_id long, text_key long, packed binary")
    key = [F.col("doc_id").asc_nulls_first(), F.col("text_key")]
    rows = rows.repartitionByRange(*key).sortWithinPartitions(*key)
    out = stored(rows.mapInArrow(run, f"{RESULT}, {EDGES}"), "imatch")
    firsts = out.where("edge = 'first'").select("shard", F.col("text").alias("after"))
    shards = firsts.select("shard")  # one row per range of ids
    order = Window.orderBy("shard")
    follows = shards.select("shard", F.coalesce(F.lead("shard").over(order), F.min("shard").over(Window.partitionBy())).alias("next"))
    lasts = out.where("edge = 'last'").select("doc_id", "text", "shard").join(follows, "shard")
    lasts = lasts.join(firsts.withColumnRenamed("shard", "next"), "next").select("doc_id", "text", "after")
    done = out.where("edge is null").select(*names[:7])
    return done.unionByName(lasts.mapInArrow(pairs, RESULT))


def as_text(fingerprint: Column) -> Column:
    return F.lower(F.hex(fingerprint))
