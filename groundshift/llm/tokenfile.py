"""Token ids in binary files with a shared compression dictionary.

A zstandard dictionary is trained on the serialized id arrays of a bounded
sample; every document is then compressed by itself, so a short document is read
alone and still compresses well. Layout of a shard, all numbers little-endian:

    8 bytes   magic
    32 bytes  SHA-256 of the dictionary
    frames    one zstandard frame per document: ids as unsigned 32-bit integers
    index     per document: id (int64), 1 if the id is null (uint8), frame offset (uint64), number of ids (uint64)
    16 bytes  offset of the index (uint64), number of documents (uint64)
    8 bytes   magic

The dictionary lies beside the shards in a file named by its hash. Shards follow
each other in ascending document id. A task writes a file of a name of its own
and returns it; the list of the files of the tasks that succeeded is a table
written once, so a lost or repeated task leaves at most a file nobody lists.

Nulls: a null text is an empty one, so it has the end id alone; null ids come
first. Rows of equal id come by text hash, then text, and repeated rows are
written each. An empty table gives no shards. Other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from groundshift.llm.scratch import filesystem, one_task_each, stored
from groundshift.llm.wordpool import Pool, coded, slices

MAGIC = b"TOKENID1"
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("n", "<u8")])
TAIL = np.dtype([("at", "<u8"), ("docs", "<u8")])
#: Documents that the dictionary is trained on, ids taken of each (from all over it), and its size.
SAMPLE_DOCS, SAMPLE_IDS, DICTIONARY_BYTES = 2000, 4096, 64 << 10
#: Parts kept by a worker, and those encoded in one call.
PARTS, TOGETHER = 900_000, 4096
_BOUNDARY = re.compile(r" (?=\S)")
#: A space before white space (as Python's ``\\s`` has it) or the end, in the syntax of Arrow.
SOME_SPACE = "(?s) ($|[\\s\x0b\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000])"


class Encoder:
    """Byte-level BPE ids of whole texts by the tokenizers library.

    The pattern that splits a text before the merges starts a new piece at every
    space that a non-space follows, so the parts between such spaces are encoded
    by themselves and kept for the next time. New parts are encoded many in one
    call: each begins with the only token that starts with its space. A text that
    holds an added token (such as the end of text) is encoded as a whole.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        added = sorted(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.added = "|".join(map(re.escape, added))
        size = max(self.tokenizer.get_vocab().values()) + 1
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.parts = Pool(self._learn, PARTS)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, parts: list) -> tuple[list, np.ndarray, np.ndarray]:
        """Ids of parts behind their space; a tuple holds a part that begins a text and has none."""
        plain, alone = [], []
        for part in parts:
            (plain if type(part) is str and " " not in part else alone).append(part)
        keys, found, sizes = [], [np.zeros(0, "<u4")], []
        for at in range(0, len(plain), TOGETHER):
            some = plain[at : at + TOGETHER]
            ids = self._ids(" " + " ".join(some))
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(some):
                keys += some
                found.append(ids)
                sizes.append(np.diff(starts, append=len(ids)))
            else:
                alone += some
        texts = [part[0] if type(part) is tuple else " " + part for part in alone]
        ids = [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, ids), np.int64, len(ids)))
        return keys + alone, np.concatenate(found + ids), np.concatenate(sizes)

    def texts(self, texts: pa.Array, end: int) -> Iterator[bytes]:
        """The ids of each text and the end id."""
        texts, end = pc.fill_null(texts, ""), end.to_bytes(4, "little")
        whole = pc.match_substring_regex(texts, self.added).to_numpy(zero_copy_only=False) if self.added else np.zeros(len(texts), bool)
        cut = texts.filter(pa.array(~whole))
        # every space is a boundary, but for one before white space or the end
        simple = ~pc.match_substring_regex(cut, SOME_SPACE).to_numpy(zero_copy_only=False)
        keys, codes, counts = coded(cut, simple, _BOUNDARY.split, first=True)
        ids, sizes = self.parts.gathered(self.parts.places(keys)[codes]) if keys else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        octets = ids.astype("<u4", copy=False).tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])] * 4
        cuts = iter(zip(ends[:-1].tolist(), ends[1:].tolist()))
        for i, alone in enumerate(whole.tolist()):
            if alone:
                yield self._ids(texts[i].as_py()).tobytes() + end
            else:
                a, b = next(cuts)
                yield octets[a:b] + end


@cache
def load(tokenizer_file: str) -> Encoder:
    """The encoder, kept by the worker from task to task."""
    gc.disable()  # the parts kept hold no cycles
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel ones
    return Encoder(tokenizer_file)


def spread_sample(ids: bytes) -> bytes:
    """At most ``SAMPLE_IDS`` ids of a document, in stretches from all over it."""
    found = np.frombuffer(ids, "<u4")
    if len(found) <= SAMPLE_IDS:
        return ids
    starts = np.linspace(0, len(found) - SAMPLE_IDS // 8, 8).astype(np.int64)
    return b"".join(found[a : a + SAMPLE_IDS // 8].tobytes() for a in starts)


def train_dictionary(docs: DataFrame, tokenizer_file: str, end: int) -> bytes:
    """A dictionary trained on the ``SAMPLE_DOCS`` documents with the smallest hash of their id.

    Too little to train on gives a dictionary of the plain ids.
    """
    chosen = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load(tokenizer_file)
        for batch in batches:
            for part in slices(batch, 1):
                ids = [spread_sample(x) for x in encode.texts(part.column(1), end)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most SAMPLE_DOCS ids
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    samples = [r.ids for r in texts.mapInArrow(run, "doc_id long, ids binary").sort("doc_id").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return (b"".join(samples) + end.to_bytes(4, "little") * 2)[-DICTIONARY_BYTES:]


def encoded(batches: Iterator[pa.RecordBatch], encode: Encoder, end: int) -> Iterator[tuple[int | None, bytes]]:
    for batch in batches:
        for part in slices(batch, 1):
            yield from zip(part.column(0).to_pylist(), encode.texts(part.column(1), end), strict=True)


def write(docs: DataFrame, folder: str, tokenizer_file: str, end: int = 2, level: int = 3) -> DataFrame:
    """Write shards to ``folder``; returns their list: ``shard, path, docs, ids, base`` (ids of all shards before)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(docs, tokenizer_file, end)
    files, path = filesystem(folder)
    with files.open_output_stream(f"{path}/{hashlib.sha256(dictionary).hexdigest()}.dictionary") as out:
        out.write(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = filesystem(folder)
        encode, index, at = load(tokenizer_file), [], len(MAGIC) + 32
        packer = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(dictionary))
        shard = TaskContext.get().partitionId()
        name = f"{path}/{shard:06d}-{uuid.uuid4().hex}.ids"
        out = None
        for doc_id, ids in encoded(batches, encode, end):
            if out is None:
                out = files.open_output_stream(name)
                out.write(MAGIC + hashlib.sha256(dictionary).digest())
            frame = packer.compress(ids)
            out.write(frame)
            index.append((doc_id or 0, doc_id is None, at, len(ids) // 4))
            at += len(frame)
        if out is not None:
            table = np.array(index, INDEX)
            out.write(table.tobytes() + np.array([(at, len(table))], TAIL).tobytes() + MAGIC)
            out.close()
            row = {"shard": [shard], "path": [name], "docs": [len(table)], "ids": [int(table["n"].sum())]}
            yield pa.RecordBatch.from_pydict(row, pa.schema([("shard", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())]))

    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc(), F.col("text").asc_nulls_first()]
    rows = docs.repartitionByRange(*key[:2]).sortWithinPartitions(*key)
    listed = stored(rows.mapInArrow(run, "shard int, path string, docs long, ids long"), "shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    return listed.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


@dataclass
class Shard:
    """An open shard, from which documents are read one by one."""

    file: object
    index: np.ndarray
    unpacker: zstandard.ZstdDecompressor

    @classmethod
    def open(cls, files, path: str, dictionary: bytes | None = None) -> Shard:
        file = files.open_input_file(path)
        size = file.size()
        head = file.read_at(len(MAGIC) + 32, 0)
        tail = file.read_at(TAIL.itemsize + len(MAGIC), size - TAIL.itemsize - len(MAGIC))
        if head[: len(MAGIC)] != MAGIC or tail[TAIL.itemsize :] != MAGIC:
            raise ValueError(f"{path} is no token file, or is cut off")
        if dictionary is None:
            with files.open_input_stream(f"{path.rsplit('/', 1)[0]}/{head[len(MAGIC) :].hex()}.dictionary") as beside:
                dictionary = beside.read()
        if hashlib.sha256(dictionary).digest() != head[len(MAGIC) :]:
            raise ValueError(f"{path} was written with another dictionary")
        at, docs = (int(x) for x in np.frombuffer(tail[: TAIL.itemsize], TAIL)[0])
        index = np.frombuffer(file.read_at(docs * INDEX.itemsize, at), INDEX)
        return cls(file, index, zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)))

    def ids(self, i: int) -> bytes:
        """Document ``i`` alone, by its offset."""
        at = int(self.index["offset"][i])
        stop = int(self.index["offset"][i + 1]) if i + 1 < len(self.index) else self.file.size() - TAIL.itemsize - len(MAGIC) - self.index.nbytes
        ids = self.unpacker.decompress(self.file.read_at(stop - at, at))
        if len(ids) != 4 * int(self.index["n"][i]):
            raise ValueError(f"document {i} has {len(ids) // 4} ids, its index says {self.index['n'][i]}")
        return ids


def read(spark: SparkSession, shards: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the listed shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = filesystem(folder)
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard.open(files, path)
                index = shard.index
                n = index["n"].astype(np.int64)
                crcs = np.fromiter((zlib.crc32(shard.ids(i)) for i in range(len(index))), np.int64, len(index))
                ids = pa.array(index["doc_id"].astype(np.int64), mask=index["null"].astype(bool))
                yield pa.RecordBatch.from_arrays([ids, pa.array(base + np.cumsum(n) - n), pa.array(n), pa.array(crcs)], names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = one_task_each(shards.select("path", "base"), shards.count())
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(folder: str, path: str, doc_id: int) -> np.ndarray:
    """The ids of one document of a shard, found by its index alone."""
    shard = Shard.open(filesystem(folder)[0], path)
    found = np.flatnonzero((shard.index["doc_id"] == doc_id) & (shard.index["null"] == 0))
    if not len(found):
        raise KeyError(doc_id)
    return np.frombuffer(shard.ids(int(found[0])), "<u4")
