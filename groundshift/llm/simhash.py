"""SimHash near-duplicates, compared bit-sliced.

Texts are cut into words (ASCII letters lowered), words into shingles, and
each fingerprint bit is 1 if it is set in over half of the shingle hashes.
Fingerprints within ``radius`` bits are linked, and linked documents form
components.

Candidates: the 64 bits are cut into ``radius + 2`` runs. Two fingerprints that
differ in at most ``radius`` bits agree in at least two whole runs, so each
fingerprint is sent to one bucket for every pair of runs. In a bucket the bits
are held as planes, one word for 64 fingerprints, and a fingerprint is compared
with all lanes of a block at once by carry-save counters.

Nulls: a null text has no words and fingerprint 0, like an empty one; a null id
is never a component's smallest. Rows that agree in all they have are kept each.
An empty table gives an empty result; columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from groundshift.llm.graph import components
from groundshift.llm.scratch import columns, fresh, stored

#: Shingle hashes held at once.
HASHES = 1 << 16
#: Rows that one task compares with each other; larger buckets are cut into parts, every two of which meet.
PART = 8192
#: Comparisons of a fingerprint with a block that are carried through the planes together.
LANES = 1 << 15
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bits of every octet, the highest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of one text as an unsigned 64-bit number."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    digest, ones = xxhash.xxh64_digest, np.zeros((8, 8), np.int64)
    for at in range(0, n, HASHES):
        hashes = b"".join([digest(joined[a:b], 42) for a, b in zip(starts[at : at + HASHES], ends[at : at + HASHES], strict=True)])
        octets = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
        for k in range(8):
            ones[k] += np.bincount(octets[:, k], minlength=256) @ BITS
    return int.from_bytes(np.packbits(ones * 2 > n, axis=1).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, text_key, fp`` of every row; ``text_key`` tells texts of one id apart, ``fp`` is signed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """Planes of blocks of 64: word ``[i, b]`` holds bit ``b`` of the 64 fingerprints of block ``i``."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 64, 8), axis=2, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")).view("<u8")[:, :, 0]


def within(planes: np.ndarray, fps: np.ndarray, blocks: np.ndarray, lanes: np.ndarray, radius: int) -> np.ndarray:
    """Of each fingerprint and the block beside it, the lanes at most ``radius`` bits away.

    ``lanes`` are those that count. Counters of a few bits, one plane each, start
    so that the carry out of the last says that a lane has passed the radius.
    A block is abandoned once all its lanes have.
    """
    n_planes = int(radius).bit_length()
    start = (1 << n_planes) - 1 - radius
    counters = [np.full(len(fps), FULL if start >> i & 1 else np.uint64(0)) for i in range(n_planes)]
    out, live, alive = np.zeros(len(fps), np.uint64), np.arange(len(fps)), lanes.copy()
    for bit in range(64):
        mask = np.uint64(0) - (fps[live] >> np.uint64(bit) & np.uint64(1))
        carry = planes[blocks[live], bit] ^ mask
        for i, held in enumerate(counters):
            counters[i], carry = held ^ carry, held & carry
        alive &= ~carry
        if bit % 4 == 3:
            keep = alive != 0
            if not keep.all():
                live, alive, counters = live[keep], alive[keep], [c[keep] for c in counters]
            if not len(live):
                return out
    out[live] = alive
    return out


def joined(fps: np.ndarray, groups: np.ndarray, sides: np.ndarray, radius: int) -> np.ndarray:
    """For every row the smallest row that it is linked to, directly or through others of its group.

    Rows are sorted by group, then side. A group with rows on side 1 compares
    those on side 0 with them; any other compares all its rows.
    """
    planes, n, label = bit_planes(fps), len(fps), np.arange(len(fps))
    first = np.concatenate([[0], np.flatnonzero(np.diff(groups)) + 1])
    sizes = np.diff(np.concatenate([first, [n]]))
    ends = np.repeat(first + sizes, sizes)
    others = np.repeat(np.add.reduceat(sides, first), sizes)
    begin = np.where(others > 0, ends - others, np.arange(n) + 1)
    rows = np.flatnonzero((sides == 0) & (begin < ends))
    reach = (ends[rows] - 1) // 64 - begin[rows] // 64 + 1
    upto, at = np.cumsum(reach), 0
    while at < len(rows):
        stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LANES, "right")))
        some = reach[at:stop]
        who = np.repeat(rows[at:stop], some)
        block = begin[who] // 64 + np.arange(len(who)) - np.repeat(np.cumsum(some) - some, some)
        low = np.maximum(begin[who] - block * 64, 0).astype(np.uint64)
        high = np.minimum(ends[who] - block * 64, 64)
        hits = within(planes, fps[who], block, (FULL << low) & (FULL >> (64 - high).astype(np.uint64)), radius)
        got = np.flatnonzero(hits)
        i, lane = np.nonzero(np.unpackbits(hits[got].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        left, right = who[got[i]], block[got[i]] * 64 + lane
        while len(left):
            a, b = label[left], label[right]
            new = a != b
            left, right = left[new], right[new]
            np.minimum.at(label, np.maximum(a, b)[new], np.minimum(a, b)[new])
            while not np.array_equal(up := label[label], label):
                label = up
        at = stop
    return label


def bucketed(distinct: DataFrame, radius: int) -> DataFrame:
    """``bucket, fp``: each fingerprint once for every two of ``radius + 2`` runs of bits."""
    runs = radius + 2
    edges = [64 * i // runs for i in range(runs + 1)]
    masks = [((1 << b) - (1 << a)) for a, b in zip(edges, edges[1:])]
    as_long = lambda x: x - (1 << 64) if x >> 63 else x
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(as_long(masks[a] | masks[b])))) for i, (a, b) in enumerate(combinations(range(runs), 2))]
    return distinct.select("fp", F.explode(F.array(*keys)).alias("bucket"))


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """``a, b``: enough links between distinct fingerprints to connect all that are within the radius."""
    return compared(bucketed(distinct, radius), radius)


def compared(rows: DataFrame, radius: int) -> DataFrame:
    """``a, b``: links between fingerprints that share a bucket and are within the radius; ``rows``: ``bucket, fp``.

    Of a bucket's links only a spanning forest is returned, so a dense bucket
    gives no more rows than it has members. Buckets of over ``PART`` members are
    cut into parts by hash; every two parts meet in a task of their own. Buckets
    with one member are dropped before the comparison.
    """
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    sizes = sizes.select("bucket", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    rows = rows.join(sizes, "bucket").withColumn("part", F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts")).cast("int"))
    met = F.expr(
        "transform(sequence(0, parts - 1), q -> named_struct('lo', least(part, q), 'hi', greatest(part, q), 'side', if(part <= q, 0, 1)))"
    )
    rows = rows.select("bucket", "fp", F.explode(met).alias("met")).select("bucket", "met.lo", "met.hi", "met.side", "fp")
    rows = rows.select(F.xxhash64("bucket", "lo", "hi").alias("meeting"), "side", "fp")
    rows = rows.repartition("meeting").sortWithinPartitions("meeting", "side", "fp")

    def meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """Whole meetings, many at a time."""
        held: list[np.ndarray] = []
        for batch in batches:
            now = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
            whole = np.flatnonzero(now[0] != now[0, -1])
            if not len(whole) and (not held or held[-1][0, -1] == now[0, 0]):
                held.append(now)
                continue
            stop = whole[-1] + 1 if len(whole) else 0
            yield tuple(np.concatenate([*held, now[:, :stop]], axis=1))
            held = [now[:, stop:]]
        if held:
            yield tuple(np.concatenate(held, axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, sides, fps in meetings(b for b in batches if b.num_rows):
            label = joined(fps.view(np.uint64), groups, sides, radius)
            more = label != np.arange(len(fps))
            yield pa.RecordBatch.from_arrays([pa.array(fps[more]), pa.array(fps[label[more]])], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def classes(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """``doc_id, text_key, fp, root, component_id`` of every row of ``docs``.

    Equal fingerprints are one node, so a group of copies counts once however
    large it is. ``root`` names the component, ``component_id`` is its smallest id.
    """
    rows = stored(fingerprints(docs, shingle), "simhash")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    found = components(links(nodes.select("fp"), radius))
    nodes = nodes.join(found, nodes.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(nodes.join(roots, "root").select("fp", "root", "component_id"), "fp")


def deduplicated(docs: DataFrame, radius: int = 3, shingle: int = 3) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id.

    Ties of id go to the smaller text hash, repeated rows to one of them.
    """
    return first_of_each(docs, classes(docs, radius, shingle))


def first_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of ``docs`` one row for every ``root`` of ``found(doc_id, text_key, root)``, chosen as above."""
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("kept"))
    first = first.select(F.col("kept.doc_id").alias("doc_id"), F.col("kept.text_key").alias("text_key"))
    (key,) = fresh(docs, "text_key")
    a, b = docs.withColumn(key, F.xxhash64("text")).alias("a"), first.alias("b")
    kept = a.join(b, (F.col(f"a.{key}") == F.col("b.text_key")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")), "left_semi")
    return kept.dropDuplicates(["doc_id", key]).select(*columns(docs))
