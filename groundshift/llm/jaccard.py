"""Jaccard join of word n-grams, filtered under several global token orders.

A text's set is its distinct word n-grams (ASCII letters lowered); a text of
fewer words is one n-gram, one without words has an empty set and is linked with
nothing. Two sets link when ``100 * |A & B| >= least * |A | B|``.

Filter: of two sets that link, each holds a token of the other among its first
``size - ceil(least% of size) + 1`` tokens, whatever global order the tokens are
in. So candidates must share such a prefix token under every one of ``ORDERS``
orders. All put tokens of a single text first, which nobody shares, then rarer
before more frequent ones, but they bin the frequencies differently and break
ties by hashes of their own.

1. Postings. Tokens go in blocks to buckets by hash, where texts are counted
   by token; tokens of two texts or more go back to their texts. What a text does
   not get back only it has, so the rest suffices for prefixes and intersections.
   Tokens of a ``HEAVY``-th of a bounded sample of texts are not counted, since one
   bucket would get them all: they come last in every order, which any consistent
   order may do, and go to their texts at once.
2. Gatherings. Every text is linked with the first of the texts that have one of
   its prefix tokens under the first order; in the components two texts that link
   stay together, and no pairs are written.
3. In a gathering every two texts not yet connected are filtered pair by pair, by
   size and by the prefixes under all orders, and what passes is verified exactly.
   A gathering too large for one task is cut into parts: each is compared whole
   and with a few hubs, and texts that are then still apart from its largest
   component, and these only, meet all others.

Equal texts are one node. Words, tokens and texts are told apart by 64-bit
hashes. Null texts count as empty; null ids are never a component's smallest;
repeated rows give repeated results, several texts of one id are linked by
themselves. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from groundshift.llm.graph import components
from groundshift.llm.memo import Memo
from groundshift.llm.scratch import stored
from groundshift.llm.spread import spread_join

#: Tokens sent to the buckets at once, and octets of text whose tokens share a bucket.
BLOCK, BUCKET_BYTES = 500_000, 12 << 20
#: Sampled texts, the share of them (one in) that makes a token heavy, and what counts as its frequency.
SAMPLE, HEAVY, HEAVY_COUNT = 4096, 64, 1 << 40
ORDERS = 3
#: Texts and tokens of a part, and texts of a gathering that all its parts meet.
PART, TOKENS, HUBS = 1024, 1 << 20, 8
_draw = np.random.default_rng(12)
PLACES = _draw.integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
MIXERS = _draw.integers(0, 1 << 63, ORDERS, np.uint64) * np.uint64(2) + np.uint64(1)


def tokens_of(text: str | None, shingle: int, hashes: dict[bytes, int]) -> np.ndarray:
    """The distinct n-gram hashes of a text in order; ``hashes`` gives a word's."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width, n = min(shingle, len(words)), max(1, len(words) - shingle + 1)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += each[k : k + n] * PLACES[k % len(PLACES)] ** np.uint64(1 + k // len(PLACES))
    return np.unique(out)


def word_hashes() -> Memo:
    return Memo(xxhash.xxh64_intdigest, 150_000)


def nodes_of(docs: DataFrame) -> DataFrame:
    """``doc_id, node, text``; equal texts are one node."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("node"), text.alias("text"))


def heavy_tokens(rows: DataFrame, shingle: int) -> np.ndarray:
    """Tokens of one in ``HEAVY`` of the ``SAMPLE`` nodes with the smallest hash; bounded by the tokens of the sample."""
    sample = rows.select("node").distinct().orderBy(F.xxhash64("node", F.lit("sample")), "node").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = word_hashes(), set()
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if node not in seen:
                    seen.add(node)
                    found = tokens_of(text.as_py(), shingle, hashes)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), node)), pa.array(found.view(np.int64))], ["node", "token"])

    found = rows.select("node", "text").join(F.broadcast(sample), "node").mapInArrow(run, "node long, token long")  # SAMPLE nodes
    counts = found.groupBy("token").agg(F.count_distinct("node").alias("n")).where(F.col("n") * HEAVY >= SAMPLE)
    return np.sort(np.array([r.token for r in counts.select("token").collect()], np.int64).view(np.uint64))


def contains(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


#: ``role`` 0: tokens to be counted; 1: sizes of nodes; 2: tokens with their frequencies, on the way back.
POSTING = "role int, bucket long, nodes binary, place binary, token binary, n binary"
POSTING_NAMES = [c.split()[0] for c in POSTING.split(", ")]


def packed(role: int, bucket: np.ndarray, node: np.ndarray, token: np.ndarray, n: np.ndarray | None = None) -> Iterator[tuple]:
    """Entries as one row for each bucket; nodes are listed once and named by their place."""
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order])) + 1
    for some in np.split(order, ends) if len(order) else []:
        nodes, place = np.unique(node[some], return_inverse=True)
        place = place.astype(np.uint16 if len(nodes) <= 1 << 16 else np.uint32)
        yield role, int(bucket[some[0]]), nodes.tobytes(), place.tobytes(), token[some].tobytes(), b"" if n is None else n[some].tobytes()


def posting_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], POSTING_NAMES)


def unpacked(table: pa.Table, role: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``node, token, n`` of all entries of one role."""
    nodes, tokens, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for kind, _, names, place, token, n in zip(*(c.to_pylist() for c in table.columns)):
        if kind == role:
            token = np.frombuffer(token, np.uint64)
            names = np.frombuffer(names, np.uint64)
            nodes.append(names[np.frombuffer(place, np.uint16 if len(names) <= 1 << 16 else np.uint32)])
            tokens.append(token)
            counts.append(np.frombuffer(n, np.int64))
    return np.concatenate(nodes), np.concatenate(tokens), np.concatenate(counts)


def postings(rows: DataFrame, buckets: int, heavy: np.ndarray, shingle: int) -> DataFrame:
    """All tokens and sizes of ``rows(node, text)``, sent to their buckets in blocks."""

    def sent(nodes: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        node = np.array(nodes, np.int64).view(np.uint64)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        token, owner = np.concatenate(found), np.repeat(node, sizes)
        much = contains(heavy, token)
        out = list(packed(1, bucket_of(node, buckets), node, sizes.view(np.uint64)))
        out += packed(0, bucket_of(token[~much], buckets), owner[~much], token[~much])
        out += packed(2, bucket_of(owner[much], buckets), owner[much], token[much], np.full(int(much.sum()), HEAVY_COUNT))
        return posting_batch(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, nodes, found, held, seen = word_hashes(), [], [], 0, set()
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if node in seen:
                    continue
                seen.add(node)
                nodes.append(node)
                found.append(tokens_of(text.as_py(), shingle, hashes))
                held += len(found[-1])
                if held >= BLOCK:
                    yield sent(nodes, found)
                    nodes, found, held, seen = [], [], 0, set()
        if nodes:
            yield sent(nodes, found)

    return rows.select("node", "text").mapInArrow(run, POSTING)


def counted(sent: DataFrame, buckets: int) -> DataFrame:
    """Tokens of two nodes or more with the number of their nodes, sent back to the buckets of the nodes."""

    def run(table: pa.Table) -> pa.Table:
        node, token, _ = unpacked(table, 0)
        order = np.lexsort((node, token))
        node, token = node[order], token[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])  # a node may come from several blocks
        node, token = node[new], token[new]
        first = np.ones(len(token), bool)
        first[1:] = token[1:] != token[:-1]
        n = np.diff(np.append(np.flatnonzero(first), len(token)))
        n = np.repeat(n, n)
        live = n > 1
        node, token, n = node[live], token[live], n[live].astype(np.int64)
        others = table.filter(pc.not_equal(table.column("role"), 0))
        return pa.concat_tables([others, pa.Table.from_batches([posting_batch(list(packed(2, bucket_of(node, buckets), node, token, n)))])])

    return sent.groupBy("bucket").applyInArrow(run, POSTING)


def least_shared(size: np.ndarray, least: int) -> np.ndarray:
    return -(-least * size // 100)


def ordered(token: np.ndarray, n: np.ndarray, order: int) -> np.ndarray:
    """The places of ``token`` in one global order: by frequency, in wider bins for the later orders, then by hash."""
    wide = np.log2(np.maximum(n, 1)).astype(np.int64)
    rank = (n, wide, wide // 3)[order % 3]
    mixed = token * MIXERS[order]
    return np.lexsort((token, mixed ^ mixed >> np.uint64(29), rank))


NODE = "node long, size long, tokens array<long>, " + ", ".join(f"prefix{k} array<long>" for k in range(ORDERS))


def prefixes(back: DataFrame, least: int) -> DataFrame:
    """Of every node its size and, unless it can have no partner, its shared tokens and its prefix under every order."""

    def run(table: pa.Table) -> pa.Table:
        names, sizes, _ = unpacked(table, 1)
        names, at = np.unique(names, return_index=True)
        sizes = sizes[at].view(np.int64)
        node, token, n = unpacked(table, 2)
        owner = np.searchsorted(names, node)
        order = np.lexsort((token, owner))
        owner, token, n = owner[order], token[order], n[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        owner, token, n = owner[new], token[new], n[new]
        shared = np.bincount(owner, minlength=len(names))
        # tokens of one node alone come first in the prefix
        room = sizes - least_shared(sizes, least) + 1 - (sizes - shared)
        ends = np.cumsum(shared)
        out = []
        for i, (name, size, free) in enumerate(zip(names.view(np.int64).tolist(), sizes.tolist(), room.tolist())):
            lists = [None] * (1 + ORDERS)
            if free > 0 and size:
                mine, count = token[ends[i] - shared[i] : ends[i]], n[ends[i] - shared[i] : ends[i]]
                lists = [mine.view(np.int64)] + [mine[ordered(mine, count, k)[:free]].view(np.int64) for k in range(ORDERS)]
            out.append((name, size, *lists))
        kinds = [pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * (1 + ORDERS)
        columns = zip(*out) if out else [[]] * len(kinds)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in NODE.split(", ")])

    return back.groupBy("bucket").applyInArrow(run, NODE)


def gatherings(live: DataFrame) -> DataFrame:
    """``node, root``: nodes that a chain of shared prefix tokens connects under the first order.

    The further orders would hardly cut them (of 1,999 nodes to 1,994), but they filter the pairs within.
    """
    shared = live.select("node", F.explode("prefix0").alias("token"))
    first = shared.groupBy("token").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b < last").drop("last")
    pairs = shared.join(stored(first, "first-nodes"), "token").select(F.col("node").alias("a"), "b")
    return components(pairs.where("a <> b").distinct())


def alike(sets: list[np.ndarray], firsts: list[list[np.ndarray]], sizes: np.ndarray, sides: np.ndarray, label: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Pairs of rows that connect all that link; rows of one label are connected before.

    ``firsts[k]`` holds the rows' prefixes under order ``k``; a pair is verified
    only if it shares a token in each. If there are rows on side 1, which come
    last, those on side 0 are compared with them only.
    """
    label = np.unique(label, return_inverse=True)[1]
    names = np.unique(np.concatenate(sets))
    place = lambda rows: [np.searchsorted(names, r) for r in rows]
    ids, heads, mark, out = place(sets), [place(f) for f in firsts], np.zeros(len(names), np.int64), []
    begin = int(np.argmax(sides)) if sides.any() else 0

    def common(i: int, others: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
        mark[rows[i]] = 1
        ends = np.cumsum([len(rows[j]) for j in others])
        hits = np.concatenate([[0], np.cumsum(mark[np.concatenate([rows[j] for j in others])])])
        mark[rows[i]] = 0
        return np.diff(hits[np.concatenate([[0], ends])])

    for i in range(begin or len(sets)):
        others = np.arange(begin or i + 1, len(sets))
        large, small = np.maximum(sizes[others], sizes[i]), np.minimum(sizes[others], sizes[i])
        others = others[(label[others] != label[i]) & (100 * small >= least * large)]
        for rows in heads:
            if len(others):
                others = others[common(i, others, rows) > 0]
        if not len(others):
            continue
        both = common(i, others, ids)
        near = others[100 * both >= least * (sizes[i] + sizes[others] - both)]
        met, at = np.unique(label[near], return_index=True)
        out.extend((i, int(j)) for j in near[at])
        label[np.isin(label, met)] = label[i]
    return out


def lists_of(column: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(whole, pa.ChunkedArray):
        return [x for chunk in whole.chunks for x in lists_of(chunk)]
    flat, at = whole.flatten().to_numpy(zero_copy_only=False), whole.offsets.to_numpy()
    return np.split(flat, (at - at[0])[1:-1]) if len(whole) else []


MET = ["meeting", "side", "node", "size", "cluster", "tokens", *(f"prefix{k}" for k in range(ORDERS))]


def verified(rows: DataFrame, least: int) -> DataFrame:
    """``a, b``: links between the nodes of each meeting that connect all which link; ``rows``: the columns ``MET``."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("node", "ascending")])
        side, node, size, cluster = (table.column(m).to_numpy() for m in MET[1:5])
        sets, *firsts = (lists_of(table.column(m)) for m in MET[5:])
        pairs = alike(sets, firsts, size, side, cluster, least)
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.table({"a": pa.array(node[list(a)], pa.int64()), "b": pa.array(node[list(b)], pa.int64())})

    return rows.select(*MET).groupBy("meeting").applyInArrow(run, "a long, b long")


def parts_of(nodes: Column, tokens: Column) -> Column:
    return F.greatest(F.ceil(nodes / PART), F.ceil(tokens / TOKENS), F.lit(1)).cast("int")


def dealt(parts: Column) -> Column:
    return F.pmod(F.xxhash64("node", F.lit("part")), parts).cast("int")


def linked(live: DataFrame, gathered: DataFrame, least: int) -> DataFrame:
    """``node, root`` for every node that links with another: the components of all links in the gatherings."""
    rows = live.join(gathered, "node").withColumn("cluster", F.col("node"))
    size = F.size("tokens").cast("long")
    sums = rows.groupBy("root").agg(F.count("*").alias("n"), F.sum(size).alias("held")).where("n > 1")
    sums = sums.select("root", parts_of(F.col("n"), F.col("held")).alias("parts"))
    # a gathering of several parts has 1,024 nodes or a million tokens: few rows that are joined back
    rows = stored(spread_join(rows, stored(sums, "gathering-sizes"), "root", "node").withColumn("part", dealt(F.col("parts"))), "gathered")
    large = rows.where("parts > 1")
    place = Window.partitionBy("root", "part").orderBy(F.xxhash64("node", F.lit("hub")), "node")
    hubs = large.select("root", "part", "node").withColumn("place", F.row_number().over(place)).where(F.col("place") <= HUBS)
    hubs = hubs.withColumn("place", F.row_number().over(Window.partitionBy("root").orderBy("place", F.xxhash64("node", F.lit("hub")), "node")))
    hubs = rows.join(hubs.where(F.col("place") <= HUBS).select("node"), "node", "left_semi")
    hubs = hubs.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("at <> part").withColumn("part", F.col("at")).drop("at")
    first = rows.unionByName(hubs).withColumn("meeting", F.xxhash64("root", "part")).withColumn("side", F.lit(0))
    # written first, so that a task holds one Python worker
    found = components(stored(verified(first, least), "jaccard-links"))
    if large.isEmpty():
        return found
    clusters = large.select("root", "node", size.alias("held")).join(found.withColumnRenamed("root", "cluster"), "node", "left")
    clusters = stored(clusters.withColumn("cluster", F.coalesce("cluster", "node")), "clusters")
    counts = clusters.groupBy("root", "cluster").agg(F.count("*").alias("n"), F.sum("held").alias("held"))
    sums = counts.groupBy("root").agg(F.max(F.struct("n", "held", "cluster")).alias("major"), F.sum("n").alias("n"), F.sum("held").alias("held"))
    sums = sums.where("n > major.n")
    apart = parts_of(F.col("n") - F.col("major.n"), F.col("held") - F.col("major.held"))
    sums = sums.select("root", F.col("major.cluster").alias("major"), parts_of(F.col("major.n"), F.col("major.held")).alias("most"), apart.alias("rest"))
    left = spread_join(clusters.drop("held"), stored(sums, "cluster-sizes"), "root", "node").withColumn("main", F.col("cluster") == F.col("major"))
    left = stored(left, "apart")
    if left.isEmpty():
        return found
    # a part of the rest meets every part of the largest component (numbered below 0) and of the rest
    mine = F.when(F.col("main"), -1 - dealt(F.col("most"))).otherwise(dealt(F.col("rest")))
    met = F.expr("if(main, sequence(0, rest - 1), sequence(-most, rest - 1))")
    left = left.withColumn("part", mine).withColumn("with", F.explode(met))
    meeting = F.xxhash64("root", F.least("part", "with"), F.greatest("part", "with"))
    left = left.select("node", "cluster", meeting.alias("meeting"), (F.col("part") > F.col("with")).cast("int").alias("side"))
    more = verified(left.join(rows.drop("cluster", "root", "part", "parts"), "node"), least)
    return components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).union(stored(more, "jaccard-links")))


def classes(docs: DataFrame, least: int = 80, shingle: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs(doc_id, text)``; ``least`` is in percent.

    ``component_id`` is the smallest id that links reach, the row's own included.
    """
    if not 1 <= least <= 100:
        raise ValueError("the least similarity is a percentage above 0")
    rows = nodes_of(docs)
    octets = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-octets // BUCKET_BYTES))
    sent = postings(rows, buckets, heavy_tokens(rows, shingle), shingle)
    nodes = stored(prefixes(counted(sent, buckets), least), "jaccard-nodes")
    live = nodes.where(F.col("tokens").isNotNull())
    found = linked(live, gatherings(live), least)
    ids = stored(rows.groupBy("node").agg(F.min("doc_id").alias("smallest")), "node-ids")
    found = ids.join(found, "node", "left").select("node", "smallest", F.coalesce("root", "node").alias("root"))
    roots = found.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = spread_join(found, roots, "root", "node").select("node", "component_id").join(nodes.select("node", "size"), "node")
    out = spread_join(rows.select("doc_id", "node"), stored(named, "node-classes"), "node", "doc_id")
    alone = F.col("size") == 0
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
