"""Connected components of links held in tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from groundshift.llm.scratch import stored

#: As many links (16 octets each) are left to one task; more go in rounds.
BLOCK = 1_000_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every node of the links once, and the smallest node of its component."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(names))
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root != (up := root[root])).any():
            root = up
    return names, names[root]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of one batch at a time, reduced to links with the smallest node of each of its components."""
    for batch in batches:
        a, b = forest(*(c.to_numpy() for c in batch.columns))
        yield pa.RecordBatch.from_arrays([pa.array(a[a != b], pa.int64()), pa.array(b[a != b], pa.int64())], ["a", "b"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of all links of a task with its root."""
    held = [[c.to_numpy() for c in batch.columns] for batch in batches]
    if held:
        node, root = forest(*(np.concatenate(c) for c in zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(root, pa.int64())], ["node", "root"])


def _signature(links: DataFrame) -> tuple:
    """The number of distinct links and two sums of their hashes, in one pass."""
    sums = [F.sum(F.xxhash64("a", "b", F.lit(i)).cast("decimal(38,0)")) for i in (1, 2)]
    return tuple(links.agg(F.count("*"), *sums).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a long, b long)``; root is the component's smallest node.

    Rounds of two steps, in which every node first hands its larger neighbours
    and then its smaller ones to the smallest node it knows, until nothing
    changes: the number of rounds grows with the logarithm of the nodes. Links
    are reduced batch by batch before, so a dense component arrives as stars;
    if no more than ``BLOCK`` are left then, a single task does without rounds.
    Loops and repeated links do no harm; no links give no rows. The smallest
    neighbour is a partial aggregate, written before the join back, so that
    adaptive execution can split a hot node's partition.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    links = stored(links.mapInArrow(_stars, "a long, b long"), "links")
    if links.count() <= BLOCK:
        return stored(links.repartition(1).mapInArrow(_whole, "node long, root long"), "components")
    before = _signature(links)
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large-stars")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b")))
        links = stored(small.distinct(), "small-stars")
        after = _signature(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
