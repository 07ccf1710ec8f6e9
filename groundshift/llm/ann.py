"""Nearest neighbours by largest inner product: NN-descent graph and greedy search.

Graph. Every vector starts with the members of two random groups as neighbours.
In each round a vector is joined with its neighbours and the vectors it is a
neighbour of, all these meet, and every pair of them that is new to each other
is compared: neighbours of neighbours become neighbours, and the best ``degree``
are kept. Rounds end when few lists change.

Few vectors. If there are at most ``pool`` nodes, all of them are candidates of
every query, and neither graph nor search is needed.

Search. A query starts at its own node and at entry nodes, those of the largest
norms and some drawn at random, which all queries share, and every node has a few
random neighbours, so a tight group whose lists hold its own members only does
not hold the walk; in each round the unvisited ones
among its best ``width`` candidates are joined with the graph, and their
neighbours become candidates, until the best ``width`` are all visited.

Measure. Vectors are scaled by the largest norm and given one more component that
makes them unit vectors; inner products with a query keep their order, and the
graph's neighbours are near each other. Components are rounded to eight bits with
a scale per vector for the walk; the candidates that remain are scored exactly,
in double precision, on the original vectors.

Equal vectors are one node: however many they are, their ids are read out in
order at the end, no more than are asked for.

Null ids and vectors that are null, zero, hold a null or a non-finite component,
or are not as long as most take no part; of several vectors of one id the
smallest counts. Ties of score go to the smaller id. Fewer than ``k + 1``
vectors give all others; an empty table gives an empty result. Other columns
are ignored. The table is indexed whole; recall is measured in the tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from groundshift.llm.scratch import stored

#: Neighbours kept, reverse neighbours met (of each age), and finds that one meeting hands to a member.
DEGREE, REVERSE, FINDS = 24, 16, 8
#: Members of a random group at the start.
GROUP = 13
#: Descent ends when fewer than this share of the list entries are new, or after so many rounds.
STILL, DESCENTS = 0.05, 8
#: Best candidates of a query that are visited, candidates it keeps, and rounds at most.
WIDTH, POOL, ROUNDS = 224, 256, 24
#: Entry nodes of every walk, of the largest norms and drawn by hash, and random links of a node.
LARGEST, DRAWN, RANDOM = 8, 8, 3


def usable(table: DataFrame) -> DataFrame:
    """``vec_id, vec`` (array of double), one row per id."""
    vec = F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec")).where("vec_id is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(finite & F.exists("vec", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vec").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    rows = rows.where(F.size("vec") == (lengths["length"] if lengths else 0))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def encoded(nodes: DataFrame) -> DataFrame:
    """``node, code``: scale and added component as float32, then the components in eight bits."""
    longest = nodes.agg(F.sqrt(F.max(dot(F.col("vec"), F.col("vec")))).alias("norm")).first()["norm"] or 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack(batch.column(1).to_numpy(zero_copy_only=False)) / longest
                rest = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
                scale = np.maximum(np.abs(x).max(axis=1) / 127, 1e-30)
                head = np.stack([scale, rest], axis=1).astype("<f4").view(np.int8)
                codes = np.concatenate([head, np.rint(x / scale[:, None]).astype(np.int8)], axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary())], ["node", "code"])

    return nodes.select("node", "vec").mapInArrow(run, "node long, code binary")


def decode(codes: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors (float32) and their added components."""
    raw = np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1)
    head = np.ascontiguousarray(raw[:, :8]).view("<f4")
    return raw[:, 8:].astype(np.float32) * head[:, :1], head[:, 1]


def met(members: DataFrame) -> DataFrame:
    """``a, b, s`` of pairs in a meeting, one of them new, that beat what ``a`` knows.

    ``members``: ``meeting, node, code, least, new``; ``least`` is the worst neighbour a node has.
    """

    def one(nodes: np.ndarray, codes: list[bytes], least: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, ...] | None:
        nodes, first = np.unique(nodes, return_index=True)
        new, least = new[first], least[first]
        if len(nodes) < 2 or not new.any():
            return None
        x, rest = decode([codes[i] for i in first])
        s = x @ x.T + rest[:, None] * rest[None, :]
        s[~(new[:, None] | new[None, :])] = -np.inf
        np.fill_diagonal(s, -np.inf)
        s[s <= least[:, None]] = -np.inf
        few = min(FINDS, len(nodes) - 1)
        best = np.argpartition(-s, few - 1, axis=1)[:, :few]
        found = np.take_along_axis(s, best, axis=1)
        i, k = np.nonzero(found > -np.inf)
        return nodes[i], nodes[best[i, k]], found[i, k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def finds(table: pa.Table) -> pa.RecordBatch:
            meeting, nodes, least = (table.column(i).to_numpy() for i in (0, 1, 3))
            codes, new = table.column(2).to_pylist(), table.column(4).to_numpy().astype(bool)
            ends = [*(np.flatnonzero(np.diff(meeting)) + 1).tolist(), len(meeting)]
            starts = [0, *ends[:-1]]
            parts = [one(nodes[i:j], codes[i:j], least[i:j], new[i:j]) for i, j in zip(starts, ends, strict=True)]
            parts = [p for p in parts if p is not None]
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
            kinds = (pa.int64(), pa.int64(), pa.float32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "s"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            meeting = held.column(0).to_numpy()
            stop = int(np.searchsorted(meeting, meeting[-1])) if len(meeting) else 0
            if stop:
                yield finds(held.slice(0, stop))
                held = held.slice(stop)
        if held is not None and held.num_rows:
            yield finds(held)

    rows = members.select("meeting", "node", "code", F.col("least").cast("float").alias("least"), F.col("new").cast("int").alias("new"))
    return rows.repartition("meeting").sortWithinPartitions("meeting").mapInArrow(run, "a long, b long, s float")


def best_of(links: DataFrame, degree: int) -> DataFrame:
    """The best ``degree`` distinct links ``a, b, s, new`` of every node; a link known before is not new."""
    links = links.groupBy("a", "b").agg(F.max("s").alias("s"), F.min("new").alias("new"))
    order = Window.partitionBy("a").orderBy(F.desc("s"), "b")
    return links.withColumn("place", F.row_number().over(order)).where(F.col("place") <= degree).drop("place")


def neighbour_graph(codes: DataFrame, degree: int = DEGREE) -> DataFrame:
    """``a, b, s``: about the ``degree`` nearest nodes of every node."""
    n = codes.count()
    starts = []
    for side in range(2):
        group = F.pmod(F.xxhash64("node", F.lit(side)), F.lit(max(1, n // GROUP)))
        starts.append(codes.select(group.alias("meeting"), "node", "code", F.lit(-9.0).alias("least"), F.lit(True).alias("new")))
    links = starts[0].union(starts[1].withColumn("meeting", -1 - F.col("meeting")))
    links = stored(best_of(met(links).withColumn("new", F.lit(1)), degree), "graph")
    for turn in range(DESCENTS):
        # a meeting is held at every node, of its neighbours and of those that have it as one, a few of each age
        pick = Window.partitionBy("b", "new").orderBy(F.xxhash64("a", "b", F.lit(turn)))
        back = links.withColumn("place", F.row_number().over(pick)).where(F.col("place") <= REVERSE)
        member = links.select(F.col("a").alias("meeting"), F.col("b").alias("node"), "new")
        member = member.union(back.select(F.col("b").alias("meeting"), F.col("a").alias("node"), "new"))
        least = links.groupBy("a").agg(F.min("s").alias("least"), F.count("*").alias("n"))
        known = codes.join(least, codes.node == least.a, "left").select(
            "node", "code", F.when(F.col("n") >= degree, F.col("least")).otherwise(F.lit(-9.0)).alias("least")
        )
        fresh = links.where("new = 1").select("a").union(back.where("new = 1").select("b")).distinct()
        member = member.join(fresh.withColumnRenamed("a", "meeting"), "meeting", "left_semi")
        finds = met(member.join(known, "node")).withColumn("new", F.lit(1))
        links = stored(best_of(links.withColumn("new", F.lit(0)).unionByName(finds), degree), "graph")
        if links.where("new = 1").count() <= STILL * n * degree:
            break
    return links.select("a", "b", "s")


def with_codes(graph: DataFrame, codes: DataFrame, name: str) -> DataFrame:
    """A bucketed table with the neighbours of every node and their codes, so that searches join it without moving it.

    Nodes that have it as a neighbour without being its own are neighbours too, the
    best few of them, so that nodes in nobody's list are found. So are the node
    itself and about ``RANDOM`` nodes drawn by hash, which lead out of tight groups.
    """
    known = graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "s").join(graph.select("a", "b"), ["a", "b"], "left_anti")
    order = Window.partitionBy("a").orderBy(F.desc("s"), "b")
    back = known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= REVERSE).drop("place")
    n = codes.count()
    probes = F.explode(F.array(*(F.pmod(F.xxhash64("node", F.lit(i)), F.lit(n)) for i in range(RANDOM))))
    slots = codes.select(F.col("node").alias("b"), F.pmod(F.xxhash64("node", F.lit("slot")), F.lit(n)).alias("slot"))
    drawn = codes.select(F.col("node").alias("a"), probes.alias("slot")).join(slots, "slot").select("a", "b")
    itself = codes.select(F.col("node").alias("a"), F.col("node").alias("b"))
    graph = graph.unionByName(back).select("a", "b").union(drawn).union(itself).distinct()
    rows = graph.join(codes, graph.b == codes.node).groupBy("a").agg(F.collect_list(F.struct("b", "code")).alias("near"))
    rows = rows.select("a", F.col("near.b").alias("ids"), F.col("near.code").alias("codes"))
    n = int(graph.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(n, "a").sortBy("a").saveAsTable(name)
    return graph.sparkSession.table(name)


def entries(nodes: DataFrame) -> list[int]:
    """Where every walk starts besides its own node."""
    norm = dot(F.col("vec"), F.col("vec"))
    largest = nodes.select("node", norm.alias("norm")).orderBy(F.desc("norm"), "node").limit(LARGEST).select("node")
    drawn = nodes.select("node").orderBy(F.xxhash64("node", F.lit("entry")), "node").limit(DRAWN)
    return sorted({r.node for r in largest.union(drawn).collect()})


def each(ids: list[int]) -> Column:
    """A row for every one of a few ids."""
    return F.explode(F.array(*map(F.lit, ids)).cast("array<long>"))


def searched(spark: SparkSession, queries: DataFrame, graph: DataFrame, codes: DataFrame, starts: list[int], width: int, pool: int) -> DataFrame:
    """``query, node``: the best candidates of greedy search for each of ``queries(query)``, its own node among them.

    Every walk visits the nodes ``starts`` first, whatever they score.
    """
    name = f"graph_{uuid.uuid4().hex}"
    table = with_codes(graph, codes, name)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = ([], [], [])
            for query, code, least, ids, near in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, _ = decode([code, *near])  # a query has no added component
                s = x[1:] @ x[0]
                keep = np.flatnonzero(s > least)
                out[0].extend([query] * len(keep))
                out[1].extend([ids[i] for i in keep])
                out[2].append(s[keep])
            s = np.concatenate(out[2]) if out[2] else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(s, pa.float32())], ["query", "node", "s"]
            )

    order = Window.partitionBy("query").orderBy(F.desc("s"), "node")
    own = queries.select("query", F.col("query").alias("node"), F.lit(9.0).cast("float").alias("s"), F.lit(0).alias("seen"))
    first = queries.select("query", each(starts).alias("node")).join(codes.withColumnRenamed("node", "query"), "query")
    first = first.join(F.broadcast(table.where(F.col("a").isin(starts))), F.col("node") == F.col("a"))  # a few rows
    first = first.select("query", "code", F.lit(-9.0).alias("least"), "ids", "codes").mapInArrow(walk, "query long, node long, s float")
    found = own.unionByName(first.withColumn("seen", F.lit(0))).groupBy("query", "node").agg(F.max("s").alias("s"), F.max("seen").alias("seen"))
    found = stored(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pool), "search")
    for _ in range(ROUNDS):
        least = F.when(F.count("*").over(Window.partitionBy("query")) >= pool, F.min("s").over(Window.partitionBy("query"))).otherwise(-9.0)
        ahead = found.withColumn("least", least).where((F.col("seen") == 0) & (F.col("place") <= width))
        ahead = ahead.join(codes.withColumnRenamed("node", "query"), "query").select("query", "code", "least", "node")
        steps = ahead.join(table, ahead.node == table.a).select("query", "code", "least", "ids", "codes")
        steps = steps.mapInArrow(walk, "query long, node long, s float").withColumn("seen", F.lit(0))
        now = found.select("query", "node", "s", F.when(F.col("place") <= width, 1).otherwise(F.col("seen")).alias("seen"))
        now = now.unionByName(steps).groupBy("query", "node").agg(F.max("s").alias("s"), F.max("seen").alias("seen"))
        now = now.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pool)
        found = stored(now, "search")
        if found.where((F.col("seen") == 0) & (F.col("place") <= width)).isEmpty():
            break
    spark.sql(f"drop table {name}")
    return found.select("query", "node")


def nearest(table: DataFrame, asked: Column, k: int = 20, width: int = WIDTH, pool: int = POOL, degree: int = DEGREE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row for which ``asked`` (of ``vec_id``) holds."""
    spark = table.sparkSession
    rows = stored(usable(table), "vectors")
    nodes = rows.groupBy("vec").agg(F.min("vec_id").alias("node"))
    rows = stored(rows.join(nodes, "vec"), "vector-nodes")
    nodes = rows.where(F.col("vec_id") == F.col("node")).select("node", "vec")
    queries = rows.where(asked).select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"), F.col("vec").alias("query_vec"))
    asking, pool = queries.select("query").distinct(), max(pool, k + 1)
    few = [r.node for r in nodes.select("node").limit(pool + 1).collect()]
    if len(few) <= pool:
        found = asking.select("query", each(few).alias("node"))
    else:
        codes = stored(encoded(nodes), "codes")
        found = searched(spark, asking, neighbour_graph(codes, degree), codes, entries(nodes), width, pool)
    ids = Window.partitionBy("node").orderBy("vec_id")
    members = rows.select("node", "vec_id").withColumn("nth", F.row_number().over(ids)).where(F.col("nth") <= k + 1)
    scored = queries.select("query", "query_vec").dropDuplicates(["query"]).join(found, "query").join(nodes, "node")
    scored = scored.select("query", "node", dot(F.col("query_vec"), F.col("vec")).alias("score")).join(members, "node")
    pairs = queries.select("query_id", "query").join(scored, "query").where(F.col("query_id") != F.col("vec_id"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    pairs = pairs.select("query_id", F.row_number().over(best).alias("rank"), "vec_id", "score")
    return pairs.where(F.col("rank") <= k)
