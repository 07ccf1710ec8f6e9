"""Exact percentiles of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from groundshift.operators.small import join_small, settle

ACCURACY = 50_000


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """Linearly interpolated percentiles of ``value`` per group, missing values ignored.

    Result: ``keys``, ``prob``, ``value``. A sketch brackets the two neighbouring
    ranks; one more pass counts the values below the bracket and those inside,
    by value, and reads off the ranks. So a group is never gathered or sorted,
    whatever its size and values; infinite values count as the largest and
    smallest. Should a bracket miss, it is widened, to the whole range at last.
    Between two infinities of different sign there is no value (NULL).
    """
    vals = df.select(*keys, F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)")
    margin, found, todo = 8.0 / accuracy, None, None
    while True:
        targets = settle(_brackets(vals if todo is None else join_small(vals, todo.select(*keys).distinct(), keys), keys, probs, margin, accuracy))
        ranked = settle(_ranked(vals, targets, keys))
        good = ranked.where("hit").select(*keys, "prob", "part", "a", "b")
        if todo is not None:
            good = good.join(todo.select(*keys, "prob"), [*keys, "prob"], "left_semi")
        found = good if found is None else found.unionByName(good)
        missed = ranked.where("not hit")
        if todo is not None:
            missed = missed.join(todo.select(*keys, "prob"), [*keys, "prob"], "left_semi")
        if margin >= 1 or missed.isEmpty():
            return found.select(*keys, "prob", _between(F.col("a"), F.col("b"), F.col("part")).alias("value"))
        todo, margin = missed, margin * 64


def _between(a: Column, b: Column, part: Column) -> Column:
    apart = b - a
    mixed = F.when(F.abs(apart) < float("inf"), a + apart * part).otherwise(a * (1 - part) + b * part)
    return F.when((part == 0) | (a == b), a).otherwise(F.when(~F.isnan(mixed), mixed))


def _brackets(vals: DataFrame, keys: list[str], probs: list[float], margin: float, accuracy: int) -> DataFrame:
    """Per group and probability: the rank asked for, and values ``lo`` and ``hi`` around it."""
    edges = [(max(0.0, p - margin), min(1.0, p + margin)) for p in probs]
    sketch = F.percentile_approx("v", [e for pair in edges for e in pair], accuracy)
    groups = vals.groupBy(*keys).agg(F.count("*").alias("n"), sketch.alias("q"), F.min("v").alias("least"), F.max("v").alias("most"))
    rows = []
    for i, (p, (low, high)) in enumerate(zip(probs, edges)):
        at = F.lit(float(p)) * (F.col("n") - 1)
        lo = F.col("least") if low == 0 else F.col("q")[2 * i]
        hi = F.col("most") if high == 1 else F.col("q")[2 * i + 1]
        rows.append(F.struct(F.lit(float(p)).alias("prob"), F.floor(at).alias("rank"), (at - F.floor(at)).alias("part"), lo.alias("lo"), hi.alias("hi")))
    return groups.select(*keys, F.inline(F.array(*rows)))


def _ranked(vals: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """``a`` and ``b``, the values at the rank and after it; ``hit`` is false where the bracket misses them."""
    target = [*keys, "prob", "rank", "part"]
    side = F.when(F.col("v") < F.col("lo"), -1).when(F.col("v") > F.col("hi"), 1).otherwise(0)
    cells = (
        vals.join(targets, keys)
        .withColumn("side", side)
        .groupBy(*target, "side", F.when(F.col("side") == 0, F.col("v")).alias("at"))
        .agg(F.count("*").alias("n"), F.min("v").alias("v"))
    )
    upto = F.sum("n").over(Window.partitionBy(*target).orderBy("side", "at"))
    cells = cells.withColumn("last", upto - 1).withColumn("first", F.col("last") - F.col("n") + 1)

    def value(rank: Column) -> Column:
        """Known inside the bracket, and where it is the smallest value above."""
        inside = (F.col("side") == 0) & rank.between(F.col("first"), F.col("last"))
        return F.max(F.when(inside | ((F.col("side") == 1) & (rank == F.col("first"))), F.col("v")))

    out = cells.groupBy(*target).agg(value(F.col("rank")).alias("a"), value(F.col("rank") + 1).alias("b"))
    hit = F.col("a").isNotNull() & ((F.col("part") == 0) | F.col("b").isNotNull())
    return out.select(*keys, "prob", "part", "a", F.coalesce("b", "a").alias("b"), hit.alias("hit"))
