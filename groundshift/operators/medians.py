"""Exact medians of many small stacks and a few deep ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from groundshift.operators.small import join_small, settle

#: Rows that make a stack deep, and the share of rows (one in) that is looked at to find deep stacks.
DEEP, SHARE = 16_384, 512
#: Values in a bucket of the first count.
WIDTH = 256


def deep_stacks(rows: DataFrame, keys: list[str], deep: int = DEEP, share: int = SHARE) -> DataFrame:
    """Keys that seem to have ``deep`` rows or more.

    Only the plan depends on them, so an estimate from the key columns of a
    sample is enough: a stack of twice the size is hardly ever missed.
    """
    few = rows.select(*keys).sample(1 / share, seed=7) if share > 1 else rows.select(*keys)
    return few.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") * share >= deep).select(*keys)


def medians(rows: DataFrame, cols: list[str], keys: list[str], deep: int = DEEP, share: int = SHARE) -> DataFrame:
    """Median of every column per key over the values that are present, as double; NULL without any.

    Shallow stacks are shuffled once by key, as they are, and ranked there. Deep
    ones are never gathered: radix selection counts their values by bucket,
    merged before the shuffle, finds the buckets that hold the middle ranks, and
    counts the values of these buckets only. No state is larger than a row, so
    every aggregate is a hash aggregate in generated code.
    """
    rows = rows.select(*keys, *cols)
    many = settle(deep_stacks(rows, keys, deep, share))
    if many.isEmpty():
        return _ranked(rows, cols, keys)
    marked = rows.join(many.withColumn("_deep", F.lit(True)), keys, "left")
    shallow = _ranked(marked.where("_deep is null").drop("_deep"), cols, keys)
    return shallow.unionByName(_selected(marked.where("_deep").drop("_deep"), many, cols, keys))


def _stacked(rows: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """One row per key, column number and value."""
    whole = all(rows.schema[n].dataType.typeName() in ("byte", "short", "integer", "long") for n in cols)
    kind = "long" if whole else "double"
    return rows.select(*keys, F.inline(F.array(*[F.struct(F.lit(i).alias("_col"), F.col(n).cast(kind).alias("_v")) for i, n in enumerate(cols)])))


def _middle(cols: list[str], low: Column, high: Column) -> list[Column]:
    """Per column the mean of the values that ``low`` and ``high`` mark, which may be one row."""

    def value(i: int, mark: Column) -> Column:
        return F.max(F.when((F.col("_col") == i) & mark, F.col("_v"))).cast("double")

    return [(value(i, low) * 0.5 + value(i, high) * 0.5).alias(n) for i, n in enumerate(cols)]


def _ranked(rows: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    # all that follows is partitioned by the keys, so nothing is shuffled again; their hash, put first, makes sorting cheap
    dealt = rows.repartition(*keys).withColumn("_key", F.xxhash64(*keys))
    stacked = _stacked(dealt, cols, ["_key", *keys])
    stack = Window.partitionBy("_key", *keys, "_col")
    placed = stacked.withColumn("_rank", F.row_number().over(stack.orderBy(F.col("_v").asc_nulls_last())))
    placed = placed.withColumn("_n", F.count("_v").over(stack))
    low, high = F.col("_rank") == F.floor((F.col("_n") + 1) / 2), F.col("_rank") == F.floor(F.col("_n") / 2) + 1
    return placed.where(low | high).groupBy(*keys).agg(*_middle(cols, low, high))


def _selected(rows: DataFrame, many: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    stacked = _stacked(rows, cols, keys).where(F.col("_v").isNotNull()).withColumn("_bucket", F.floor(F.col("_v") / WIDTH))
    stack = [*keys, "_col"]

    def placed(counts: DataFrame, group: list[str], by: str) -> DataFrame:
        upto = F.sum("_n").over(Window.partitionBy(*group).orderBy(by))
        return counts.withColumn("_upto", upto).withColumn("_before", F.col("_upto") - F.col("_n"))

    def holds(rank: Column) -> Column:
        return (rank >= F.col("_before")) & (rank < F.col("_upto"))

    counts = placed(stacked.groupBy(*stack, "_bucket").agg(F.count("*").alias("_n")), stack, "_bucket")
    counts = counts.withColumn("_all", F.sum("_n").over(Window.partitionBy(*stack)))
    low, high = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    wanted = counts.where(holds(low) | holds(high)).select(
        *stack,
        "_bucket",
        F.when(holds(low), low - F.col("_before")).alias("_low"),
        F.when(holds(high), high - F.col("_before")).alias("_high"),
    )
    inside = join_small(stacked, wanted, [*stack, "_bucket"]).groupBy(*stack, "_bucket", "_low", "_high", "_v").agg(F.count("*").alias("_n"))
    inside = placed(inside, [*stack, "_bucket"], "_v")
    low, high = F.coalesce(holds(F.col("_low")), F.lit(False)), F.coalesce(holds(F.col("_high")), F.lit(False))
    found = inside.where(low | high).groupBy(*keys).agg(*_middle(cols, low, high))
    return many.join(found, keys, "left").select(*keys, *cols)
