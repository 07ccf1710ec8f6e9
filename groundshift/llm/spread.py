"""Joins on keys of which a few may hold many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from groundshift.llm.scratch import fresh

#: A key with more than this share of the rows is hot, so at most 1 / HOT_SHARE keys are; its rows go to SPLIT parts.
HOT_SHARE, SPLIT = 1 / 256, 64


def hot_keys(rows: DataFrame, key: str) -> list[int]:
    """Keys (long) that hold over ``HOT_SHARE`` of all rows; the rows are counted with partial sums."""
    total = rows.count()
    counts = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > F.lit(total * HOT_SHARE))
    return [r[0] for r in counts.where(F.col(key).isNotNull()).select(key).collect()]


def spread_join(many: DataFrame, one: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """``many`` joined with ``one``, which has a row for each key; hot keys of ``many`` are split by the hash of ``by``.

    Only for inner and left joins. The row of a hot key is copied to all its parts.
    """
    hot = hot_keys(many, key)
    if not hot:
        return many.join(one, key, how)
    (salt,) = fresh(many.join(one, key), "salt")
    is_hot = F.col(key).isin(hot)
    many = many.withColumn(salt, F.when(is_hot, F.pmod(F.xxhash64(by, F.lit("salt")), F.lit(SPLIT))).otherwise(F.lit(0)))
    parts = F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(SPLIT - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    one = one.withColumn(salt, F.explode(parts))
    return many.join(one, [key, salt], how).drop(salt)
