"""Joins against tables that are expected, but not known, to be small."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

MAX_ROWS = 100_000
MAX_BYTES = 32 << 20
#: Assumed width of a value that is no string.
VALUE_BYTES = 8


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row holds."""

    def width(name: str, kind: str) -> Column:
        col = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(col), F.lit(0))
        return F.octet_length(F.to_json(F.struct(col))) if "<" in kind else F.lit(VALUE_BYTES)

    return reduce(lambda a, b: a + b, [width(n, k) for n, k in df.dtypes], F.lit(VALUE_BYTES))


def sized(df: DataFrame) -> tuple[DataFrame, bool]:
    """``df`` computed once and kept on the executors, and whether it is small.

    Rows and bytes are counted where they are, so nothing is collected to find
    out. What a lost executor kept is computed again.
    """
    kept = df.persist()
    size = kept.agg(F.count("*").alias("n"), F.sum(row_bytes(kept)).alias("b")).first()
    return kept, size["n"] <= MAX_ROWS and (size["b"] or 0) <= MAX_BYTES


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it on the executors; mark it for broadcast only if it is small.

    A larger table is kept as well and comes back without a hint: joins with
    it are left to adaptive execution, which splits skewed partitions.
    """
    kept, small = sized(df)
    return F.broadcast(kept) if small else kept


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    return big.join(settle(small), on, how)


#: Bits of a filter for each key, and in all: 2^26 bits are a million words of eight bytes.
KEY_BITS, MOST_BITS = 32, 1 << 26


def may_have(big: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of ``big`` whose key may be one of ``keys``: all that are, and about one in ``KEY_BITS`` of the others.

    A Bloom filter with one hash: the keys set bits of words that are broadcast,
    at most ``MOST_BITS`` in all, so the filter is bounded whatever the keys.
    Worth it before a shuffle of ``big``.
    """
    bits = min(MOST_BITS, max(64, 1 << (KEY_BITS * max(1, keys.count()) - 1).bit_length()))
    at = F.pmod(F.xxhash64(*on), F.lit(bits))
    word, bit = F.floor(at / 64), F.pmod(at, F.lit(64)).cast("int")
    words = keys.select(word.alias("_word"), bit.alias("_bit")).distinct().groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    marked = big.withColumn("_word", word).withColumn("_bit", bit).join(F.broadcast(words), "_word")
    return marked.where(F.expr("(shiftrightunsigned(_bits, _bit) & 1) = 1")).select(*big.columns)
