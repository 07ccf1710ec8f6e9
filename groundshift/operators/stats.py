"""Descriptive statistics of samples and predictions."""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from groundshift import config as c
from groundshift.functions.radiometry import present
from groundshift.operators.small import settle
from groundshift.sources.dims import lookup


#: Values of one histogram map.
MAP_VALUES = 100_000


def histogram(df: DataFrame, cols: list[str]) -> DataFrame:
    """Counts per value of several columns in one pass: ``property``, ``value``, ``n``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(x).alias("property"), F.col(x).cast("string").alias("value")) for x in cols]))
    return df.select(pairs.alias("p")).groupBy("p.property", "p.value").agg(F.count("*").alias("n"))


def histogram_map(df: DataFrame, col: str, most: int = MAP_VALUES) -> DataFrame:
    """Maps from value to count: one row, or one per range of hashes if there are over ``most`` distinct values.

    The distinct values are counted first. A range holds about ``most`` of them,
    so no map grows with the table; together the maps have every value once.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("string").alias("value")).agg(F.count("*").alias("n"))
    maps = F.map_from_entries(F.sort_array(F.collect_list(F.struct("value", "n")))).alias("histogram")
    parts = max(1, math.ceil(counts.count() / most))
    if parts == 1:
        return counts.agg(maps)
    return counts.groupBy(F.pmod(F.xxhash64("value"), F.lit(parts)).alias("part")).agg(maps).select("histogram")


def label_distribution(df: DataFrame, keys: list[str] = ("city", "yr", "label")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(*keys)


def feature_stats(df: DataFrame, features: list[str] = c.FEATURES, keys: list[str] = c.RASTER) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of every feature in one pass."""
    aggs = []
    for f in features:
        aggs += [
            F.avg(f).alias(f"{f}_mean"),
            F.stddev_samp(f).alias(f"{f}_std"),
            F.min(f).alias(f"{f}_min"),
            F.max(f).alias(f"{f}_max"),
        ]
    return df.groupBy(*keys).agg(*aggs)


def preview(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*keys).limit(n)


def subclasses(df: DataFrame) -> DataFrame:
    return df.select("subclass").where("subclass is not null").distinct().orderBy("subclass")


def ordered_subclasses(df: DataFrame, preferred: list[str] = c.SUBCLASS_ORDER) -> DataFrame:
    """Preferred subclasses first, the rest by name; ``position`` starts at 1."""
    rank = F.coalesce(lookup({s: i for i, s in enumerate(preferred)}, F.col("subclass")), F.lit(len(preferred)))
    order = Window.orderBy(rank, "subclass")  # over the distinct names only
    return subclasses(df).withColumn("position", F.row_number().over(order))


def subclass_slice(df: DataFrame, subclass: str, year: int | None = None) -> DataFrame:
    out = df.where(F.col("subclass") == subclass)
    return out if year is None else out.where(F.col("yr") == year)


def subclass_year_means(df: DataFrame, features: list[str] = c.FEATURES) -> DataFrame:
    """Mean spectrum per subclass and epoch; none where every mean is missing."""
    means = df.where("subclass is not null").groupBy("subclass", "yr").agg(*[F.avg(f).alias(f) for f in features])
    return means.where(F.coalesce(*features).isNotNull())


def spectral_fingerprint(df: DataFrame, features: list[str] = c.FEATURES, years: list[int] = c.YEARS) -> DataFrame:
    """Mean spectra on the full epoch axis; epochs without samples are NULL.

    A subclass with samples outside the epochs only is left out.
    """
    spectrum = F.struct(*features)
    means = subclass_year_means(df, features).where(F.col("yr").isin(years))
    known = means.groupBy("subclass").agg(
        F.map_from_entries(F.collect_list(F.struct("yr", spectrum))).alias("by_year")
    )
    axis = known.withColumn("yr", F.explode(F.array(*map(F.lit, years))))
    return axis.select("subclass", "yr", F.try_element_at("by_year", F.col("yr")).alias("s")).select("subclass", "yr", "s.*")


def correlation_matrix(df: DataFrame, features: list[str] = c.FEATURES, key: str = "subclass") -> DataFrame:
    """Pearson correlation of every feature pair, over rows that have both.

    Long form: ``key``, ``feature_a``, ``feature_b``, ``corr``; NULL where a
    feature does not vary.
    """

    def corr(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    pairs = [(a, a) for a in features] + list(combinations(features, 2))
    wide = df.where(F.col(key).isNotNull()).groupBy(key).agg(*[corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("feature_a"), F.lit(y).alias("feature_b"), F.col(f"{a}__{b}").alias("corr")))
    return wide.select(key, F.inline(F.array(*cells)))


#: Grid points whose kernels one aggregate row sums.
SLICE = 25


def grouped_kde(df: DataFrame, group: str, value: str, points: int = 100) -> DataFrame:
    """Gaussian kernel density of each group on an even grid over its range.

    Scott bandwidth ``n^(-1/5) * std``. Equal values are counted first and
    weigh as often. The grid points are sums of one aggregate, ``SLICE`` of them
    a row, so a distinct value makes a row for each slice only, a row per group,
    slice and task is shuffled, and the aggregate stays in generated code. A group
    with no spread has density 1 at its value.
    """
    vals = df.select(F.col(group), present(F.col(value).cast("double")).alias("v")).where(
        F.col(group).isNotNull() & F.col("v").isNotNull()
    )
    shape = settle(
        vals.groupBy(group).agg(
            F.count("*").alias("n"),
            F.min("v").alias("lo"),
            F.max("v").alias("hi"),
            F.avg("v").alias("mean"),
            (F.stddev_samp("v") * F.pow(F.count("*").cast("double"), F.lit(-0.2))).alias("h"),
        )
    )
    varies = F.col("lo") < F.col("hi")
    scaled = vals.groupBy(group, "v").agg(F.count("*").cast("double").alias("weight")).join(shape, group).select(
        group,
        "weight",
        F.when(varies, (F.col("v") - F.col("lo")) / F.col("h")).otherwise(0.0).alias("u"),
        F.when(varies, (F.col("hi") - F.col("lo")) / float(points - 1) / F.col("h")).otherwise(0.0).alias("step"),
    )
    slices = -(-points // SLICE)
    scaled = scaled.withColumn("slice", F.explode(F.array(*[F.lit(i) for i in range(slices)])))

    def kernel(k: int) -> Column:
        z = F.col("step") * (F.col("slice") * SLICE + k).cast("double") - F.col("u")
        return F.sum(F.col("weight") * F.exp(z * z * -0.5))

    wide = scaled.groupBy(group, "slice").agg(*[kernel(k).alias(f"k{k}") for k in range(SLICE)])
    sums = wide.select(group, "slice", F.posexplode(F.array(*[f"k{k}" for k in range(SLICE)])).alias("k_at", "k"))
    sums = sums.select(group, (F.col("slice") * SLICE + F.col("k_at")).alias("point"), "k").where(F.col("point") < points)
    norm = F.when(varies, F.col("n") * F.col("h") * math.sqrt(2 * math.pi)).otherwise(F.col("n"))
    x = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("point") / float(points - 1)
    return sums.join(shape, group).select(group, "point", x.alias("x"), (F.col("k") / norm).alias("density"), "n", "mean")


def confusion(preds: DataFrame) -> DataFrame:
    return preds.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def classification_metrics(preds: DataFrame) -> DataFrame:
    """Accuracy, and F1, precision and recall weighted by class size, from one
    confusion count. A class that is never predicted has precision 0."""
    n, none = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)
    actual = F.struct(F.col("label").alias("class"), n.alias("support"), none.alias("guessed"), hit.alias("tp"))
    guess = F.struct(F.col("prediction").alias("class"), none.alias("support"), n.alias("guessed"), none.alias("tp"))
    per = (
        confusion(preds)
        .select(F.inline(F.array(actual, guess)))
        .groupBy("class")
        .agg(*[F.sum(x).alias(x) for x in ("support", "guessed", "tp")])
        .withColumn("p", F.coalesce(F.try_divide(F.col("tp"), F.col("guessed")), F.lit(0.0)))
        .withColumn("r", F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0)))
        .withColumn("f", F.coalesce(F.try_divide(F.col("p") * F.col("r") * 2, F.col("p") + F.col("r")), F.lit(0.0)))
    )

    def weighted(col: str) -> Column:
        return F.try_divide(F.sum(F.col(col) * F.col("support")), F.sum("support"))

    return per.agg(
        F.sum("support").alias("n"),
        F.try_divide(F.sum("tp"), F.sum("support")).alias("accuracy"),
        weighted("f").alias("f1"),
        weighted("p").alias("weighted_precision"),
        weighted("r").alias("weighted_recall"),
    )


def pixel_cloud(df: DataFrame) -> DataFrame:
    """Points of the red / near-infrared scatter."""
    return df.where("subclass is not null").select("subclass", "red", "nir")


def pixel_cloud_bins(df: DataFrame, size: float = 0.02) -> DataFrame:
    """The same scatter as counts per square bin, bounded whatever the input."""
    cloud = pixel_cloud(df).dropna()
    return cloud.groupBy(
        "subclass", F.floor(F.col("red") / size).alias("red_bin"), F.floor(F.col("nir") / size).alias("nir_bin")
    ).agg(F.count("*").alias("n"))
