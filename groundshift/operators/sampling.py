"""Training points, cleaning, balancing and splitting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from groundshift import config as c
from groundshift.functions.radiometry import normalized_difference, present
from groundshift.operators.small import join_small, may_have, sized
from groundshift.sources.dims import lookup


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by name; the columns must agree and duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def tag(df: DataFrame, **consts) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})


def standardise_keys(df: DataFrame, city: str | None = None, year: int | None = None) -> DataFrame:
    """Overwrite city or year where a value is given and the column exists."""
    given = {"city": city, "yr": year}
    return tag(df, **{k: v for k, v in given.items() if v is not None and k in df.columns})


def cast_features(df: DataFrame, cols: list[str]) -> DataFrame:
    """To double; what is no number, NaN included, becomes NULL."""
    return df.withColumns({n: present(F.col(n).try_cast("double")) for n in cols})


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def keep_binary(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(F.col(label).isin(0.0, 1.0))


def dedup(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def clean_samples(
    df: DataFrame,
    city: str | None = None,
    year: int | None = None,
    features: list[str] = c.FEATURES,
    label: str = "label",
) -> DataFrame:
    """Raw text samples to complete, binary, distinct, typed rows."""
    required = [*features, label]
    return (
        df.transform(standardise_keys, city, year)
        .transform(drop_missing, required)
        .transform(cast_features, required)
        .transform(keep_binary, label)
        .transform(drop_missing, required)
        .transform(dedup)
    )


def with_row_key(df: DataFrame, out: str) -> DataFrame:
    """A key made of the row's own content, for tables of distinct rows without one."""
    return df.withColumn(out, F.md5(F.to_json(F.struct(*[F.col(n).cast("string") for n in sorted(df.columns)]))))


def normalise_samples(df: DataFrame, numeric: list[str]) -> DataFrame:
    """Tidy subclass text, bad numbers to NULL, rows without a year dropped."""
    out = df.withColumn("subclass", F.lower(F.trim("subclass")))
    out = cast_features(out, [*numeric, "yr"]).withColumn("yr", F.col("yr").try_cast("int"))
    return drop_missing(out, ["yr"])


def _hash_key(key: str, seed: Column) -> Column:
    return F.md5(F.concat_ws(":", seed.cast("string"), F.col(key).cast("string")))


def smallest_by_hash(df: DataFrame, groups: list[str], key: str, quota: Column, seed: Column) -> DataFrame:
    """The ``quota`` rows of each group with the smallest seeded hash of ``key``.

    ``quota`` and ``seed`` are expressions over the group columns; ``key`` is
    unique within a group. Rows are counted by the first four hex digits of the
    hash, which tells the bucket the quota ends in; only that bucket, about one
    row in 65,536, is ever ranked.
    """
    hashed = df.withColumn("_hash", _hash_key(key, seed)).withColumn("_bucket", F.substring("_hash", 1, 4))
    counts = hashed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*groups).orderBy("_bucket"))
    cuts = (
        counts.withColumn("_upto", upto)
        .withColumn("_quota", quota.cast("bigint"))
        .groupBy(*groups)
        .agg(
            F.min(F.when(F.col("_upto") >= F.col("_quota"), F.col("_bucket"))).alias("_cut"),
            F.max("_quota").alias("_quota"),
            F.max(F.when(F.col("_upto") < F.col("_quota"), F.col("_upto"))).alias("_before"),
        )
        .withColumn("_need", F.col("_quota") - F.coalesce("_before", F.lit(0)))
        .select(*groups, "_cut", "_need")
    )
    marked = join_small(hashed, cuts, groups)
    whole = marked.where(F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut"))).select(*df.columns)
    order = Window.partitionBy(*groups).orderBy("_hash", key)
    partial = (
        marked.where(F.col("_bucket") == F.col("_cut"))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= F.col("_need"))
        .select(*df.columns)
    )
    return whole.unionByName(partial)


def sample_n_per_class(cands: DataFrame, key: str = "point_id", quotas: dict = c.CLASS_QUOTAS) -> DataFrame:
    """Seeded random points per city, epoch and subclass, labelled.

    ``quotas`` maps a subclass to (label, points, seed); other subclasses are dropped.
    """
    sub = F.col("subclass")
    known = cands.where(sub.isin(*quotas))
    picked = smallest_by_hash(
        known,
        ["city", "yr", "subclass"],
        key,
        quota=lookup({k: q[1] for k, q in quotas.items()}, sub),
        seed=lookup({k: q[2] for k, q in quotas.items()}, sub),
    )
    return picked.withColumn("label", lookup({k: q[0] for k, q in quotas.items()}, sub))


def sample_points(px: DataFrame, points: DataFrame, bands: list[str] = c.BANDS) -> DataFrame:
    """Band values under each point; points on masked or absent pixels drop out.

    Few points are broadcast, so that the rasters stay where they are. Of a raster
    that meets many points only the pixels that may have one are shuffled.
    """
    points, few = sized(points)
    rasters = px if few else may_have(px, points, c.PIXEL)
    return rasters.join(F.broadcast(points) if few else points, c.PIXEL).dropna(subset=list(bands))


def balance_downsample(
    df: DataFrame, label: str = "label", seed: int = 42, key: str = "sample_id", exact: bool = True
) -> DataFrame:
    """Cut the larger of the two classes down to the smaller.

    Exact: equal counts, the same rows whatever the partitioning. Otherwise a
    Bernoulli sample of the larger class. If a class is absent the input is
    returned as it is.
    """
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).where(F.col(label).isin(0, 1)).collect()}
    if len(sizes) < 2:
        return df
    least = min(sizes.values())
    both = df.where(F.col(label).isin(0, 1))
    if not exact:
        return both.sampleBy(label, {k: least / n for k, n in sizes.items()}, seed)
    # a hash of its own: a split by the same hash would put every kept row on one side
    return smallest_by_hash(both, [label], key, quota=F.lit(least), seed=F.lit(f"balance-{seed}"))


def hash_split(df: DataFrame, key: str = "sample_id", seed: int = 42, train: float = 0.8) -> DataFrame:
    """Add ``part``: train or validation, decided by a seeded hash of the key.

    ``train`` is the share of training rows: 0 gives none, 1 all.
    """
    place = F.conv(F.substring(_hash_key(key, F.lit(seed)), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("part", F.when(place < int(train * (1 << 32)), "train").otherwise("validation"))


def random_split(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own split; the rows depend on the partitioning."""
    left, right = df.randomSplit([train, 1 - train], seed=seed)
    return left, right


def training_extent(points: DataFrame, buffer_m: float = 5000.0, keys: list[str] = c.RASTER) -> DataFrame:
    """Box around all points of a raster, widened by ``buffer_m`` metres."""
    box = points.groupBy(*keys).agg(
        F.min("lon").alias("x0"), F.min("lat").alias("y0"), F.max("lon").alias("x1"), F.max("lat").alias("y1")
    )
    dy = F.lit(buffer_m / c.METRES_PER_DEGREE)
    dx = dy / F.cos(F.radians((F.col("y0") + F.col("y1")) / 2))
    return box.select(
        *keys,
        (F.col("x0") - dx).alias("lon_min"),
        (F.col("y0") - dy).alias("lat_min"),
        (F.col("x1") + dx).alias("lon_max"),
        (F.col("y1") + dy).alias("lat_max"),
    )


def build_training_set(composite: DataFrame, cands: DataFrame, key: str = "point_id") -> DataFrame:
    """Composite with NDVI, random points per class, band values under them."""
    with_nd = composite.withColumn("ndvi", normalized_difference(F.col("nir"), F.col("red")))
    points = sample_n_per_class(cands, key)
    return sample_points(with_nd.select(*c.PIXEL, *c.FEATURES), points, c.FEATURES).select(
        key, *c.FEATURES, "label", "city", "yr", "subclass"
    )
