"""Preparing composites for scoring, and turning scores into classes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from groundshift import config as c
from groundshift.functions.radiometry import clamp, clip_negatives, is_valid, ndvi_safe, with_valid
from groundshift.functions.reporting import pixels_to_km2
from groundshift.operators.raster import all_cells, extent
from groundshift.operators.small import join_small
from groundshift.sources.dims import thresholds_df


def rescale_reflectance(px: DataFrame, bands: list[str] = c.BANDS, keep_empty: bool = True) -> DataFrame:
    """Bring each band of each raster to [0, 1] as its largest valid value suggests.

    Above 100: stored times 10000, so divide. Above 1: clamp. Otherwise, or
    without a valid pixel, unchanged; without ``keep_empty`` a raster that has
    no valid pixel is left out.
    """
    valid = is_valid(bands)
    tops = px.groupBy(*c.RASTER).agg(*[F.max(F.when(valid, F.col(b))).alias(f"_top_{b}") for b in bands])
    if not keep_empty:
        tops = tops.where(F.col(f"_top_{bands[0]}").isNotNull())
    joined = join_small(px, tops, c.RASTER, "left" if keep_empty else "inner")

    def fixed(b: str) -> Column:
        top, v = F.col(f"_top_{b}"), F.col(b)
        return F.when(top > 100, v / 10000.0).when(top > 1.0, clamp(v, 0.0, 1.0)).otherwise(v)

    return joined.withColumns({b: fixed(b) for b in bands}).select(*px.columns)


def prepare_features(px: DataFrame, keep_empty: bool = True) -> DataFrame:
    """Validity flag, rescale, floor at zero, NDVI."""
    ready = px.transform(with_valid).transform(rescale_reflectance, keep_empty=keep_empty).transform(clip_negatives)
    return ready.withColumn("ndvi", ndvi_safe(F.col("nir"), F.col("red")))


def with_threshold(px: DataFrame) -> DataFrame:
    """Add the city's threshold for the epoch (sixteen fixed rows); a raster without one stops the job."""
    named = px.join(F.broadcast(thresholds_df(px.sparkSession)), c.RASTER, "left")
    place = F.concat_ws(" ", F.lit("no threshold for"), F.col("city"), F.col("yr").cast("string"))
    return named.withColumn("threshold", F.coalesce("threshold", F.raise_error(place).cast("double")))


def urban_class(prob: Column, threshold: Column, valid: Column) -> Column:
    """1 urban, 0 not, 255 no data; compared in single precision."""
    hit = (prob.cast("float") >= threshold.cast("float")).cast("int")
    return F.when(~valid, F.lit(c.NODATA)).otherwise(hit)


def classify(px: DataFrame, prob: str = "urban_prob") -> DataFrame:
    valid = F.col("valid") if "valid" in px.columns else is_valid()
    return with_threshold(px).withColumn("urban_class", urban_class(F.col(prob), F.col("threshold"), valid))


def scatter_full(pred: DataFrame, px: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Classes of the scored pixels on every cell of the raster; the rest is no data."""
    cells = all_cells(extent(px) if sizes is None else sizes)
    full = cells.join(pred.select(*c.PIXEL, "urban_class"), c.PIXEL, "left")
    return full.withColumn("urban_class", F.coalesce("urban_class", F.lit(c.NODATA)))


def _on_grid(counts: DataFrame, sizes: DataFrame | None) -> DataFrame:
    """Turn ``height`` and ``width`` as seen into ``total``, the cells of the raster as given by ``sizes``."""
    if sizes is not None:
        counts = counts.drop("height", "width").join(sizes.select(*c.RASTER, "height", "width"), c.RASTER)
    return counts.withColumn("total", F.col("height").cast("bigint") * F.col("width")).drop("height", "width")


def coverage(px: DataFrame, bands: list[str] = c.BANDS, sizes: DataFrame | None = None) -> DataFrame:
    """Valid pixels of each raster and their share of all its cells, with a row or without.

    ``sizes`` (``city, yr, height, width``) tells the extent; otherwise it is as
    far as the raster has rows.
    """
    counts = px.groupBy(*c.RASTER).agg(
        F.count_if(is_valid(bands)).alias("n_valid"), (F.max("px_row") + 1).alias("height"), (F.max("px_col") + 1).alias("width")
    )
    total = F.col("total")
    return _on_grid(counts, sizes).select(
        *c.RASTER, "n_valid", total.alias("n_total"), F.try_divide(F.col("n_valid") * 100.0, total).alias("pct_valid")
    )


def nonempty_rasters(px: DataFrame, bands: list[str] = c.BANDS) -> DataFrame:
    """Rasters worth classifying: those with a valid pixel."""
    return coverage(px, bands).where(F.col("n_valid") > 0)


def _spread_of_valid(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Minimum, maximum, mean and population deviation per raster over valid pixels;
    no row for a raster without any."""
    aggs = [F.count_if("valid").alias("_n")]
    for name, out in names.items():
        v = F.when(F.col("valid"), F.col(name))
        aggs += [
            F.min(v).alias(f"{out}_min"),
            F.max(v).alias(f"{out}_max"),
            F.avg(v).alias(f"{out}_mean"),
            F.stddev_pop(v).alias(f"{out}_std"),
        ]
    return df.groupBy(*c.RASTER).agg(*aggs).where("_n > 0").drop("_n")


def band_stats(px: DataFrame, bands: list[str] = c.FEATURES) -> DataFrame:
    """Statistics of prepared bands per raster."""
    return _spread_of_valid(px, {b: b for b in bands})


def prob_stats(scored: DataFrame, prob: str = "urban_prob") -> DataFrame:
    return _spread_of_valid(scored, {prob: "prob"})


def class_counts(classified: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Pixels per class; class shares of the valid pixels, no-data share of all cells.

    Cells without a row are no data; ``sizes`` as in ``coverage``.
    """
    cls = F.col("urban_class")
    counts = classified.groupBy(*c.RASTER).agg(
        F.count_if(cls == 1).alias("urban_pixels"),
        F.count_if(cls == 0).alias("nonurban_pixels"),
        (F.max("px_row") + 1).alias("height"),
        (F.max("px_col") + 1).alias("width"),
    )
    valid = F.col("urban_pixels") + F.col("nonurban_pixels")
    counts = _on_grid(counts, sizes).withColumn("nodata_pixels", F.col("total") - valid)
    return counts.select(
        *c.RASTER,
        "urban_pixels",
        "nonurban_pixels",
        "nodata_pixels",
        F.col("total").alias("total_pixels"),
        F.try_divide(F.col("urban_pixels") * 100.0, valid).alias("urban_pct_valid"),
        F.try_divide(F.col("nonurban_pixels") * 100.0, valid).alias("nonurban_pct_valid"),
        F.try_divide(F.col("nodata_pixels") * 100.0, F.col("total")).alias("nodata_pct"),
    )


def urban_area(classified: DataFrame) -> DataFrame:
    """Urban pixels and their area per raster; no data never counts."""
    counts = classified.groupBy(*c.RASTER).agg(F.count_if(F.col("urban_class") == 1).alias("urban_pixels"))
    return counts.withColumn("urban_area_km2", pixels_to_km2(F.col("urban_pixels")))


def classify_rasters(px: DataFrame, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Prepare, score, threshold: all rasters at once, scored in place by key.

    ``scorer`` adds ``urban_prob``. Pixels that are not valid get 255 whatever
    the scorer says, so no join back to the full raster is needed. Rasters
    without a valid pixel are left out, so their area is missing, not 0.
    """
    return px.transform(prepare_features, keep_empty=False).transform(scorer).transform(classify)
