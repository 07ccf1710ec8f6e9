"""The study end to end, from stored tables to stored tables.

Rasters are named by folder or, if the name has no slash, by catalog table. Tables
are bucketed by pixel, so jobs that join two of them do not shuffle either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from groundshift import config as c
from groundshift.operators import stats
from groundshift.operators.classify import class_counts, classify_rasters, coverage
from groundshift.operators.composite import build_composites, composite_jobs, grid_observations, image_count
from groundshift.operators.growth import active
from groundshift.operators.model import ERAS, load_model, save_model, score_by_era
from groundshift.operators.sampling import build_training_set, clean_samples, normalise_samples, with_row_key
from groundshift.operators.raster import grid_sizes, overlay as tinted
from groundshift.plans.growth_report import growth_report
from groundshift.plans.training import Trained, train_models
from groundshift.sources.dims import grid_df, regions_df
from groundshift.sources.raster import open_raster, save_raster
from groundshift.sources.tables import (
    METRICS_SCHEMA,
    SAMPLE_COLUMNS,
    SAMPLE_SCHEMA,
    read_metrics,
    read_samples_csv,
    read_samples_tolerant,
    write_csv,
)

MODEL_NAMES = {"legacy": "urban_rf_model_legacy", "2020": "urban_rf_model_2020"}


def composites(
    spark: SparkSession,
    obs: str,
    out: str,
    cities: list[str] = c.CITIES,
    years: list[int] = c.YEARS,
    scenes: str | None = None,
) -> DataFrame:
    """Median composites of all cities and epochs; returns their coverage.

    With ``scenes`` the observations are raw ones at lon/lat, and are put on the
    region grids first.
    """
    rows = spark.read.parquet(obs)
    if scenes:
        rows = grid_observations(rows, spark.read.parquet(scenes), active(regions_df(spark), cities))
    save_raster(build_composites(active(rows, cities), years), out)
    return coverage(open_raster(spark, out), sizes=grid_sizes(regions_df(spark), years))


def composite_status(
    spark: SparkSession, scenes: str, cities: list[str] = c.CITIES, years: list[int] = c.YEARS
) -> DataFrame:
    """Scenes found per city and epoch, and whether there is something to build."""
    regions = active(regions_df(spark), cities)
    counts = image_count(spark.read.parquet(scenes), regions, years)
    return composite_jobs(grid_df(spark, cities, years).select("city", "yr"), counts)


def training_set(spark: SparkSession, composite: str, candidates: str, out: str) -> DataFrame:
    """Sampled training rows as CSV; returns what was written."""
    rows = build_training_set(open_raster(spark, composite), spark.read.parquet(candidates))
    write_csv(rows.withColumnRenamed("yr", "year"), out, SAMPLE_COLUMNS)
    return read_samples_csv(spark, out, SAMPLE_SCHEMA)


def train(spark: SparkSession, samples, models: str, city: str | None = None) -> Trained:
    """Fit and store one forest per era from sample CSVs, of one city if named."""
    text = ", ".join(f"{n} string" for n in SAMPLE_COLUMNS)
    raw = read_samples_csv(spark, samples, text).withColumnRenamed("year", "yr")
    raw = raw.withColumn("yr", F.col("yr").try_cast("double").try_cast("int"))
    clean = clean_samples(raw if city is None else active(raw, [city]))
    done = train_models(with_row_key(clean, "sample_id"))
    for era in ERAS:
        save_model(done.models[era], f"{models}/{MODEL_NAMES[era]}")
    return done


def classify(spark: SparkSession, composite: str, models: str, out: str) -> DataFrame:
    """Class rasters, with the probability kept beside the class; returns the class counts."""
    loaded = {era: load_model(f"{models}/{MODEL_NAMES[era]}") for era in ERAS}
    scored = classify_rasters(open_raster(spark, composite), lambda px: score_by_era(px, loaded))
    save_raster(scored.select(*c.PIXEL, "urban_class", "urban_prob"), out)
    return class_counts(open_raster(spark, out), grid_sizes(regions_df(spark)))


def overlay(spark: SparkSession, composite: str, classified: str, out: str) -> DataFrame:
    """Stretched pictures with urban pixels tinted; returns what was written."""
    classes = open_raster(spark, classified).select(*c.PIXEL, "urban_class")
    save_raster(tinted(open_raster(spark, composite), classes), out)
    return open_raster(spark, out)


def metrics(spark: SparkSession, classified: str, out: str) -> DataFrame:
    """The growth table as one CSV file (a row per city and epoch); returns it as read back, keyed by ``yr``."""
    report = growth_report(open_raster(spark, classified)).withColumnRenamed("yr", "year")
    write_csv(report.coalesce(1), out, [part.split()[0] for part in METRICS_SCHEMA.split(", ")])
    return stored_metrics(spark, out)


def stored_metrics(spark: SparkSession, path: str) -> DataFrame:
    return read_metrics(spark, path).withColumnRenamed("year", "yr")


def stored_samples(spark: SparkSession, paths) -> DataFrame:
    """Sample files as the spectral tables expect them; unfit files are skipped."""
    return normalise_samples(read_samples_tolerant(spark, paths).withColumnRenamed("year", "yr"), c.FEATURES)


DESCRIPTIONS = {
    "subclasses": stats.ordered_subclasses,
    "means": stats.subclass_year_means,
    "fingerprint": stats.spectral_fingerprint,
    "correlation": stats.correlation_matrix,
    "density": lambda df: stats.grouped_kde(df, "subclass", "ndvi"),
    "cloud": stats.pixel_cloud_bins,
    "features": lambda df: stats.feature_stats(df, keys=["yr"]),
}
