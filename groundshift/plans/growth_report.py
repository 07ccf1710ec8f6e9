"""Class rasters to the growth table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from groundshift import config as c
from groundshift.operators.classify import classify, urban_area
from groundshift.operators.growth import dense_grid, growth, growth_display


def metrics_table(classified: DataFrame, cities: list[str] = c.CITIES, years: list[int] = c.YEARS) -> DataFrame:
    """Area and growth of every city and epoch; NULL where a raster is absent."""
    return growth(dense_grid(urban_area(classified), cities, years))


def growth_report(classified: DataFrame, cities: list[str] = c.CITIES, years: list[int] = c.YEARS) -> DataFrame:
    """The published table: area, growth and the displayed percentage."""
    return growth_display(metrics_table(classified, cities, years)).drop("is_baseline")


def report_from_scores(scored: DataFrame) -> DataFrame:
    """Scored pixels to the growth table."""
    return growth_report(classify(scored)).withColumn("yr", F.col("yr").cast("int"))
