"""The tables behind every chart and card, computed from the metrics table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from groundshift import config as c
from groundshift.functions.reporting import direction, percent_change, rounded
from groundshift.operators.growth import (
    active,
    decade_leaders,
    decade_totals,
    endpoints,
    growth_between,
    growth_display,
    growth_leaders,
    most_active_decade,
)
from groundshift.sources.dims import city_rank, grid_df, lookup

FIRST, LAST = c.YEARS[0], c.YEARS[-1]


def label_city(df: DataFrame, out: str = "label") -> DataFrame:
    return df.withColumn(out, lookup(c.CITY_LABELS, F.col("city")))


def growth_summary(metrics: DataFrame, cities: list[str] = c.CITIES) -> DataFrame:
    """First and last area and the change; cities without both are left out."""
    return growth_between(metrics, FIRST, LAST, cities).select(
        "city", F.col("area_start").alias("area_1990"), F.col("area_end").alias("area_2020"), "growth_km2", "growth_pct"
    )


def city_summary(metrics: DataFrame, cities: list[str] = c.CITIES) -> DataFrame:
    return label_city(growth_summary(metrics, cities)).withColumn("color", lookup(c.CITY_COLORS, F.col("city")))


def city_comparison(metrics: DataFrame, cities: list[str] = c.CITIES) -> DataFrame:
    """Rounded change per city under its display name."""
    rows = label_city(growth_summary(metrics, cities))
    return rows.select(
        F.col("label").alias("city"),
        rounded(F.col("growth_km2"), 2).alias("growth_km2"),
        rounded(F.col("growth_pct"), 1).alias("growth_pct"),
        lookup(c.CITY_COLORS, F.col("city")).alias("color"),
    )


def home_cards(metrics: DataFrame, cities: list[str] = c.CITIES) -> DataFrame:
    """One card per city; "unavailable" if an endpoint is missing."""
    start, end = F.col("area_start"), F.col("area_end")
    known = start.isNotNull() & end.isNotNull()
    return active(endpoints(metrics, FIRST, LAST), cities).select(
        "city",
        F.when(known, rounded(percent_change(start, end), 1)).alias("growth_pct"),
        F.when(known, end).alias("area_2020"),
        F.when(known, "available").otherwise("unavailable").alias("status"),
    )


def slopegraph(metrics: DataFrame, cities: list[str] = c.CITIES) -> DataFrame:
    """Endpoints per city and the common axis ceiling."""
    ends = growth_summary(metrics, cities).select("city", "area_1990", "area_2020")
    top = F.max(F.greatest("area_1990", "area_2020")).over(Window.partitionBy())
    return ends.withColumn("axis_max", F.when(top > 0, top * 1.12).otherwise(F.lit(1.0)))


def heatmap_active(metrics: DataFrame, cities: list[str] = c.CITIES, years: list[int] = c.YEARS) -> DataFrame:
    """Area per city (rows, in the given order) and epoch (columns).

    Two areas for one cell are an error.
    """
    one = F.when(
        F.count("urban_area_km2") > 1, F.raise_error(F.lit("more than one area for a city and year"))
    ).otherwise(F.max("urban_area_km2"))
    wide = active(metrics, cities).groupBy("city").pivot("yr", years).agg(one)
    axis = grid_df(metrics.sparkSession, cities, years[:1]).select("city", F.col("city_rank").alias("position"))
    return axis.join(wide, "city", "left").select("position", "city", *[F.col(str(y)).alias(f"y{y}") for y in years])


def grouped_bars(metrics: DataFrame, cities: list[str] = c.CITIES, years: list[int] = c.YEARS) -> DataFrame:
    """Bar height per epoch and city; 0 where nothing is known."""
    grid = grid_df(metrics.sparkSession, cities, years).select("city", "yr")
    return grid.join(metrics.select(*c.RASTER, "urban_area_km2"), c.RASTER, "left").select(
        "yr", "city", F.coalesce("urban_area_km2", F.lit(0.0)).alias("urban_area_km2")
    )


def area_series(metrics: DataFrame, highlighted: list[str] | None = None) -> DataFrame:
    """Line series with a highlight flag and the label of the last point."""
    shown = F.lit(True) if highlighted is None else F.col("city").isin(highlighted)
    is_last = F.col("yr") == F.max("yr").over(Window.partitionBy("city"))
    return metrics.select(
        "city",
        "yr",
        "urban_area_km2",
        shown.alias("highlighted"),
        F.when(shown & is_last, F.col("urban_area_km2")).alias("end_label"),
    )


def bubble_matrix(metrics: DataFrame, cities: list[str] = c.CITIES) -> DataFrame:
    """Bubble size by share of the largest area; rows run bottom up."""
    rows = label_city(active(metrics, cities), "city_label")
    top = F.max("urban_area_km2").over(Window.partitionBy())
    size = F.col("urban_area_km2") / F.when(top > 0, top).otherwise(F.lit(1.0)) * 2800 + 120
    return rows.select(
        "city",
        "city_label",
        "yr",
        (F.lit(len(cities) - 1) - city_rank(cities, F.col("city"))).alias("y"),
        "urban_area_km2",
        size.alias("bubble_size"),
    )


def metric_card(metrics: DataFrame) -> DataFrame:
    """Area, direction and size of the change for every map; rows without area drop out."""
    return metrics.where("urban_area_km2 is not null").select(
        "city",
        "yr",
        "urban_area_km2",
        direction(F.col("growth_pct")).alias("arrow"),
        F.abs("growth_pct").alias("abs_growth_pct"),
        F.col("growth_pct").isNull().alias("is_baseline"),
    )


def growth_table(metrics: DataFrame, cities: list[str] = c.CITIES) -> DataFrame:
    """The detail table under its display names."""
    rows = growth_display(active(metrics, cities))
    return rows.select(
        lookup(c.CITY_LABELS, F.col("city")).alias("City"),
        F.col("yr").alias("Year"),
        F.col("urban_area_km2").alias("Urban Area (Km²)"),
        F.col("growth_km2").alias("Growth (Km²)"),
        F.col("growth_pct_display").alias("Growth %"),
    )


def compare_years(metrics: DataFrame, start: int = FIRST, end: int = LAST, cities: list[str] = c.CITIES) -> DataFrame:
    """Two epochs of each city side by side."""
    return growth_between(metrics, start, end, cities).withColumns(
        {"year_a": F.lit(start), "year_b": F.lit(end)}
    )


REPORTS = {
    f.__name__: f
    for f in (
        growth_summary,
        city_summary,
        city_comparison,
        home_cards,
        slopegraph,
        heatmap_active,
        grouped_bars,
        area_series,
        bubble_matrix,
        metric_card,
        growth_table,
        compare_years,
        decade_leaders,
        decade_totals,
        most_active_decade,
        growth_leaders,
    )
}
