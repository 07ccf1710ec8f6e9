"""Built-up area through time. All inputs here are one row per raster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from groundshift import config as c
from groundshift.functions.reporting import pct_display, percent_change, rounded
from groundshift.sources.dims import city_rank, grid_df


def dense_grid(area: DataFrame, cities: list[str] = c.CITIES, years: list[int] = c.YEARS) -> DataFrame:
    """Every city and epoch; NULL where there is no raster."""
    grid = grid_df(area.sparkSession, cities, years).select("city", "yr")
    return grid.join(area, c.RASTER, "left")


def missing_rasters(grid: DataFrame, rasters: DataFrame) -> DataFrame:
    return grid.join(rasters.select(*c.RASTER).distinct(), c.RASTER, "left_anti")


def available(grid: DataFrame, rasters: DataFrame) -> DataFrame:
    return grid.join(rasters.select(*c.RASTER).distinct(), c.RASTER, "left_semi")


def _exact(area: Column) -> Column:
    return area.cast("decimal(18,2)")


def growth(area: DataFrame) -> DataFrame:
    """Growth against the previous row of the grid, even if that one is missing.

    NULL for the baseline year, and where either area is missing or the earlier
    one is not positive.
    """
    order = Window.partitionBy("city").orderBy("yr")
    rows = area.select(
        "city",
        "yr",
        "urban_area_km2",
        F.lag("urban_area_km2").over(order).alias("prev"),
        F.row_number().over(order).alias("rn"),
    )
    prev, now = F.col("prev"), F.col("urban_area_km2")
    usable = (prev > 0) & now.isNotNull()
    return rows.select(
        "city",
        "yr",
        "urban_area_km2",
        F.when(usable, (_exact(now) - _exact(prev)).cast("double")).alias("growth_km2"),
        F.when(usable, rounded(percent_change(prev, now), 1)).alias("growth_pct"),
        (F.col("rn") == 1).alias("is_baseline"),
    )


def growth_display(table: DataFrame) -> DataFrame:
    return table.withColumn("growth_pct_display", pct_display(F.col("growth_pct")))


def metric_at(metrics: DataFrame, city: str, year: int) -> DataFrame:
    return metrics.where((F.col("city") == city) & (F.col("yr") == year))


def active(metrics: DataFrame, cities: list[str]) -> DataFrame:
    return metrics.where(F.col("city").isin(cities))


def _area_in(year: int) -> Column:
    return F.max(F.when(F.col("yr") == year, F.col("urban_area_km2")))


def endpoints(metrics: DataFrame, start: int, end: int) -> DataFrame:
    """Area of each city in two epochs, side by side."""
    return metrics.groupBy("city").agg(_area_in(start).alias("area_start"), _area_in(end).alias("area_end"))


def growth_between(metrics: DataFrame, start: int, end: int, cities: list[str] = c.CITIES, zero_base=0.0) -> DataFrame:
    """Change between two epochs for the cities that have both areas."""
    pair = active(endpoints(metrics, start, end), cities).where("area_start is not null and area_end is not null")
    a, b = F.col("area_start"), F.col("area_end")
    return pair.withColumns({"growth_km2": b - a, "growth_pct": percent_change(a, b, zero_base)})


def compare_cities(metrics: DataFrame, city_a: str, city_b: str, year: int) -> DataFrame:
    """Areas of two cities in one epoch, signed and absolute difference; no row
    unless both are known."""

    def area_of(city: str) -> Column:
        return F.max(F.when(F.col("city") == city, F.col("urban_area_km2")))

    pair = metrics.where(F.col("yr") == year).groupBy("yr").agg(area_of(city_a).alias("area_a"), area_of(city_b).alias("area_b"))
    diff = F.col("area_a") - F.col("area_b")
    return pair.where("area_a is not null and area_b is not null").withColumns({"diff_km2": diff, "abs_diff_km2": F.abs(diff)})


def decade_growth(metrics: DataFrame, cities: list[str] = c.CITIES, periods=c.PERIODS) -> DataFrame:
    """Change of every city over every period; NULL if an endpoint is missing."""
    years = sorted({y for p in periods for y in p})
    wide = active(metrics, cities).groupBy("city").agg(*[_area_in(y).alias(f"a{y}") for y in years])
    spans = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(s).alias("year_start"),
                    F.lit(e).alias("year_end"),
                    (F.col(f"a{e}") - F.col(f"a{s}")).alias("growth_km2"),
                )
                for s, e in periods
            ]
        )
    )
    return wide.select("city", spans)


def _winner(rows: DataFrame, partition: list[str], *order) -> DataFrame:
    """First row per partition; the order ends in a rank that has no ties."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def decade_leaders(metrics: DataFrame, cities: list[str] = c.CITIES, periods=c.PERIODS) -> DataFrame:
    """City with the largest change per period; the earlier listed wins a tie."""
    known = decade_growth(metrics, cities, periods).where("growth_km2 is not null")
    ranked = known.withColumn("_rank", city_rank(cities, F.col("city")))
    return _winner(ranked, ["year_start", "year_end"], F.desc("growth_km2"), "_rank").drop("_rank")


def decade_totals(metrics: DataFrame, cities: list[str] = c.CITIES, periods=c.PERIODS) -> DataFrame:
    """Change per period over all cities with both endpoints; 0 if there is none."""
    total = F.coalesce(F.sum(_exact(F.col("growth_km2"))).cast("double"), F.lit(0.0))
    return decade_growth(metrics, cities, periods).groupBy("year_start", "year_end").agg(total.alias("growth_km2"))


def most_active_decade(metrics: DataFrame, cities: list[str] = c.CITIES, periods=c.PERIODS) -> DataFrame:
    return _winner(decade_totals(metrics, cities, periods), [], F.desc("growth_km2"), "year_start")


def growth_leaders(metrics: DataFrame, start: int = 1990, end: int = 2020, cities: list[str] = c.CITIES) -> DataFrame:
    """Fastest (percent) and largest (km2) grower; the earlier listed wins a tie."""
    both = growth_between(metrics, start, end, cities).select(
        "city",
        (_exact(F.col("area_end")) - _exact(F.col("area_start"))).cast("double").alias("growth_km2"),
        rounded(F.col("growth_pct"), 1).alias("growth_pct"),
        city_rank(cities, F.col("city")).alias("_rank"),
    )
    kinds = F.explode(
        F.array(
            F.struct(F.lit("fastest").alias("kind"), F.col("growth_pct").alias("score")),
            F.struct(F.lit("largest").alias("kind"), F.col("growth_km2").alias("score")),
        )
    )
    rows = both.withColumn("k", kinds).select("k.kind", "k.score", "city", "growth_km2", "growth_pct", "_rank")
    return _winner(rows, ["kind"], F.desc("score"), "_rank").drop("score", "_rank")


def latest(metrics: DataFrame) -> DataFrame:
    """Last epoch of each city."""
    return _winner(metrics, ["city"], F.desc("yr"))
