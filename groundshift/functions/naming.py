"""Raster names: ``{city}_{year}_composite.tif``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from groundshift import config as c


def _first_match(tests: list[tuple[Column, str]], name: Column, what: str) -> Column:
    expr = F
    for test, value in tests:
        expr = expr.when(test, F.lit(value))
    return expr.otherwise(F.raise_error(F.concat(F.lit(f"no {what} in name "), name)))


def parse_city_era(df: DataFrame, name: str = "name") -> DataFrame:
    """Add ``city`` and ``era``; an unknown city or year is an error."""
    low = F.lower(F.col(name))
    city = _first_match([(low.startswith(f"{k}_"), k) for k in c.CITIES], low, "city")
    legacy = low.contains("1990") | low.contains("2000") | low.contains("2010")
    era = _first_match([(low.contains("2020"), "2020"), (legacy, "legacy")], low, "era")
    return df.withColumns({"city": city, "era": era})


def route_model(df: DataFrame, name: str = "name") -> DataFrame:
    """Add the model that scores a raster and the name of its class raster."""
    return parse_city_era(df, name).withColumns(
        {
            "model": F.when(F.col("era") == "2020", "urban_rf_model_2020").otherwise("urban_rf_model_legacy"),
            "output_name": F.replace(F.col(name), F.lit("_composite.tif"), F.lit("_classification.tif")),
        }
    )


def era_of(yr: Column) -> Column:
    return F.when(yr == 2020, F.lit("2020")).otherwise(F.lit("legacy"))


def title_label(text: Column) -> Column:
    """``bare_soil`` to ``Bare Soil``."""
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))
