"""Fixed dimension tables as local relations."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from groundshift import config as c


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    names = [part.split()[0] for part in schema.split(",")]
    columns = [list(col) for col in zip(*rows)] if rows else [[] for _ in names]
    return spark.createDataFrame(pa.table(dict(zip(names, columns)))).selectExpr(
        *[f"cast({n} as {part.split()[1]}) as {n}" for n, part in zip(names, schema.split(","))]
    )


def regions_df(spark: SparkSession, regions: dict = c.REGIONS) -> DataFrame:
    return _table(
        spark,
        [(city, *box) for city, box in regions.items()],
        "city string, lon_min double, lat_min double, lon_max double, lat_max double",
    )


def epochs_df(spark: SparkSession, years: list[int] = c.YEARS) -> DataFrame:
    from groundshift.functions.dates import date_window

    start, end = date_window(F.col("yr"))
    return _table(spark, [(y, c.SENSORS[y]) for y in years], "yr int, sensor string").select(
        "yr", "sensor", start.alias("window_start"), end.alias("window_end")
    )


def thresholds_df(spark: SparkSession) -> DataFrame:
    return _table(
        spark,
        [(city, yr, t) for city, by_year in c.THRESHOLDS.items() for yr, t in by_year.items()],
        "city string, yr int, threshold double",
    )


def bandmap_df(spark: SparkSession) -> DataFrame:
    return _table(
        spark,
        [(s, *(m[b] for b in c.BANDS)) for s, m in c.BAND_MAP.items()],
        "sensor string, red string, green string, blue string, nir string",
    )


def grid_df(spark: SparkSession, cities: list[str] = c.CITIES, years: list[int] = c.YEARS) -> DataFrame:
    """City x year in report order; ``city_rank`` breaks ties in rankings."""
    return _table(
        spark,
        [(city, i, y) for i, city in enumerate(cities) for y in years],
        "city string, city_rank int, yr int",
    )


def lookup(mapping: dict, key: Column) -> Column:
    """Constant dictionary lookup; NULL for an unknown key."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def city_rank(cities: list[str], key: Column) -> Column:
    return lookup({city: i for i, city in enumerate(cities)}, key)
