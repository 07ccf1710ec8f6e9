"""Per-pixel band arithmetic, all as native column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from groundshift import config as c


def present(col: Column) -> Column:
    """NaN is a second way to say missing; keep only NULL."""
    return F.when(~F.isnan(col), col)


def select_bands(df: DataFrame, bands: str | list[str], keep: list[str] = ()) -> DataFrame:
    """Project ``keep`` plus the bands named by a regex or a list."""
    if isinstance(bands, str):
        bands = [n for n in df.columns if re.fullmatch(bands, n, re.IGNORECASE)]
    return df.select(*keep, *bands)


def scaled(dn: Column) -> Column:
    return dn * c.SCALE + F.lit(c.OFFSET)


def apply_scale_factors(df: DataFrame, bands: list[str]) -> DataFrame:
    """Digital numbers to reflectance, in place; other columns stay."""
    return df.withColumns({b: scaled(F.col(b)) for b in bands})


def is_clear(qa: Column) -> Column:
    """Neither the cloud nor the cloud-shadow bit is set."""
    return (qa.bitwiseAND(c.SHADOW_BIT) == 0) & (qa.bitwiseAND(c.CLOUD_BIT) == 0)


def mask_clouds(df: DataFrame, bands: list[str], qa: str = "qa_pixel") -> DataFrame:
    clear = is_clear(F.col(qa))
    return df.withColumns({b: F.when(clear, F.col(b)) for b in bands})


def harmonised(band: str, yr: Column, raw=F.col) -> Column:
    """The raw band that carries ``band`` in the sensor of epoch ``yr``."""
    expr = None
    for sensor in dict.fromkeys(c.SENSORS.values()):
        years = [y for y, s in c.SENSORS.items() if s == sensor]
        source = raw(c.BAND_MAP[sensor][band])
        expr = F.when(yr.isin(years), source) if expr is None else expr.when(yr.isin(years), source)
    return expr.otherwise(F.raise_error(F.concat(F.lit("unsupported year "), yr.cast("string"))))


def harmonise_bands(df: DataFrame, bands: list[str] = c.BANDS) -> DataFrame:
    """Replace the raw bands by red, green, blue, nir (or the subset asked for)."""
    raw = {r for m in c.BAND_MAP.values() for r in m.values()}
    keep = [n for n in df.columns if n not in raw]
    return df.select(*keep, *[harmonised(b, F.col("yr")).alias(b) for b in bands])


def normalized_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); missing if an input is negative or the sum is zero."""
    return F.when((a >= 0) & (b >= 0), F.try_divide(a - b, a + b))


def ndvi_safe(nir: Column, red: Column) -> Column:
    """Ratio clamped to [-1, 1], 0 where the sum vanishes; missing stays missing."""
    total = nir + red
    ratio = F.when(F.abs(total) > 1e-6, F.try_divide(nir - red, total)).otherwise(F.lit(0.0))
    return F.when(total.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(-1.0), ratio)))


def clamp(col: Column, lo: float, hi: float) -> Column:
    return F.when(col.isNotNull(), F.least(F.lit(hi), F.greatest(F.lit(lo), col)))


def clip_negatives(df: DataFrame, bands: list[str] = c.BANDS) -> DataFrame:
    return df.withColumns({b: F.when(F.col(b).isNotNull(), F.greatest(F.col(b), F.lit(0.0))) for b in bands})


def is_valid(bands: list[str] = c.BANDS) -> Column:
    """Every band is present and finite (NaN sorts above infinity, NULL gives no answer)."""
    finite = reduce(lambda a, b: a & b, [F.abs(b) < float("inf") for b in bands])
    return F.coalesce(finite, F.lit(False))


def with_valid(df: DataFrame, bands: list[str] = c.BANDS) -> DataFrame:
    return df.withColumn("valid", is_valid(bands))


def valid_only(df: DataFrame, bands: list[str] = c.BANDS) -> DataFrame:
    return df.where(is_valid(bands))


def mask_nodata(df: DataFrame, bands: list[str], nodata: float) -> DataFrame:
    return df.withColumns({b: F.nullif(F.col(b), F.lit(nodata)) for b in bands})


def stretch(df: DataFrame, bands: list[str], lo, hi) -> DataFrame:
    """Linear display stretch to [0, 1]; ``lo`` and ``hi`` are numbers or columns."""
    lo = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi = hi if isinstance(hi, Column) else F.lit(float(hi))
    return df.withColumns({b: clamp(F.try_divide(F.col(b) - lo, hi - lo), 0.0, 1.0) for b in bands})


def stack_bands(df: DataFrame, bands: list[str], out: str = "stack") -> DataFrame:
    return df.withColumn(out, F.array(*bands))
