"""Rounding and display rules of the growth report."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from groundshift import config as c


def pixels_to_km2(pixels: Column) -> Column:
    """Pixel count to km2 with 2 decimals, rounded on exact decimals."""
    area = pixels.cast("decimal(18,0)") * F.lit(c.PIXEL_KM2).cast("decimal(5,4)")
    return F.round(area, 2).cast("double")


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding that does not depend on how an engine rounds binary fractions."""
    return F.round(value.cast("decimal(24,6)"), digits).cast("double")


def percent_change(start: Column, end: Column, zero_base=None) -> Column:
    """Change from ``start`` to ``end`` in percent.

    ``zero_base`` is the answer for a base that is not positive; a missing
    endpoint always gives a missing result.
    """
    both = start.isNotNull() & end.isNotNull()
    change = F.try_divide(end - start, start) * 100
    return F.when(both & (start > 0), change).when(both, F.lit(zero_base).cast("double"))


def pct_display(pct: Column) -> Column:
    """One decimal and a percent sign; a dash when missing."""
    text = F.concat(pct.cast("decimal(18,1)").cast("string"), F.lit("%"))
    return F.coalesce(text, F.lit("—"))


def direction(pct: Column) -> Column:
    """Up only for real growth; NULL for a baseline."""
    return F.when(pct > 0, "▲").when(pct.isNotNull(), "▼")
