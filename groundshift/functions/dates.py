"""Observation windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F


def date_window(year) -> tuple[Column, Column]:
    """First day, and first day past the end, of the three-year window around ``year``.

    The end day itself, December 31 of the following year, is outside.
    """
    year = F.lit(year) if isinstance(year, int) else year
    one, dec, last = F.lit(1), F.lit(12), F.lit(31)
    return F.make_date(year - 1, one, one), F.make_date(year + 1, dec, last)


def window_dates(year: int) -> tuple[date, date]:
    """The same window as plain dates, for constant filters that reach the scan."""
    return date(year - 1, 1, 1), date(year + 1, 12, 31)
