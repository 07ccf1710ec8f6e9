"""From dated scenes and observations to cloud-free median composites."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from groundshift import config as c
from groundshift.functions.dates import window_dates
from groundshift.functions.radiometry import apply_scale_factors, harmonise_bands, mask_clouds
from groundshift.operators.medians import medians
from groundshift.operators.raster import clip_box, fill_grid, snap_to_grid
from groundshift.operators.small import join_small

BOX = ["lon_min", "lat_min", "lon_max", "lat_max"]


def filter_bounds(scenes: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Scenes whose footprint meets one box, borders included."""
    lon_min, lat_min, lon_max, lat_max = box
    return scenes.where(
        (F.col("lon_min") <= lon_max)
        & (F.col("lon_max") >= lon_min)
        & (F.col("lat_min") <= lat_max)
        & (F.col("lat_max") >= lat_min)
    )


def filter_date(df: DataFrame, start, end, date_col: str = "acq_date") -> DataFrame:
    """Half-open date range."""
    return df.where((F.col(date_col) >= F.lit(start)) & (F.col(date_col) < F.lit(end)))


#: Cells are 2^e degrees wide; a box uses the smallest that is no narrower than itself.
FINEST, COARSEST = -10, 9


def _level(x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    size = F.greatest(x1 - x0, y1 - y0, F.lit(2.0**FINEST))
    return F.least(F.ceil(F.log2(size)), F.lit(COARSEST)).cast("int")


def _parts(lo: str, hi: str) -> list[tuple[Column, Column]]:
    """The longitude spans of a box: two if it crosses the date line, else one and one that is missing."""
    a, b = F.col(lo), F.col(hi)
    return [(a, F.when(a <= b, b).otherwise(180.0)), (F.when(a > b, -180.0), F.when(a > b, b))]


def _split(df: DataFrame, lo: str, hi: str, name: str) -> DataFrame:
    """One row for every longitude span: ``name`` numbers it, ``<name>_lo`` and ``<name>_hi`` are its ends."""
    spans = F.array(*[F.struct(F.lit(i).alias(name), a.alias(f"{name}_lo"), b.alias(f"{name}_hi")) for i, (a, b) in enumerate(_parts(lo, hi))])
    return df.select("*", F.inline(spans)).where(f"{name}_lo is not null")


def _cells(df: DataFrame, x: tuple[str, str], y: tuple[str, str], own: int, levels: list[int], strict: bool) -> DataFrame:
    """Cells of a box (``role, level, cx, cy``): its own, and those around it on coarser ``levels``.

    Own cells have the role ``own``; the others have the other role, and so have
    the own ones unless ``strict``. On every level a box lies in four cells at most.
    """
    level = _level(*(F.col(n) for n in (*x, *y)))
    above = F.array(*[F.lit(k) for k in levels]).cast("array<int>")
    above = F.filter(above, (lambda k: k > level) if strict else (lambda k: k >= level))
    rows = F.concat(F.array(F.struct(F.lit(own).alias("role"), level.alias("level"))), F.transform(above, lambda k: F.struct(F.lit(1 - own).alias("role"), k.alias("level"))))
    out = df.select("*", F.inline(rows))

    def span(lo: str, hi: str) -> Column:
        cell = F.pow(F.lit(2.0), F.col("level"))
        return F.explode(F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell)))

    return out.withColumn("cx", span(*x)).withColumn("cy", span(*y))


def scenes_by_region(scenes: DataFrame, regions: DataFrame) -> DataFrame:
    """One row per scene and region whose boxes meet; adds ``city``.

    A quadtree turns the box test into an equi-join: every box lies in at most
    four cells of its own size, and meets a larger one where its cells, made
    coarser, are the larger one's. A pair is kept only in the cell that holds the
    lower left corner of the overlap. A box whose ``lon_min`` is larger than its
    ``lon_max`` crosses the date line. Boxes with a missing edge meet nothing.
    """
    boxes = regions.select("city", *[F.col(b).alias(f"r_{b}") for b in BOX]).dropna(subset=[f"r_{b}" for b in BOX])
    right = _split(boxes, "r_lon_min", "r_lon_max", "_r")
    left = _split(scenes.dropna(subset=BOX), "lon_min", "lon_max", "_s")
    ends = (("_r_lo", "_r_hi"), ("r_lat_min", "r_lat_max"))
    levels = sorted(r[0] for r in right.select(_level(*(F.col(n) for pair in ends for n in pair))).distinct().collect())  # 20 at most
    # role 1: the scene's own cells, met by regions of its size or smaller; role 0: a larger region's own cells
    left = _cells(left, ("_s_lo", "_s_hi"), ("lat_min", "lat_max"), 1, levels, strict=True)
    right = _cells(right, *ends, 0, list(range(FINEST, COARSEST + 1)), strict=False)
    tall = (F.col("lat_min") <= F.col("r_lat_max")) & (F.col("lat_max") >= F.col("r_lat_min"))

    def wide(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
        return F.coalesce((a[0] <= b[1]) & (a[1] >= b[0]), F.lit(False))

    cell = F.pow(F.lit(2.0), F.col("level"))
    home = (F.col("cx") == F.floor(F.greatest("_s_lo", "_r_lo") / cell)) & (F.col("cy") == F.floor(F.greatest("lat_min", "r_lat_min") / cell))
    met, first = F.lit(False), F.lit(False)
    for i, a in enumerate(_parts("lon_min", "lon_max")):
        for j, b in enumerate(_parts("r_lon_min", "r_lon_max")):
            # boxes that meet in several spans are kept in the first of them
            first = first | ((F.col("_s") == i) & (F.col("_r") == j) & wide(a, b) & ~met)
            met = met | wide(a, b)
    return join_small(left, right, ["role", "level", "cx", "cy"]).where(tall & home & first).select(*scenes.columns, "city")


def assign_epoch(
    df: DataFrame, years: list[int] = c.YEARS, date_col: str = "acq_date", sensor_col: str | None = None
) -> DataFrame:
    """Add ``yr``: the epoch whose window holds the date; other rows are dropped.

    With ``sensor_col`` a row must also come from the epoch's own sensor. The
    windows are constants, so no join is needed and dates and sensors reach the
    scan. Overlapping windows give one row per epoch.
    """
    years = sorted(years)
    spans = {y: window_dates(y) for y in years}
    if sensor_col and not set(years) <= set(c.SENSORS):
        raise ValueError(f"unsupported year in {years}; use some of {sorted(c.SENSORS)}")
    day = F.col(date_col)

    def inside(y: int) -> Column:
        dated = (day >= F.lit(spans[y][0])) & (day < F.lit(spans[y][1]))
        return dated & (F.col(sensor_col) == c.SENSORS[y]) if sensor_col else dated

    hits = df.where(reduce(lambda a, b: a | b, [inside(y) for y in years]))
    if all(spans[a][1] <= spans[b][0] for a, b in zip(years, years[1:])):
        return hits.withColumn("yr", F.coalesce(*[F.when(inside(y), F.lit(y)) for y in years]))
    return hits.withColumn("yr", F.explode(F.array_compact(F.array(*[F.when(inside(y), F.lit(y)) for y in years]))))


def image_count(scenes: DataFrame, regions: DataFrame, years: list[int] = c.YEARS) -> DataFrame:
    """Scenes per city and epoch from the epoch's own sensor."""
    dated = assign_epoch(scenes, years, sensor_col="collection")
    return scenes_by_region(dated, regions).groupBy("city", "yr").agg(F.count("*").alias("n_scenes"))


def grid_observations(obs: DataFrame, scenes: DataFrame, regions: DataFrame) -> DataFrame:
    """Observations at lon/lat to pixels of every region their scene meets.

    ``obs`` has ``scene_id``, ``lon``, ``lat`` and the bands; date and sensor come
    from the scene. With ``lon_size`` and ``lat_size``, the extent of a source
    pixel in degrees, an observation fills every grid cell whose centre lies in
    it; without, only the cell it lies in. What is outside the region is left out.
    """
    meta = [n for n in ("acq_date", "collection") if n in scenes.columns and n not in obs.columns]
    pairs = scenes_by_region(scenes, regions).select("scene_id", "city", *meta)
    placed = join_small(obs, pairs, "scene_id")
    if {"lon_size", "lat_size"} <= set(obs.columns):
        return fill_grid(placed, regions).drop("lon", "lat", "lon_size", "lat_size")
    return snap_to_grid(placed.transform(clip_box, regions), regions).drop("lon", "lat")


def composite_jobs(grid: DataFrame, counts: DataFrame) -> DataFrame:
    """What to build for every city and epoch; empty ones are skipped."""
    n = F.coalesce("n_scenes", F.lit(0))
    return grid.join(counts, c.RASTER, "left").select(
        "city",
        "yr",
        n.cast("bigint").alias("n_scenes"),
        F.when(n > 0, "build").otherwise("skip").alias("action"),
        F.concat_ws("_", "city", F.col("yr").cast("string"), F.lit("composite")).alias("output_name"),
    )


def median_by_pixel(obs: DataFrame, bands: list[str] = c.BANDS, keys: list[str] = c.PIXEL) -> DataFrame:
    """Exact median per pixel and band over the observations that are present.

    A pixel without any gives NULL. A pixel seen very often is counted by value
    range, so no stack is gathered; see ``medians``.
    """
    return medians(obs, bands, keys)


def build_composites(obs: DataFrame, years: list[int] = c.YEARS, bands: list[str] = c.BANDS) -> DataFrame:
    """Epoch, cloud mask, band choice, median, scale: every city and epoch in one plan.

    The scale is affine and increasing, so the median runs on the integer
    numbers and only its result is scaled. Observations that name their
    ``collection`` count only in the epochs that sensor serves.
    """
    raw = [n for n in obs.columns if n.startswith("sr_b")]
    sensor = "collection" if "collection" in obs.columns else None
    dated = mask_clouds(assign_epoch(obs, years, sensor_col=sensor), raw)
    named = harmonise_bands(dated, bands).select(*c.PIXEL, *bands)
    return apply_scale_factors(median_by_pixel(named, bands), bands)
