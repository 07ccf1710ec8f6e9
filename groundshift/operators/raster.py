"""Grid operators on pixel tables keyed by (city, yr, px_row, px_col)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from groundshift import config as c
from groundshift.functions.radiometry import is_valid, stretch
from groundshift.operators.quantiles import exact_percentiles
from groundshift.operators.small import join_small, settle

LINE_BLOCK = 65_536
BOX = ["lon_min", "lat_min", "lon_max", "lat_max"]


def flat_index(df: DataFrame, width) -> DataFrame:
    """Add ``idx``, the row-major position; ``width`` is a number or a column."""
    width = width if isinstance(width, Column) else F.lit(width)
    return df.withColumn("idx", F.col("px_row").cast("bigint") * width + F.col("px_col"))


def unflatten(df: DataFrame, width) -> DataFrame:
    """Row and column from ``idx``."""
    width = width if isinstance(width, Column) else F.lit(width)
    return df.withColumns(
        {"px_row": F.floor(F.col("idx") / width).cast("int"), "px_col": (F.col("idx") % width).cast("int")}
    )


def extent(px: DataFrame) -> DataFrame:
    """Height and width of each raster, as far as it has rows."""
    return px.groupBy(*c.RASTER).agg((F.max("px_row") + 1).alias("height"), (F.max("px_col") + 1).alias("width"))


def grid_sizes(regions: DataFrame, years: list[int] = c.YEARS, step: float = c.STEP_DEGREES) -> DataFrame:
    """Height and width of each city's export grid, for every epoch, observed or not.

    A box that is a whole number of cells gets no line more for rounding.
    """

    def cells(low: str, high: str) -> Column:
        return F.ceil(F.round((F.col(high) - F.col(low)) / step, 6)).cast("int")

    epochs = F.explode(F.array(*map(F.lit, years))).alias("yr")
    return regions.select("city", epochs, cells("lat_min", "lat_max").alias("height"), cells("lon_min", "lon_max").alias("width"))


def all_cells(sizes: DataFrame) -> DataFrame:
    """One row per cell of every raster, made line by line."""
    lines = sizes.select(*c.RASTER, F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("px_row"), "width")
    return lines.select(*c.RASTER, "px_row", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("px_col"))


def chunk_id(px: DataFrame, size: int = 200_000) -> DataFrame:
    """Ordinal of each valid pixel in row-major order, and its batch.

    Pixels are ranked inside stretches of one raster line; the counts of the
    stretches before give the offset. No task sorts a whole raster.
    """
    valid = px.where(is_valid()).withColumn("_block", F.floor(F.col("px_col") / LINE_BLOCK))
    line = [*c.RASTER, "px_row", "_block"]
    sizes = valid.groupBy(*line).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*c.RASTER).orderBy("px_row", "_block"))
    offsets = sizes.select(*line, (upto - F.col("_n")).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy(*line).orderBy("px_col"))
    out = valid.join(offsets, line).withColumn("ordinal", F.col("_offset") + rank)
    return out.withColumn("chunk", F.ceil(F.col("ordinal") / size)).select(*px.columns, "ordinal", "chunk")


def valid_bbox(classified: DataFrame, nodata: int = c.NODATA) -> DataFrame:
    """Extent and box of the pixels with data; box columns are NULL without any."""
    hit = F.col("urban_class") != nodata
    row, col = F.when(hit, F.col("px_row")), F.when(hit, F.col("px_col"))
    return classified.groupBy(*c.RASTER).agg(
        F.min(row).alias("row_min"),
        F.max(row).alias("row_max"),
        F.min(col).alias("col_min"),
        F.max(col).alias("col_max"),
        (F.max("px_row") + 1).alias("height"),
        (F.max("px_col") + 1).alias("width"),
    )


def crop_boxes(classified: DataFrame, pad: int = 10, nodata: int = c.NODATA) -> DataFrame:
    """Rows ``r0`` to ``r1`` and columns ``c0`` to ``c1`` (ends excluded) that a crop
    keeps: the box of the data plus a margin, inside the raster. A raster without
    data keeps its full extent."""
    return valid_bbox(classified, nodata).select(
        *c.RASTER,
        F.coalesce(F.greatest(F.col("row_min") - pad, F.lit(0)), F.lit(0)).alias("r0"),
        F.least(F.coalesce(F.col("row_max") + pad + 1, "height"), "height").alias("r1"),
        F.coalesce(F.greatest(F.col("col_min") - pad, F.lit(0)), F.lit(0)).alias("c0"),
        F.least(F.coalesce(F.col("col_max") + pad + 1, "width"), "width").alias("c1"),
    )


def _cropped(boxed: DataFrame) -> DataFrame:
    inside = "px_row >= r0 and px_row < r1 and px_col >= c0 and px_col < c1"
    return boxed.where(inside).withColumns({"px_row": F.col("px_row") - F.col("r0"), "px_col": F.col("px_col") - F.col("c0")})


def crop_to_valid(classified: DataFrame, pad: int = 10, nodata: int = c.NODATA) -> DataFrame:
    """Cut each raster to its data plus a margin, and move the origin there."""
    boxed = join_small(classified, crop_boxes(classified, pad, nodata), c.RASTER)
    return _cropped(boxed).select(*classified.columns)


def _targets(at: Column, source: Column, target: Column) -> Column:
    """The target positions whose nearest source is ``at``: all i with
    floor((i + 0.5) * source / target) = at, in whole numbers."""

    def first(k: Column) -> Column:
        return F.greatest(F.ceil((2 * target * k - source) / (2 * source)), F.lit(0)).cast("int")

    at, source, target = (x.cast("bigint") for x in (at, source, target))
    start, stop = first(at), F.least(first(at + 1), target).cast("int")
    empty = F.array().cast("array<int>")
    return F.explode(F.when(start < stop, F.sequence(start, stop - 1)).otherwise(empty))


def _resampled(sized: DataFrame, height: Column, width: Column, to_width: int) -> DataFrame:
    to_height = F.floor(F.lit(float(to_width)) * (height / width)).cast("int")
    rows = sized.withColumn("_row", _targets(F.col("px_row"), height, to_height))
    cells = rows.withColumn("_col", _targets(F.col("px_col"), width, F.lit(to_width)))
    return cells.withColumns({"px_row": F.col("_row"), "px_col": F.col("_col")}).drop("_row", "_col")


def resample_nearest(px: DataFrame, width: int) -> DataFrame:
    """Nearest-neighbour resample to ``width`` columns and ``int(width * height / width0)`` rows.

    Every source pixel emits the target cells it is nearest to, so nothing is
    joined or shuffled but the raster sizes.
    """
    sized = join_small(px, extent(px), c.RASTER)
    return _resampled(sized, F.col("height"), F.col("width"), width).select(*px.columns)


def class_to_rgba(df: DataFrame, palette: dict = c.MAP_PALETTE, nodata: int = c.NODATA) -> DataFrame:
    """Add ``r``, ``g``, ``b``, ``a`` for the class of each pixel."""
    cls = F.col("urban_class")
    return df.withColumns(
        {
            name: F.when(cls == nodata, palette["nodata"][i])
            .when(cls == 1, palette["urban"][i])
            .otherwise(palette["valid"][i])
            for i, name in enumerate("rgba")
        }
    )


def timelapse_frames(classified: DataFrame, width: int = 420, years: list[int] = c.YEARS) -> DataFrame:
    """Cropped, resampled and coloured frames; ``frame`` counts the epochs a city has.

    The boxes are found in one pass; everything else is one narrow pass more.
    """
    wanted = classified.where(F.col("yr").isin(years))
    order = Window.partitionBy("city").orderBy("yr")
    boxed = join_small(wanted, crop_boxes(wanted).withColumn("frame", F.row_number().over(order)), c.RASTER)
    height, wide = F.col("r1") - F.col("r0"), F.col("c1") - F.col("c0")
    pictures = _resampled(_cropped(boxed), height, wide, width).select(*classified.columns, "frame")
    return class_to_rgba(pictures)


def pixel_centres(px: DataFrame, regions: DataFrame, step: float = c.STEP_DEGREES) -> DataFrame:
    """Add ``lon`` and ``lat`` of the pixel centre; row 0 is the northern edge."""
    corner = regions.select("city", F.col("lon_min").alias("_x0"), F.col("lat_max").alias("_y1"))
    return join_small(px, corner, "city").withColumns(
        {
            "lon": F.col("_x0") + (F.col("px_col") + 0.5) * step,
            "lat": F.col("_y1") - (F.col("px_row") + 0.5) * step,
        }
    ).drop("_x0", "_y1")


def snap_to_grid(points: DataFrame, regions: DataFrame, scale_m: float = c.PIXEL_METRES) -> DataFrame:
    """Row and column of lon/lat points on the city's export grid."""
    step = scale_m / c.METRES_PER_DEGREE
    corner = regions.select("city", F.col("lon_min").alias("_x0"), F.col("lat_max").alias("_y1"))
    return join_small(points, corner, "city").withColumns(
        {
            "px_row": F.floor((F.col("_y1") - F.col("lat")) / step).cast("int"),
            "px_col": F.floor((F.col("lon") - F.col("_x0")) / step).cast("int"),
        }
    ).drop("_x0", "_y1")


def fill_grid(points: DataFrame, regions: DataFrame, scale_m: float = c.PIXEL_METRES) -> DataFrame:
    """Every cell of the city's export grid whose centre lies in a source pixel.

    ``points`` has the pixel's centre (``lon``, ``lat``) and size in degrees
    (``lon_size``, ``lat_size``). Western and northern edges belong to a pixel,
    the others to the next one, so a gapless scene fills each cell once. Cells
    outside the region are not made.
    """
    step = scale_m / c.METRES_PER_DEGREE
    sizes = grid_sizes(regions, [0], step).drop("yr").withColumnsRenamed({"height": "_h", "width": "_w"})
    corner = regions.select("city", F.col("lon_min").alias("_x0"), F.col("lat_max").alias("_y1")).join(sizes, "city")

    def cells(distance: Column, size: str, n: str) -> Column:
        """Positions whose centre is at least ``distance`` minus half the size from the edge, and less than plus half."""
        first = F.greatest(F.ceil((distance - F.col(size) / 2) / step - 0.5), F.lit(0)).cast("int")
        stop = F.least(F.ceil((distance + F.col(size) / 2) / step - 0.5), F.col(n)).cast("int")
        return F.explode(F.when(first < stop, F.sequence(first, stop - 1)).otherwise(F.array().cast("array<int>")))

    placed = join_small(points, corner, "city").withColumn("px_row", cells(F.col("_y1") - F.col("lat"), "lat_size", "_h"))
    placed = placed.withColumn("px_col", cells(F.col("lon") - F.col("_x0"), "lon_size", "_w"))
    return placed.drop("_x0", "_y1", "_h", "_w")


def clip_box(df: DataFrame, boxes: DataFrame) -> DataFrame:
    """Rows whose lon/lat lies in the box of their city."""
    edges = boxes.select("city", *[F.col(n).alias(f"_{n}") for n in ("lon_min", "lat_min", "lon_max", "lat_max")])
    inside = F.col("lon").between(F.col("_lon_min"), F.col("_lon_max")) & F.col("lat").between(
        F.col("_lat_min"), F.col("_lat_max")
    )
    return join_small(df, edges, "city").where(inside).select(*df.columns)


#: Boxes that are written into a plan as constants.
MAX_BOXES = 256


def _cell_range(low: float, high: float, at) -> tuple[int, int]:
    """First and last cell whose place ``at(cell)``, which grows with the cell, is between the bounds.

    ``at`` computes as the plan would, so borders fall as they would there.
    """
    first, stop = -(1 << 31), (1 << 31) - 1

    def least(bound, passed) -> int:
        a, b = first, stop
        while a < b:
            mid = (a + b) // 2
            a, b = (a, mid) if passed(at(mid), bound) else (mid + 1, b)
        return a

    return least(low, lambda x, y: x >= y), least(high, lambda x, y: x > y) - 1


def clip_pixels(px: DataFrame, boxes: DataFrame, regions: DataFrame, step: float = c.STEP_DEGREES) -> DataFrame:
    """Pixels whose centre lies in the box of their city, borders included; cities without a box drop out.

    The grid transform is turned around: each box becomes a range of rows and
    columns, and these constants reach the scan, where they choose folders (city)
    and row groups, so a box of a raster is read without the raster. More than
    ``MAX_BOXES`` boxes are joined as in ``clip_box``.
    """
    corner = regions.select("city", F.col("lon_min").alias("x0"), F.col("lat_max").alias("y1"))
    known = boxes.join(corner, "city").dropna().select("city", "x0", "y1", *BOX).limit(MAX_BOXES + 1).collect()
    if len(known) > MAX_BOXES:
        return clip_box(pixel_centres(px, regions, step), boxes).select(*px.columns)
    inside = F.lit(False)
    for b in known:
        c0, c1 = _cell_range(b.lon_min, b.lon_max, lambda k: b.x0 + (k + 0.5) * step)
        r0, r1 = _cell_range(-b.lat_max, -b.lat_min, lambda k: -(b.y1 - (k + 0.5) * step))
        inside = inside | (
            (F.col("city") == b.city) & (F.col("px_row") >= r0) & (F.col("px_row") <= r1) & (F.col("px_col") >= c0) & (F.col("px_col") <= c1)
        )
    return px.where(inside)


def percentile_bounds(px: DataFrame, bands: list[str], lo: float = 2, hi: float = 98) -> DataFrame:
    """Display bounds per raster: percentiles pooled over the bands."""
    pooled = px.select(*c.RASTER, F.explode(F.array(*bands)).alias("v"))
    q = exact_percentiles(pooled, c.RASTER, "v", [lo / 100, hi / 100])
    return q.groupBy(*c.RASTER).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))


def stretch_percentile(px: DataFrame, bands: list[str], lo: float = 2, hi: float = 98) -> DataFrame:
    """Stretch each raster between its own percentile bounds."""
    bounds = settle(percentile_bounds(px, bands, lo, hi))
    return stretch(px.join(bounds, c.RASTER, "left"), bands, F.col("lo"), F.col("hi")).select(*px.columns)


def overlay(px: DataFrame, classified: DataFrame | None = None, bands: list[str] = ("red", "green", "blue")) -> DataFrame:
    """Stretched picture with a translucent colour on urban pixels.

    Without ``classified`` the classes are taken from ``px`` itself, which saves
    the join of two full rasters.
    """
    bands = list(bands)
    if classified is None:
        picture = stretch_percentile(px.select(*c.PIXEL, *bands, "urban_class"), bands)
    else:
        picture = stretch_percentile(px.select(*c.PIXEL, *bands), bands).join(
            classified.select(*c.PIXEL, "urban_class"), c.PIXEL
        )
    urban = F.col("urban_class") == 1
    tint = {f"over_{n}": F.when(urban, F.lit(v)).otherwise(F.lit(0.0)) for n, v in zip("rgba", c.OVERLAY_URBAN)}
    return picture.withColumns(tint).drop("urban_class")
