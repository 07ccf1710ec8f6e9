"""Grid operators: tiles, crops, resampling, display."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift import config as c
from groundshift.checks.fixtures import view
from groundshift.checks.radiometry import KEY, classified
from groundshift.checks.registry import query, r, rs, sql_rs
from groundshift.functions.radiometry import mask_nodata
from groundshift.operators import raster as ras
from groundshift.session import scratch_path
from groundshift.sources.dims import regions_df
from groundshift.sources.raster import pixels_to_tiles, read_raster, tiles_to_pixels, write_raster

STEP = f"({c.PIXEL_METRES}e0 / {c.METRES_PER_DEGREE}e0)"
FULL = """(select f.city, f.yr, f.h, f.w, f.px_row, f.px_col, red, green, blue, nir from {cells} f
  left join {px} p on p.city = f.city and p.yr = f.yr and p.px_row = f.px_row and p.px_col = f.px_col)"""


@query(f"select {KEY}, row_number() over (partition by city, yr order by px_row, px_col) as ordinal, "
       f"cast(ceil(row_number() over (partition by city, yr order by px_row, px_col) / 500.0e0) as bigint) as chunk from {{px}} "
       "where red is not null and green is not null and blue is not null and nir is not null")
def chunk_id(spark, sf):
    return ras.chunk_id(view(spark, sf, "px"), 500).select(*c.PIXEL, "ordinal", "chunk")


@query("select city, yr, px_row, px_col, cast(px_row as bigint) * 32 + px_col as idx from {px}")
def flat_index(spark, sf):
    flat = ras.flat_index(view(spark, sf, "px"), 32).drop("px_row", "px_col")
    return ras.unflatten(flat, 32).select(*c.PIXEL, "idx")


@query(f"""select city, yr, cast(px_row // 16 as int) as tile_row, cast(px_col // 16 as int) as tile_col,
  cast(max(least(16, h - 16 * (px_row // 16))) as int) as tile_h, cast(max(least(16, w - 16 * (px_col // 16))) as int) as tile_w,
  cast(count(*) as int) as n_cells, cast(sum(case when red is null then 1 else 0 end) as int) as n_nodata,
  round(sum(coalesce(red, 0)), 6) + 0.0 as red_sum, round(sum(coalesce(nir, 0)), 6) + 0.0 as nir_sum
  from {FULL} t group by all""")
def tile_pack(spark, sf):
    tiles = pixels_to_tiles(view(spark, sf, "px"), ["red", "nir"], tile=16, nodata=-9999.0)

    def total(b):
        return F.aggregate(b, F.lit(0.0), lambda acc, v: acc + F.when(v == -9999.0, 0.0).otherwise(v))

    return tiles.select(
        *c.RASTER, "tile_row", "tile_col", "tile_h", "tile_w",
        F.size("red").alias("n_cells"),
        F.size(F.filter("red", lambda v: v == -9999.0)).alias("n_nodata"),
        r(total("red"), 6).alias("red_sum"), r(total("nir"), 6).alias("nir_sum"),
    )


@query(f"select city, yr, cast(px_row as int) as px_row, cast(px_col as int) as px_col, red, green, blue, nir from {FULL} t")
def tile_unpack(spark, sf):
    tiles = pixels_to_tiles(view(spark, sf, "px"), c.BANDS, tile=16, nodata=-9999.0)
    return mask_nodata(tiles_to_pixels(tiles, c.BANDS, tile=16), c.BANDS, -9999.0)


@query(f"select {KEY}, urban_class from {{cls}}")
def raster_roundtrip(spark, sf):
    path = scratch_path(spark, "raster")
    write_raster(classified(spark, sf).select(*c.PIXEL, "urban_class"), path)
    return read_raster(spark, path)


_WINDOW = "(select city, yr, px_row, px_col, cast(case when px_row between 12 and 20 and px_col between 14 and 25 then urban_class else 255 end as int) as urban_class from {cls})"


def windowed(spark, sf):
    """Class rasters with data in the middle only, so that a crop has something to cut."""
    mid = F.col("px_row").between(12, 20) & F.col("px_col").between(14, 25)
    return classified(spark, sf).select(*c.PIXEL, F.when(mid, F.col("urban_class")).otherwise(c.NODATA).alias("urban_class"))


_BOX = f"""(select city, yr, min(case when urban_class <> 255 then px_row end) as row_min, max(case when urban_class <> 255 then px_row end) as row_max,
  min(case when urban_class <> 255 then px_col end) as col_min, max(case when urban_class <> 255 then px_col end) as col_max,
  max(px_row) + 1 as height, max(px_col) + 1 as width from {_WINDOW} w group by city, yr)"""
_CROP = f"""(select c.city, c.yr, cast(px_row - greatest(0, coalesce(row_min, 0) - 4) as int) as px_row,
  cast(px_col - greatest(0, coalesce(col_min, 0) - 4) as int) as px_col, urban_class
  from {_WINDOW} c join {_BOX} b on b.city = c.city and b.yr = c.yr
  where row_min is null or (px_row between row_min - 4 and row_max + 4 and px_col between col_min - 4 and col_max + 4))"""
_DIMS = f"(select city, yr, max(px_row) + 1 as h, max(px_col) + 1 as w from {_CROP} d group by city, yr)"


def _resampled(source: str, dims: str, width: int) -> str:
    return f"""(select g.city, g.yr, cast(g.i as int) as px_row, cast(g.j as int) as px_col, s.urban_class from (
    select city, yr, h, w, h2, i, unnest(range({width})) as j from (
      select city, yr, h, w, h2, unnest(range(h2)) as i from (
        select city, yr, h, w, cast(floor({width} * (h / w)) as int) as h2 from {dims} x) y) z) g
  join {source} s on s.city = g.city and s.yr = g.yr and s.px_row = ((2 * g.i + 1) * g.h) // (2 * g.h2) and s.px_col = ((2 * g.j + 1) * g.w) // (2 * {width}))"""


_RGBA = ", ".join(
    f"cast(case urban_class when 255 then {c.MAP_PALETTE['nodata'][i]} when 1 then {c.MAP_PALETTE['urban'][i]} else {c.MAP_PALETTE['valid'][i]} end as int) as {n}"
    for i, n in enumerate("rgba")
)


@query(f"select * from {_BOX} t")
def valid_bbox(spark, sf):
    return ras.valid_bbox(windowed(spark, sf))


@query(f"select * from {_CROP} t")
def crop_to_valid(spark, sf):
    return ras.crop_to_valid(windowed(spark, sf), pad=4)


@query(f"select * from {_resampled('{cls}', '{ext}', 20)} t")
def resample_nearest(spark, sf):
    return ras.resample_nearest(classified(spark, sf).select(*c.PIXEL, "urban_class"), 20)


@query(f"select * from {_resampled('{cls}', '{ext}', 75)} t")
def resample_enlarge(spark, sf):
    return ras.resample_nearest(classified(spark, sf).select(*c.PIXEL, "urban_class"), 75)


@query(f"select {KEY}, urban_class, {_RGBA} from {{cls}}")
def class_rgba(spark, sf):
    return ras.class_to_rgba(classified(spark, sf).select(*c.PIXEL, "urban_class"))


_FRAMES_CROP = _CROP.replace("- 4", "- 10").replace("+ 4", "+ 10")


@query(f"select *, {_RGBA}, cast((yr - 1980) / 10 as int) as frame from {_resampled(_FRAMES_CROP, _DIMS.replace(_CROP, _FRAMES_CROP), 48)} t")
def timelapse_frames(spark, sf):
    return ras.timelapse_frames(windowed(spark, sf), width=48, years=[1985, *c.YEARS])


_CENTRES = f"""(select p.city, p.yr, p.px_row, p.px_col, r.lon_min + (p.px_col + 0.5e0) * {STEP} as lon, r.lat_max - (p.px_row + 0.5e0) * {STEP} as lat,
  r.lon_min as x0, r.lat_max as y1 from {{px}} p join {{regions}} r on r.city = p.city)"""


def centres(spark, sf):
    return ras.pixel_centres(view(spark, sf, "px").select(*c.PIXEL), regions_df(spark))


@query(f"select {KEY}, {sql_rs(['lon', 'lat'])} from {_CENTRES} t")
def pixel_centres(spark, sf):
    return centres(spark, sf).withColumns({"lon": r("lon"), "lat": r("lat")})


@query(f"select {KEY} from {_CENTRES} t where lon between x0 + 0.001e0 and x0 + 0.006e0 and lat between y1 - 0.006e0 and y1 - 0.0003e0")
def clip_box(spark, sf):
    inner = regions_df(spark).select(
        "city",
        (F.col("lon_min") + 0.001).alias("lon_min"),
        (F.col("lat_max") - 0.006).alias("lat_min"),
        (F.col("lon_min") + 0.006).alias("lon_max"),
        (F.col("lat_max") - 0.0003).alias("lat_max"),
    )
    return ras.clip_pixels(view(spark, sf, "px").select(*c.PIXEL), inner, regions_df(spark))


@query(f"""select point_id, g.city, yr, cast(floor((r.lat_max - lat) / {STEP}) as int) as px_row, cast(floor((lon - r.lon_min) / {STEP}) as int) as px_col
  from {{geo}} g join {{regions}} r on r.city = g.city""")
def snap_to_grid(spark, sf):
    out = ras.snap_to_grid(view(spark, sf, "geo"), regions_df(spark))
    return out.select("point_id", "city", "yr", "px_row", "px_col")


_BOUNDS = """(select city, yr, quantile_cont(v, 0.02) as lo, quantile_cont(v, 0.98) as hi from (
  select city, yr, red as v from {px} union all select city, yr, green from {px} union all select city, yr, blue from {px}) u
  where v is not null group by city, yr)"""
_SHOWN = ", ".join(
    f"case when {b} is not null then round(least(1.0, greatest(0.0, ({b} - lo) / (hi - lo))), 9) + 0.0 end as {b}" for b in ["red", "green", "blue"]
)


@query(f"select city, yr, {sql_rs(['lo', 'hi'])} from {_BOUNDS} t")
def percentile_bounds(spark, sf):
    return ras.percentile_bounds(view(spark, sf, "px"), ["red", "green", "blue"]).select("city", "yr", *rs(["lo", "hi"]))


@query(f"select {KEY}, {_SHOWN} from (select p.*, lo, hi from {{px}} p join {_BOUNDS} b on b.city = p.city and b.yr = p.yr) t")
def stretch_percentile(spark, sf):
    bands = ["red", "green", "blue"]
    return ras.stretch_percentile(view(spark, sf, "px").select(*c.PIXEL, *bands), bands).select(*c.PIXEL, *rs(bands))


@query(f"""select {KEY}, {_SHOWN}, 0.0e0 as over_r, case when urban_class = 1 then 1.0e0 else 0.0e0 end as over_g,
  case when urban_class = 1 then 1.0e0 else 0.0e0 end as over_b, case when urban_class = 1 then 0.1e0 else 0.0e0 end as over_a
  from (select p.*, lo, hi, urban_class from {{px}} p join {_BOUNDS} b on b.city = p.city and b.yr = p.yr
    join {{cls}} k on k.city = p.city and k.yr = p.yr and k.px_row = p.px_row and k.px_col = p.px_col) t""")
def urban_overlay(spark, sf):
    out = ras.overlay(view(spark, sf, "px"), classified(spark, sf))
    return out.withColumns({b: r(b) for b in ["red", "green", "blue"]})
