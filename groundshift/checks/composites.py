"""Scenes, epochs and median composites."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift import config as c
from groundshift.checks.fixtures import view
from groundshift.checks.registry import query, rs
from groundshift.functions.radiometry import mask_clouds
from groundshift.operators import composite as comp
from groundshift.sources.dims import bandmap_df, epochs_df, grid_df, regions_df
from groundshift.sources.tables import scan_scenes, write_scenes
from groundshift.session import scratch_path

STEP = f"({c.PIXEL_METRES}e0 / {c.METRES_PER_DEGREE}e0)"
MEETS = "s.lon_min <= r.lon_max and s.lon_max >= r.lon_min and s.lat_min <= r.lat_max and s.lat_max >= r.lat_min"


@query("select scene_id, collection, e.yr from {scenes} s join {epochs} e on s.collection = e.sensor")
def scene_scan(spark, sf):
    path = scratch_path(spark, "scenes")
    write_scenes(view(spark, sf, "scenes"), path)
    parts = [scan_scenes(spark, path, y).select("scene_id", "collection", F.lit(y).alias("yr")) for y in c.YEARS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"select scene_id, r.city from {{scenes}} s join {{regions}} r on {MEETS}")
def scenes_in_region(spark, sf):
    return comp.scenes_by_region(view(spark, sf, "scenes"), regions_df(spark)).select("scene_id", "city")


_BANDS = ", ".join(c.RAW_BANDS)
_PLACED = f"""(select h.scene_id, r.city, s.acq_date, s.collection, cast(floor((r.lat_max - lat) / {STEP}) as int) as px_row,
  cast(floor((lon - r.lon_min) / {STEP}) as int) as px_col, {_BANDS}, qa_pixel
  from {{shots}} h join {{scenes}} s on s.scene_id = h.scene_id join {{regions}} r on {MEETS}
  where lon between r.lon_min and r.lon_max and lat between r.lat_min and r.lat_max)"""
_DAY = "strftime(acq_date, '%Y-%m-%d') as acq_date"


def _day(df):
    return df.withColumn("acq_date", F.col("acq_date").cast("string"))


@query(f"select * replace ({_DAY}) from {_PLACED} t")
def grid_observations(spark, sf):
    return _day(comp.grid_observations(view(spark, sf, "shots"), view(spark, sf, "scenes"), regions_df(spark)))


# source pixels of 0.0011 by 0.0009 degrees: the cells whose centres lie in them, clipped to the region
_SIDES = {"px_row": ("r.lat_max - lat", "0.0009e0", "(r.lat_max - r.lat_min)"), "px_col": ("lon - r.lon_min", "0.0011e0", "(r.lon_max - r.lon_min)")}
_RANGES = {
    n: f"range(cast(greatest(0, ceil(({d} - {size} / 2) / {STEP} - 0.5e0)) as bigint), "
    f"cast(least(ceil(round({span} / {STEP}, 6)), ceil(({d} + {size} / 2) / {STEP} - 0.5e0)) as bigint))"
    for n, (d, size, span) in _SIDES.items()
}


@query(f"""select scene_id, city, {_DAY}, collection, cast(px_row as int) as px_row, cast(unnest(cols) as int) as px_col, {_BANDS}, qa_pixel from (
  select h.scene_id, r.city, s.acq_date, s.collection, unnest({_RANGES['px_row']}) as px_row, {_RANGES['px_col']} as cols, {_BANDS}, qa_pixel
  from {{shots}} h join {{scenes}} s on s.scene_id = h.scene_id join {{regions}} r on {MEETS}) t""")
def grid_fill(spark, sf):
    shots = view(spark, sf, "shots").withColumns({"lon_size": F.lit(0.0011), "lat_size": F.lit(0.0009)})
    return _day(comp.grid_observations(shots, view(spark, sf, "scenes"), regions_df(spark)))


@query(f"""select r.city, r.lon_min, r.lat_min, r.lon_max, r.lat_max, count(s.scene_id) as n_scenes
  from {{regions}} r left join {{scenes}} s on {MEETS} group by all""")
def dim_regions(spark, sf):
    """The region table with the scenes that cover each box."""
    hits = comp.scenes_by_region(view(spark, sf, "scenes"), regions_df(spark)).groupBy("city").agg(F.count("*").alias("n"))
    return regions_df(spark).join(hits, "city", "left").select("city", *comp.BOX, F.coalesce("n", F.lit(0)).alias("n_scenes"))


@query("""select sensor, red, green, blue, nir, count(scene_id) as n_scenes from (values
    ('LT05', 'sr_b3', 'sr_b2', 'sr_b1', 'sr_b4'), ('LE07', 'sr_b3', 'sr_b2', 'sr_b1', 'sr_b4'), ('LC08', 'sr_b4', 'sr_b3', 'sr_b2', 'sr_b5')
  ) b(sensor, red, green, blue, nir) left join {scenes} s on s.collection = b.sensor group by all""")
def dim_bandmap(spark, sf):
    """The band map with the scenes of each sensor."""
    sizes = view(spark, sf, "scenes").groupBy(F.col("collection").alias("sensor")).agg(F.count("*").alias("n"))
    return bandmap_df(spark).join(sizes, "sensor", "left").select("sensor", *c.BANDS, F.coalesce("n", F.lit(0)).alias("n_scenes"))


@query("""select scene_id from {scenes} where lon_min <= -117.20e0 and lon_max >= -117.55e0
  and lat_min <= 34.10e0 and lat_max >= 33.85e0""")
def scenes_in_box(spark, sf):
    return comp.filter_bounds(view(spark, sf, "scenes"), c.REGIONS["riverside"]).select("scene_id")


@query("select scene_id from {scenes} where acq_date >= date '1989-01-01' and acq_date < date '1991-12-31'")
def scenes_in_window(spark, sf):
    from groundshift.functions.dates import window_dates

    return comp.filter_date(view(spark, sf, "scenes"), *window_dates(1990)).select("scene_id")


@query("select scene_id, strftime(acq_date, '%Y-%m-%d') as acq_date, yr from {dated}")
def assign_epoch(spark, sf):
    return comp.assign_epoch(view(spark, sf, "obs")).select("scene_id", F.col("acq_date").cast("string").alias("acq_date"), "yr")


@query("""select scene_id, e.yr from {scenes} s join (values (1990), (1991), (2000), (2001)) e(yr)
  on acq_date >= make_date(cast(e.yr - 1 as bigint), 1, 1) and acq_date < make_date(cast(e.yr + 1 as bigint), 12, 31)""")
def assign_epoch_overlap(spark, sf):
    return comp.assign_epoch(view(spark, sf, "scenes"), [1990, 1991, 2000, 2001]).select("scene_id", "yr")


_COUNT = f"""select r.city, e.yr, count(*) as n_scenes from {{scenes}} s join {{epochs}} e on s.collection = e.sensor
    and acq_date >= make_date(cast(e.yr - 1 as bigint), 1, 1) and acq_date < make_date(cast(e.yr + 1 as bigint), 12, 31)
  join {{regions}} r on {MEETS} group by r.city, e.yr"""


@query(_COUNT)
def image_count(spark, sf):
    return comp.image_count(view(spark, sf, "scenes"), regions_df(spark))


@query(f"""select r.city, e.yr, coalesce(n_scenes, 0) as n_scenes, case when n_scenes > 0 then 'build' else 'skip' end as action,
  r.city || '_' || e.yr || '_composite' as output_name from {{regions}} r cross join {{epochs}} e
  left join ({_COUNT}) k on k.city = r.city and k.yr = e.yr""")
def composite_grid(spark, sf):
    counts = comp.image_count(view(spark, sf, "scenes"), regions_df(spark))
    return comp.composite_jobs(grid_df(spark).select("city", "yr"), counts)


@query("""select d.scene_id, d.yr, e.sensor, strftime(make_date(cast(e.yr - 1 as bigint), 1, 1), '%Y-%m-%d') as window_start
  from {dated} d join {epochs} e on d.yr = e.yr""")
def epoch_sensor(spark, sf):
    dated = comp.assign_epoch(view(spark, sf, "obs"))
    return dated.join(F.broadcast(epochs_df(spark)), "yr").select(
        "scene_id", "yr", "sensor", F.col("window_start").cast("string").alias("window_start")
    )


_CLEAR = "case when (qa_pixel & 16) = 0 and (qa_pixel & 8) = 0 then {} end"


def _median(new: str, old: str) -> str:
    clear = _CLEAR.format(f"(case when yr = 2020 then {new} else {old} end)")
    return f"round(median({clear}) * 2.75e-05 - 0.2, 9) + 0.0"


_COMPOSITE = f"""select city, yr, px_row, px_col, {_median('sr_b4', 'sr_b3')} as red, {_median('sr_b3', 'sr_b2')} as green,
  {_median('sr_b2', 'sr_b1')} as blue, {_median('sr_b5', 'sr_b4')} as nir from {{dated}} group by city, yr, px_row, px_col"""


@query(_COMPOSITE)
def median_composite(spark, sf):
    return comp.build_composites(view(spark, sf, "obs")).select(*c.PIXEL, *rs(c.BANDS))


@query(_COMPOSITE.replace("{dated}", f"""(select p.*, e.yr from {_PLACED} p join {{epochs}} e on e.sensor = p.collection
  and acq_date >= make_date(cast(e.yr - 1 as bigint), 1, 1) and acq_date < make_date(cast(e.yr + 1 as bigint), 12, 31)) d"""))
def scene_composite(spark, sf):
    """The whole chain: raw observations and scenes to composites of the epoch's own sensor."""
    placed = comp.grid_observations(view(spark, sf, "shots"), view(spark, sf, "scenes"), regions_df(spark))
    return comp.build_composites(placed).select(*c.PIXEL, *rs(c.BANDS))


_HOT = "case when scene_id % 3 = 0 and city = 'riverside' then 0 else {0} end as {0}"


@query(_COMPOSITE.replace("{dated}", "(select * replace (" + ", ".join(_HOT.format(n) for n in ("px_row", "px_col")) + ") from {dated}) hot"))
def median_composite_hot(spark, sf):
    """The same with a third of all observations on one pixel."""
    hot = (F.col("scene_id") % 3 == 0) & (F.col("city") == "riverside")
    obs = view(spark, sf, "obs").withColumns({n: F.when(hot, 0).otherwise(F.col(n)) for n in ("px_row", "px_col")})
    return comp.build_composites(obs).select(*c.PIXEL, *rs(c.BANDS))


@query(f"select city, px_row, px_col, " + ", ".join(f"median({_CLEAR.format(b)}) as {b}" for b in c.RAW_BANDS)
       + " from {obs} group by city, px_row, px_col")
def median_all_dates(spark, sf):
    """Per-pixel medians over every date: the deepest stacks the tables give."""
    obs = mask_clouds(view(spark, sf, "obs"), c.RAW_BANDS)
    return comp.median_by_pixel(obs, c.RAW_BANDS, ["city", "px_row", "px_col"])
