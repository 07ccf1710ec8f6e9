"""Band arithmetic, masks, names and display rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundshift import config as c
from groundshift.checks.fixtures import view
from groundshift.checks.registry import query, r, rs, sql_rs
from groundshift.functions import naming, radiometry as rad
from groundshift.functions.dates import date_window
from groundshift.functions.reporting import pct_display, pixels_to_km2, rounded
from groundshift.plans.growth_report import growth_report
from groundshift.operators.classify import (
    band_stats as band_stats_op,
    class_counts as class_counts_op,
    classify,
    classify_rasters,
    coverage as coverage_op,
    nonempty_rasters as nonempty_op,
    prepare_features,
    prob_stats as prob_stats_op,
    rescale_reflectance as rescale_op,
    scatter_full as scatter_op,
    urban_area as urban_area_op,
    with_threshold,
)
from groundshift.operators.composite import assign_epoch
from groundshift.sources.dims import thresholds_df

RAW = ["sr_b1", "sr_b2", "sr_b3", "sr_b4", "sr_b5"]
KEY = "city, yr, px_row, px_col"
NOT_NULL = "(red is not null and green is not null and blue is not null and nir is not null)"
NDVI = (
    "case when nir + red is null then null when abs(nir + red) > 1e-6 "
    "then least(1.0, greatest(-1.0, (nir - red) / (nir + red))) else 0.0 end"
)


def classified(spark, sf):
    return classify(view(spark, sf, "px"))


@query(f"select scene_id, px_row, px_col, qa_pixel, {', '.join(f'round({b} * 2.75e-05 - 0.2, 9) + 0.0 as {b}' for b in RAW)} from {{obs}}")
def scale_factors(spark, sf):
    out = rad.apply_scale_factors(view(spark, sf, "obs"), RAW)
    return out.select("scene_id", "px_row", "px_col", "qa_pixel", *rs(RAW))


@query("select scene_id, sr_b1, sr_b2, sr_b3, sr_b4, sr_b5 from {obs}")
def select_bands(spark, sf):
    return rad.select_bands(view(spark, sf, "obs"), "SR_B.*", keep=["scene_id"])


@query("""
select scene_id, city, yr, case when yr = 2020 then sr_b4 else sr_b3 end as red,
  case when yr = 2020 then sr_b3 else sr_b2 end as green, case when yr = 2020 then sr_b2 else sr_b1 end as blue,
  case when yr = 2020 then sr_b5 else sr_b4 end as nir from {dated}""")
def harmonise_bands(spark, sf):
    return rad.harmonise_bands(assign_epoch(view(spark, sf, "obs"))).select("scene_id", "city", "yr", *c.BANDS)


@query("select scene_id, qa_pixel, " + ", ".join(f"case when (qa_pixel & 16) = 0 and (qa_pixel & 8) = 0 then {b} end as {b}" for b in RAW) + " from {obs}")
def mask_clouds(spark, sf):
    return rad.mask_clouds(view(spark, sf, "obs"), RAW).select("scene_id", "qa_pixel", *RAW)


@query(f"select {KEY}, round(case when nir >= 0 and red >= 0 then (nir - red) / nullif(nir + red, 0) end, 9) + 0.0 as nd from {{px}}")
def nd_masked(spark, sf):
    nd = rad.normalized_difference(F.col("nir"), F.col("red"))
    return view(spark, sf, "px").select(*c.PIXEL, r(nd).alias("nd"))


@query(f"select {KEY}, round({NDVI}, 9) + 0.0 as ndvi from {{px}}")
def ndvi_safe(spark, sf):
    return view(spark, sf, "px").select(*c.PIXEL, r(rad.ndvi_safe(F.col("nir"), F.col("red"))).alias("ndvi"))


@query(f"select {KEY}, " + ", ".join(f"case when {b} is not null then greatest({b}, 0.0) end as {b}" for b in c.BANDS) + " from {px}")
def clip_negatives(spark, sf):
    return rad.clip_negatives(view(spark, sf, "px")).select(*c.PIXEL, *c.BANDS)


@query(f"select {KEY}, {NOT_NULL} as valid from {{px}}")
def valid_mask(spark, sf):
    return rad.with_valid(view(spark, sf, "px")).select(*c.PIXEL, "valid")


@query(f"select {KEY}, red, nir from {{px}} where {NOT_NULL}")
def valid_only(spark, sf):
    return rad.valid_only(view(spark, sf, "px")).select(*c.PIXEL, "red", "nir")


@query(f"select {KEY}, red, green from {{px}}")
def mask_nodata(spark, sf):
    stored = view(spark, sf, "px").fillna(-9999.0, subset=["red", "green"])
    return rad.mask_nodata(stored, ["red", "green"], -9999.0).select(*c.PIXEL, "red", "green")


@query(f"select {KEY}, " + ", ".join(f"round(least(1.0, greatest(0.0, {b} / 0.3e0)), 9) + 0.0 as {b}" for b in ["green", "blue"])
       + ", case when red is not null then round(least(1.0, greatest(0.0, red / 0.3e0)), 9) + 0.0 end as red from {px}")
def stretch_fixed(spark, sf):
    bands = ["red", "green", "blue"]
    return rad.stretch(view(spark, sf, "px"), bands, 0.0, 0.3).select(*c.PIXEL, *rs(bands))


@query(f"select {KEY}, red as v0, green as v1, blue as v2 from {{px}}")
def stack_bands(spark, sf):
    stacked = rad.stack_bands(view(spark, sf, "px"), ["red", "green", "blue"])
    return stacked.select(*c.PIXEL, *[F.col("stack")[i].alias(f"v{i}") for i in range(3)])


@query("""
select scene_id, yr, strftime(make_date(cast(yr - 1 as bigint), 1, 1), '%Y-%m-%d') as window_start,
  strftime(make_date(cast(yr + 1 as bigint), 12, 31), '%Y-%m-%d') as window_end from {dated}""")
def date_windows(spark, sf):
    start, end = date_window(F.col("yr"))
    return assign_epoch(view(spark, sf, "obs")).select(
        "scene_id", "yr", start.cast("string").alias("window_start"), end.cast("string").alias("window_end")
    )


def _named(spark, sf):
    name = F.concat_ws("_", F.initcap("city"), F.col("yr").cast("string"), F.lit("composite.tif"))
    return view(spark, sf, "px").select(name.alias("name"))


_NAMES = """(select case city when 'riverside' then 'Riverside' when 'phoenix' then 'Phoenix' when 'austin' then 'Austin'
  else 'Las_vegas' end || '_' || yr || '_composite.tif' as name, city, case when yr = 2020 then '2020' else 'legacy' end as era from {px}) t"""


@query(f"select name, city, era, count(*) as n from {_NAMES} group by name, city, era")
def parse_city_era(spark, sf):
    return naming.parse_city_era(_named(spark, sf)).groupBy("name", "city", "era").agg(F.count("*").alias("n"))


@query(f"""select name, 'urban_rf_model_' || era as model, replace(name, '_composite.tif', '_classification.tif') as output_name,
  count(*) as n from {_NAMES} group by all""")
def route_model(spark, sf):
    return naming.route_model(_named(spark, sf)).groupBy("name", "model", "output_name").agg(F.count("*").alias("n"))


@query("""select sample_id, case subclass when 'bare_soil' then 'Bare Soil' when 'urban' then 'Urban' when 'water' then 'Water'
  when 'farmland' then 'Farmland' else 'Vegetation' end as title from {sm}""")
def title_label(spark, sf):
    return view(spark, sf, "sm").select("sample_id", naming.title_label(F.col("subclass")).alias("title"))


@query(f"select {KEY}, threshold from (select px.*, threshold from {{px}} px join {{thr}} thr on px.city = thr.city and px.yr = thr.yr) t")
def threshold_lookup(spark, sf):
    return with_threshold(view(spark, sf, "px")).select(*c.PIXEL, "threshold")


@query("select t.city, t.yr, t.threshold, coalesce(n, 0) as n_pixels from {thr} t left join (select city, yr, count(*) as n from {px} group by city, yr) k on k.city = t.city and k.yr = t.yr")
def dim_thresholds(spark, sf):
    """The threshold table with the pixels each entry decides."""
    sizes = view(spark, sf, "px").groupBy(*c.RASTER).agg(F.count("*").alias("n"))
    return thresholds_df(spark).join(sizes, c.RASTER, "left").select(*c.RASTER, "threshold", F.coalesce("n", F.lit(0)).alias("n_pixels"))


@query(f"select {KEY}, urban_class from {{cls}}")
def threshold_classify(spark, sf):
    return classified(spark, sf).select(*c.PIXEL, "urban_class")


@query("""select f.city, f.yr, cast(f.px_row as int) as px_row, cast(f.px_col as int) as px_col, coalesce(urban_class, 255) as urban_class
  from {cells} f left join {cls} k on k.city = f.city and k.yr = f.yr and k.px_row = f.px_row and k.px_col = f.px_col""")
def scatter_full(spark, sf):
    scored = classified(spark, sf).where(F.col("urban_class") != c.NODATA)
    return scatter_op(scored, view(spark, sf, "px"))


@query("""select city, yr, px_row, n, cast(round(cast(n as decimal(18,0)) * 0.0009, 2) as double) as km2
  from (select city, yr, px_row, cast(sum(case when urban_class = 1 then 1 else 0 end) as bigint) as n from {cls} group by city, yr, px_row) t""", name="pixels_to_km2")
def pixels_to_km2_by_line(spark, sf):
    lines = classified(spark, sf).groupBy("city", "yr", "px_row").agg(F.count_if(F.col("urban_class") == 1).alias("n"))
    return lines.withColumn("km2", pixels_to_km2(F.col("n")))


@query(f"""select {KEY}, case when red is null then '—' else
  cast(cast(round(cast(red * 100 as decimal(24,6)), 1) as decimal(18,1)) as varchar) || '%' end as shown from {{px}}""", name="pct_display")
def pct_display_pixels(spark, sf):
    return view(spark, sf, "px").select(*c.PIXEL, pct_display(rounded(F.col("red") * 100, 1)).alias("shown"))


_TOPS = f"""(select city, yr, {', '.join(f'max({b}) as top_{b}' for b in c.BANDS)} from {{px10k}} where {NOT_NULL} group by city, yr)"""
_RESCALED = f"""(select p.city, p.yr, p.px_row, p.px_col, urban_prob, """ + ", ".join(
    f"case when top_{b} > 100 then {b} / 10000.0e0 when top_{b} > 1.0 then (case when {b} is null then null else least(1.0, greatest(0.0, {b})) end) else {b} end as {b}"
    for b in c.BANDS
) + f" from {{px10k}} p left join {_TOPS} m on p.city = m.city and p.yr = m.yr)"
_PREPARED = f"""(select *, {NDVI} as ndvi from (select city, yr, px_row, px_col, urban_prob, {NOT_NULL} as valid, """ + ", ".join(
    f"case when {b} is not null then greatest({b}, 0.0) end as {b}" for b in c.BANDS
) + f" from {_RESCALED} q) s)"


@query(f"select {KEY}, {sql_rs(c.BANDS)} from {_RESCALED} t")
def rescale_reflectance(spark, sf):
    return rescale_op(view(spark, sf, "px10k")).select(*c.PIXEL, *rs(c.BANDS))


@query(f"""select city, yr, cast(sum(case when {NOT_NULL} then 1 else 0 end) as bigint) as n_valid, count(*) as n_total,
  round(sum(case when {NOT_NULL} then 1 else 0 end) * 100.0e0 / count(*), 9) as pct_valid
  from (select f.city, f.yr, red, green, blue, nir from {{cells}} f
    left join {{px}} p on p.city = f.city and p.yr = f.yr and p.px_row = f.px_row and p.px_col = f.px_col) t group by city, yr""")
def coverage(spark, sf):
    return coverage_op(view(spark, sf, "px")).withColumn("pct_valid", r("pct_valid"))


@query(f"select city, yr, cast(count(*) as bigint) as n_valid from {{px}} where {NOT_NULL} group by city, yr")
def nonempty_rasters(spark, sf):
    return nonempty_op(view(spark, sf, "px")).select("city", "yr", "n_valid")


def _spread_sql(cols, out=None):
    return ", ".join(
        f"round(min({x}), 9) + 0.0 as {out or x}_min, round(max({x}), 9) + 0.0 as {out or x}_max, "
        f"round(avg({x}), 6) + 0.0 as {out or x}_mean, round(stddev_pop({x}), 6) as {out or x}_std"
        for x in cols
    )


def _spread_cols(cols):
    return [x for n in cols for x in (*rs([f"{n}_min", f"{n}_max"]), *rs([f"{n}_mean", f"{n}_std"], 6))]


@query(f"select city, yr, {_spread_sql(c.FEATURES)} from {_PREPARED} t where valid group by city, yr")
def band_stats(spark, sf):
    return band_stats_op(prepare_features(view(spark, sf, "px10k"))).select("city", "yr", *_spread_cols(c.FEATURES))


@query(f"select city, yr, {_spread_sql(['urban_prob'], 'prob')} from {{px}} where {NOT_NULL} group by city, yr")
def prob_stats(spark, sf):
    scored = rad.with_valid(view(spark, sf, "px"))
    return prob_stats_op(scored).select("city", "yr", *_spread_cols(["prob"]))


_COUNTS = """select city, yr, cast(sum(case when urban_class = 1 then 1 else 0 end) as bigint) as urban_pixels,
  cast(sum(case when urban_class = 0 then 1 else 0 end) as bigint) as nonurban_pixels,
  cast(sum(case when urban_class = 255 then 1 else 0 end) as bigint) as nodata_pixels, count(*) as total_pixels,
  round(sum(case when urban_class = 1 then 1 else 0 end) * 100.0e0 / nullif(sum(case when urban_class <> 255 then 1 else 0 end), 0), 9) as urban_pct_valid,
  round(sum(case when urban_class = 0 then 1 else 0 end) * 100.0e0 / nullif(sum(case when urban_class <> 255 then 1 else 0 end), 0), 9) as nonurban_pct_valid,
  round(sum(case when urban_class = 255 then 1 else 0 end) * 100.0e0 / count(*), 9) as nodata_pct
"""
_SHARES = ["urban_pct_valid", "nonurban_pct_valid", "nodata_pct"]


def _rounded_counts(df):
    return df.withColumns({n: r(n) for n in _SHARES})


def _on_cells(classes: str) -> str:
    """Classes on every cell of the rasters; a cell without a pixel is no data."""
    return f"""(select f.city, f.yr, coalesce(urban_class, 255) as urban_class from {{cells}} f
  left join {classes} k on k.city = f.city and k.yr = f.yr and k.px_row = f.px_row and k.px_col = f.px_col) t"""


@query(f"{_COUNTS} from {_on_cells('{cls}')} group by city, yr")
def class_counts(spark, sf):
    return _rounded_counts(class_counts_op(classified(spark, sf)))


@query("select city, yr, urban_pixels, urban_area_km2 from {area}")
def urban_area(spark, sf):
    return urban_area_op(classified(spark, sf))


def ndvi_scorer(df):
    """A stand-in model that depends on every prepared feature."""
    bright = (F.col("red") + F.col("green") + F.col("blue")) / 3.0
    return df.withColumn("urban_prob", F.col("urban_prob") * 0.5 + (1.0 - F.col("ndvi")) * 0.25 + bright * 0.25)


_SCORED = f"""(select t.city, t.yr, t.px_row, t.px_col, case when not valid then 255 when cast(urban_prob * 0.5e0 + (1.0e0 - ndvi) * 0.25e0
    + ((red + green + blue) / 3.0e0) * 0.25e0 as float) >= cast(threshold as float) then 1 else 0 end as urban_class
  from {_PREPARED} t join {{thr}} thr on t.city = thr.city and t.yr = thr.yr)"""


@query(f"{_COUNTS} from {_on_cells(_SCORED)} group by city, yr")
def classify_counts(spark, sf):
    return _rounded_counts(class_counts_op(classify_rasters(view(spark, sf, "px10k"), ndvi_scorer)))


@query("""select g.city, g.yr, case when not (g.city = 'austin' and g.yr = 2000) then a.urban_area_km2 end as urban_area_km2
  from (select city, yr from {regions} cross join {epochs}) g left join {area} a on a.city = g.city and a.yr = g.yr""")
def masked_raster_area(spark, sf):
    """A raster without a valid pixel is not classified: its area is missing, not 0."""
    masked = (F.col("city") == "austin") & (F.col("yr") == 2000)
    px = view(spark, sf, "px").withColumn("red", F.when(~masked, F.col("red")))
    return growth_report(classify_rasters(px, lambda df: df)).select("city", "yr", "urban_area_km2")
