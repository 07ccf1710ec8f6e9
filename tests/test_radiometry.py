import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from groundshift.functions import naming, radiometry as rad
from groundshift.functions.dates import date_window
from groundshift.functions.reporting import direction, pct_display, percent_change, pixels_to_km2, rounded
from groundshift.operators.classify import classify, classify_rasters, rescale_reflectance
from groundshift.operators.composite import assign_epoch

NAN, INF = float("nan"), float("inf")


def one(df):
    return tuple(df.first())


def column(df):
    return [r[0] for r in df.collect()]


def values(spark, rows, schema):
    return spark.createDataFrame(rows, schema).coalesce(1)


def test_scale_keeps_other_columns(spark):
    out = rad.apply_scale_factors(values(spark, [(10000, 64)], "sr_b1 int, qa_pixel int"), ["sr_b1"])
    assert one(out) == (pytest.approx(0.075), 64)


def test_bands_by_regex_or_list(spark):
    df = values(spark, [(1, 2, 3)], "sr_b1 int, sr_b10 int, qa int")
    assert rad.select_bands(df, "SR_B.*").columns == ["sr_b1", "sr_b10"]
    assert rad.select_bands(df, ["sr_b1"], keep=["qa"]).columns == ["qa", "sr_b1"]


def test_cloud_and_shadow_bits(spark):
    df = values(spark, [(q, 7) for q in (0, 8, 16, 24, 64, 4, None)], "qa_pixel int, b int")
    assert [r.b for r in rad.mask_clouds(df, ["b"]).collect()] == [7, None, None, None, 7, 7, None]


def test_unknown_year_is_an_error(spark):
    raw = values(spark, [(1995, 1, 2, 3, 4, 5)], "yr int, sr_b1 int, sr_b2 int, sr_b3 int, sr_b4 int, sr_b5 int")
    with pytest.raises(PySparkException):
        rad.harmonise_bands(raw).collect()
    with pytest.raises(ValueError):
        assign_epoch(raw, [1995], sensor_col="collection")


def test_normalized_difference_masks(spark):
    df = values(spark, [(0.4, 0.2), (-0.1, 0.2), (0.0, 0.0), (None, 0.1)], "nir double, red double")
    got = column(df.select(rad.normalized_difference(F.col("nir"), F.col("red"))))
    assert got == [pytest.approx(1 / 3), None, None, None]


def test_ndvi_zero_sum_and_clamp(spark):
    df = values(spark, [(0.0, 0.0), (0.5, -0.4), (-0.4, 0.5), (4e-7, 4e-7), (None, 1.0)], "nir double, red double")
    assert column(df.select(rad.ndvi_safe(F.col("nir"), F.col("red")))) == [0.0, 1.0, -1.0, 0.0, None]


def test_validity_needs_finite_bands(spark):
    rows = [(0.1, 0.1), (None, 0.1), (NAN, 0.1), (INF, 0.1), (0.1, -INF)]
    assert [r.valid for r in rad.with_valid(values(spark, rows, "a double, b double"), ["a", "b"]).collect()] == [True] + [False] * 4


def test_floor_and_nodata_keep_missing(spark):
    df = values(spark, [(-0.2,), (None,), (0.3,)], "a double")
    assert column(rad.clip_negatives(df, ["a"])) == [0.0, None, 0.3]
    assert column(rad.mask_nodata(values(spark, [(-9.0,), (1.0,)], "a double"), ["a"], -9.0)) == [None, 1.0]


def test_stretch_with_no_range_is_missing(spark):
    assert column(rad.stretch(values(spark, [(0.5,)], "a double"), ["a"], 0.2, 0.2)) == [None]


@pytest.mark.parametrize("top, got", [(0.9, 0.9), (1.0, 1.0), (1.2, 1.0), (100.0, 1.0), (101.0, 0.0101)])
def test_rescale_follows_the_largest_value(spark, top, got):
    df = values(spark, [("a", 1990, top, -0.5)], "city string, yr int, red double, nir double")
    out = rescale_reflectance(df, ["red", "nir"]).first()
    assert out.red == pytest.approx(got) and out.nir == -0.5


def test_rescale_ignores_invalid_pixels_and_empty_rasters(spark):
    rows = [("a", 1990, 5000.0, None), ("a", 1990, 0.5, 0.5), ("b", 1990, 7000.0, None)]
    out = rescale_reflectance(values(spark, rows, "city string, yr int, red double, nir double"), ["red", "nir"])
    assert sorted(r.red for r in out.collect()) == [0.5, 5000.0, 7000.0]


def test_a_raster_without_threshold_stops_the_job(spark, pixels):
    with pytest.raises(Exception, match="no threshold for reno 1990"):
        classify(pixels({("reno", 1990): [[0.5]]}, "urban_prob", "double").selectExpr("*", "true as valid")).collect()


def test_threshold_is_met_in_single_precision(spark):
    rows = [("riverside", 2020, 0.63, True), ("riverside", 2020, 0.6299, True), ("austin", 1990, 0.35, True), ("austin", 1990, 1.0, False)]
    out = classify(values(spark, rows, "city string, yr int, urban_prob double, valid boolean"))
    assert [r.urban_class for r in out.collect()] == [1, 0, 1, 255]
    assert [r.threshold for r in out.collect()] == [0.63, 0.63, 0.35, 0.35]


def test_classify_keeps_every_pixel(spark):
    rows = [("phoenix", 1990, 0, j, v, 0.1, 0.1, 0.2) for j, v in enumerate([0.1, None, NAN, -3.0])]
    px = values(spark, rows, "city string, yr int, px_row int, px_col int, red double, green double, blue double, nir double")
    out = classify_rasters(px, lambda df: df.withColumn("urban_prob", F.lit(0.9)))
    assert [r.urban_class for r in out.orderBy("px_col").collect()] == [1, 255, 255, 1]


def test_names(spark):
    df = values(spark, [("Las_Vegas_2020_composite.tif",), ("austin_1990_composite.tif",)], "name string")
    out = naming.route_model(df).collect()
    assert [(r.city, r.era, r.model) for r in out] == [
        ("las_vegas", "2020", "urban_rf_model_2020"),
        ("austin", "legacy", "urban_rf_model_legacy"),
    ]
    assert out[1].output_name == "austin_1990_classification.tif"
    for bad in ["reno_2020_composite.tif", "austin_1985_composite.tif"]:
        with pytest.raises(PySparkException):
            naming.parse_city_era(values(spark, [(bad,)], "name string")).collect()


def test_windows(spark):
    start, end = date_window(1990)
    row = spark.range(1).select(start.cast("string"), end.cast("string")).first()
    assert tuple(row) == ("1989-01-01", "1991-12-31")


def test_area_rounding(spark):
    df = values(spark, [(0,), (50,), (1_000_000_000,)], "n long")
    assert column(df.select(pixels_to_km2(F.col("n")))) == [0.0, 0.05, 900000.0]


def test_percent_rules(spark):
    df = values(spark, [(10.0, 15.0), (0.0, 5.0), (None, 5.0), (5.0, None)], "a double, b double")
    assert column(df.select(percent_change(F.col("a"), F.col("b")))) == [50.0, None, None, None]
    assert column(df.select(percent_change(F.col("a"), F.col("b"), 0.0))) == [50.0, 0.0, None, None]


def test_display(spark):
    df = values(spark, [(12.25,), (-3.0,), (0.0,), (None,)], "p double")
    assert column(df.select(pct_display(rounded(F.col("p"), 1)))) == ["12.3%", "-3.0%", "0.0%", "—"]
    assert column(df.select(direction(F.col("p")))) == ["▲", "▼", "▼", None]
    assert not math.isnan(df.first()[0])
