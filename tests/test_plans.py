"""What must reach the scan, and what must not be shuffled."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from groundshift import config as c
from groundshift.operators.composite import assign_epoch
from groundshift.operators import small
from groundshift.operators.raster import clip_box, clip_pixels, overlay, pixel_centres
from groundshift.operators.sampling import sample_points
from groundshift.plans.growth_report import growth_report
from groundshift.session import scratch_path
from groundshift.sources.dims import regions_df
from groundshift.sources.raster import read_raster, write_raster, write_raster_table
from groundshift.sources.tables import scan_scenes, write_scenes


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raster_filters_prune_folders(spark, pixels):
    path = scratch_path(spark, "prune")
    write_raster(pixels({("austin", 1990): [[1, 0]], ("austin", 2000): [[0, 1]], ("phoenix", 1990): [[1]]}), path)
    px = read_raster(spark, path).where("city = 'austin' and yr = 2000")
    assert "PartitionFilters: [isnotnull(city" in plan(px)
    assert sorted(r.urban_class for r in px.collect()) == [0, 1]


def test_epoch_dates_reach_the_scan(spark):
    path = scratch_path(spark, "dates")
    days = [datetime.date(1985, 1, 1), datetime.date(1990, 6, 1), datetime.date(2020, 6, 1)]
    spark.createDataFrame([(d,) for d in days], "acq_date date").write.parquet(path)
    out = assign_epoch(spark.read.parquet(path))
    text = plan(out)
    assert "GreaterThanOrEqual(acq_date,1989-01-01)" in text and "LessThan(acq_date,1991-12-31)" in text
    assert sorted(r.yr for r in out.collect()) == [1990, 2020]


def test_scene_scan_reads_one_sensor(spark):
    path = scratch_path(spark, "sensors")
    rows = [(1, "LT05"), (2, "LE07"), (3, "LC08"), (4, "LT05")]
    write_scenes(spark.createDataFrame(rows, "scene_id long, collection string"), path)
    out = scan_scenes(spark, path, 2000)
    assert "PartitionFilters: [isnotnull(collection" in plan(out)
    assert sorted(r.scene_id for r in out.collect()) == [1, 4]
    with pytest.raises(ValueError):
        scan_scenes(spark, path, 1995)


def test_report_reads_only_the_class_column(spark, pixels):
    path = scratch_path(spark, "columns")
    px = pixels({("austin", 1990): [[1, 0]], ("austin", 2000): [[1, 1]]})
    write_raster(px.withColumn("urban_prob", F.lit(0.5)), path)
    assert "ReadSchema: struct<urban_class:int>" in plan(growth_report(read_raster(spark, path)))


def test_boxes_reach_the_scan_as_rows_and_columns(spark, pixels):
    path = scratch_path(spark, "boxed")
    grid = [[1] * 40 for _ in range(30)]
    write_raster(pixels({("austin", 1990): grid, ("phoenix", 1990): grid}), path)
    step, x0, y1 = c.STEP_DEGREES, c.REGIONS["austin"][0], c.REGIONS["austin"][3]
    edge = lambda k: x0 + (k + 0.5) * step
    # borders on the centres of columns 3 and 7, and of rows 2 and 4
    row = ("austin", edge(3), y1 - 4.5 * step, edge(7), y1 - 2.5 * step)
    boxes = spark.createDataFrame([row], "city string, lon_min double, lat_min double, lon_max double, lat_max double")
    px = read_raster(spark, path)
    out = clip_pixels(px, boxes, regions_df(spark))
    text = plan(out)
    # the list is cut off by the plan's printout
    assert "PushedFilters: [IsNotNull(px_row), IsNotNull(px_col), GreaterThanOrEqual(px_row,2), LessThanOrEqual(px_row,4)" in text
    assert re.search(r"px_col#\d+ >= 3\) AND \(px_col#\d+ <= 7", text)
    assert re.search(r"PartitionFilters: \[[^]]*austin", text) and "Exchange" not in text
    assert sorted({(r.px_row, r.px_col) for r in out.collect()}) == [(i, j) for i in (2, 3, 4) for j in range(3, 8)]
    by_centre = clip_box(pixel_centres(px, regions_df(spark)), boxes).select(*px.columns)
    assert by_centre.count() == out.count() and by_centre.exceptAll(out).isEmpty()
    assert clip_pixels(px, boxes.limit(0), regions_df(spark)).isEmpty()


def test_many_points_shuffle_only_pixels_that_may_have_one(spark):
    """200,000 points: the large side is cut to about the pixels that match before its shuffle."""
    px = spark.range(2_000_000).selectExpr("'a' as city", "1990 as yr", "cast(id / 2000 as int) as px_row", "cast(id % 2000 as int) as px_col", "1.0 as red")
    pts = spark.range(200_000).selectExpr("id as point_id", "'a' as city", "1990 as yr", "cast(id / 400 as int) as px_row", "cast(5 * (id % 400) as int) as px_col")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = sample_points(px, pts, ["red"])
        assert "BroadcastHashJoin" in plan(out) and "SortMergeJoin" in plan(out)
        assert out.count() == 200_000
        cut = small.may_have(px, pts, c.PIXEL)
        assert 200_000 <= cut.count() <= 200_000 + 2_000_000 / 16
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_few_points_leave_the_rasters_in_place(spark, monkeypatch):
    px = spark.range(1000).selectExpr(
        "'a' as city", "1990 as yr", "cast(id / 40 as int) as px_row", "cast(id % 40 as int) as px_col", "id / 1000 as red"
    )
    # a third of the points on one pixel
    pts = spark.range(300).selectExpr(
        "id as point_id", "'a' as city", "1990 as yr", "if(id % 3 = 0, 3, cast(id % 25 as int)) as px_row", "if(id % 3 = 0, 3, cast(id % 40 as int)) as px_col"
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = sample_points(px, pts, ["red"])
        assert "BroadcastHashJoin" in plan(few) and "Exchange hashpartitioning" not in plan(few)
        monkeypatch.setattr(small, "MAX_ROWS", 100)
        many = sample_points(px, pts, ["red"])
        assert "SortMergeJoin" in plan(many)
        assert few.count() == many.count() == 300 and few.exceptAll(many).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_rasters_join_without_a_shuffle(spark):
    n = spark.range(2000).select(
        F.lit("austin").alias("city"),
        F.lit(1990).alias("yr"),
        (F.col("id") / 50).cast("int").alias("px_row"),
        (F.col("id") % 50).cast("int").alias("px_col"),
        (F.col("id") / 2000.0).alias("red"),
        (F.col("id") / 3000.0).alias("green"),
        (F.col("id") / 4000.0).alias("blue"),
        (F.col("id") % 2).cast("int").alias("urban_class"),
    )
    write_raster_table(n.drop("urban_class"), "px_b", 4)
    write_raster_table(n.select(*c.PIXEL, "urban_class"), "cls_b", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = overlay(spark.table("px_b"), spark.table("cls_b"))
        assert not re.search(r"Exchange hashpartitioning\([^)]*px_row", plan(joined))  # the bounds per raster are shuffled
        assert joined.count() == 2000
        assert joined.agg(F.sum("over_g")).first()[0] == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("drop table px_b")
        spark.sql("drop table cls_b")
