"""The whole study on the smallest tables, stored table to stored table."""

import math
import re
from functools import partial

import pytest
from pyspark.sql import functions as F

from groundshift import __main__ as cli
from groundshift import config as c
from groundshift.checks.fixtures import view
from groundshift.plans import jobs, reports
from groundshift.session import scratch_path
from groundshift.sources import raster
from groundshift.sources.raster import read_raster

SF = "/root/testdata/sf0.001"
#: Cells of the export grids, from the boxes by hand: 0.25 x 0.35 and 0.40 x 0.40 degrees.
CELL = 30 / 111_319.49
GRID = {math.ceil(h / CELL) * math.ceil(w / CELL) for h, w in ((0.25, 0.35), (0.40, 0.40))}


def test_study_end_to_end(spark):
    path = {n: scratch_path(spark, n) for n in ("obs", "scenes", "composites", "points", "samples", "models", "classes", "metrics")}
    view(spark, SF, "obs").write.parquet(path["obs"])
    view(spark, SF, "scenes").write.parquet(path["scenes"])

    status = jobs.composite_status(spark, path["scenes"])
    assert status.count() == 16

    cover = jobs.composites(spark, path["obs"], path["composites"])
    px = read_raster(spark, path["composites"])
    assert px.columns == [*c.PIXEL, *c.BANDS] and {r.n_total for r in cover.collect()} == GRID

    raw = scratch_path(spark, "shots")
    view(spark, SF, "shots").write.parquet(raw)
    placed = jobs.composites(spark, raw, scratch_path(spark, "placed"), scenes=path["scenes"])
    assert {r.city for r in placed.collect()} <= set(c.CITIES) and not placed.isEmpty()

    order = F.row_number().over(jobs_window())
    kinds = F.element_at(F.array(*map(F.lit, c.SUBCLASS_ORDER)), (F.col("px_col") % 5 + 1).cast("int"))
    kinds = F.when(F.col("nir") < F.col("red"), "urban").otherwise(kinds)
    px.withColumn("subclass", kinds).select(order.alias("point_id"), *c.PIXEL, "subclass").write.parquet(path["points"])
    samples = jobs.training_set(spark, path["composites"], path["points"], path["samples"])
    assert samples.columns == ["red", "green", "blue", "nir", "ndvi", "label", "city", "year", "subclass"]
    assert {r.label for r in samples.select("label").distinct().collect()} == {0, 1}

    done = jobs.train(spark, path["samples"], path["models"])
    assert all(0.5 < r.accuracy <= 1.0 for r in done.metrics.collect())

    counts = jobs.classify(spark, path["composites"], path["models"], path["classes"])
    total = counts.agg(F.sum("total_pixels"), F.sum(F.col("urban_pixels") + F.col("nonurban_pixels") + F.col("nodata_pixels"))).first()
    assert total[0] == total[1]
    assert {r.total_pixels for r in counts.collect()} == GRID
    classes = {r.urban_class for r in read_raster(spark, path["classes"]).select("urban_class").distinct().collect()}
    assert classes <= {0, 1, c.NODATA}

    table = jobs.metrics(spark, path["classes"], path["metrics"])
    assert table.count() == 16
    for name, report in reports.REPORTS.items():
        assert isinstance(report(table).collect(), list), name
    stored = jobs.stored_samples(spark, path["samples"])
    for name, describe in jobs.DESCRIPTIONS.items():
        assert describe(stored).count() > 0, name


def test_rasters_as_tables_are_joined_where_they_lie(spark, monkeypatch):
    monkeypatch.setattr(raster, "write_raster_table", partial(raster.write_raster_table, buckets=4))
    obs, names = scratch_path(spark, "obs"), ("composites_t", "classes_t", "overlay_t")
    view(spark, SF, "obs").write.parquet(obs)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cover = jobs.composites(spark, obs, names[0])
        assert {r.n_total for r in cover.collect()} == GRID
        px = spark.table(names[0])
        raster.save_raster(px.select(*c.PIXEL, (F.col("px_row") % 2).alias("urban_class")), names[1])
        joined = jobs.tinted(raster.open_raster(spark, names[0]), raster.open_raster(spark, names[1]))
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and not re.search(r"Exchange hashpartitioning\([^)]*px_row", text)
        out = jobs.overlay(spark, *names)
        assert out.count() == px.count() and out.where("over_a > 0").count() == px.where("px_row % 2 = 1").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in names:
            spark.sql(f"drop table if exists {name}")


def jobs_window():
    from pyspark.sql import Window

    return Window.orderBy(*c.PIXEL)


@pytest.mark.parametrize("line", ["composites a b --years 1990 --cities austin --scenes s", "train a b --city riverside", "metrics a b", "overlay a b c", "report m growth_table", "describe s means"])
def test_command_line_is_understood(line):
    assert cli.parser().parse_args(line.split()).job == line.split()[0]
