import numpy as np
import pytest
from pyspark.sql import functions as F

from groundshift import config as c
from groundshift.operators import raster as ras
from groundshift.sources.dims import regions_df
from groundshift.sources.raster import pixels_to_tiles, tiles_to_pixels


def grid(df, name="urban_class", city="a", yr=1990):
    rows = df.where((F.col("city") == city) & (F.col("yr") == yr)).collect()
    out = np.full((max(r.px_row for r in rows) + 1, max(r.px_col for r in rows) + 1), -1)
    for r in rows:
        assert out[r.px_row, r.px_col] == -1
        out[r.px_row, r.px_col] = r[name]
    return out


def cropped(data, pad, nodata=255):
    valid = data != nodata
    if not valid.any():
        return data
    r, k = np.where(valid.any(axis=1))[0], np.where(valid.any(axis=0))[0]
    return data[max(0, r[0] - pad) : r[-1] + pad + 1, max(0, k[0] - pad) : k[-1] + pad + 1]


@pytest.mark.parametrize("pad", [0, 1, 2, 50])
def test_crop(pixels, pad):
    a = np.full((9, 7), 255)
    a[3, 2], a[5, 4] = 1, 0
    single = np.full((4, 4), 255)
    single[0, 3] = 1
    empty = np.full((3, 2), 255)
    df = pixels({("a", 1990): a.tolist(), ("a", 2000): single.tolist(), ("b", 1990): empty.tolist()})
    out = ras.crop_to_valid(df, pad=pad)
    assert (grid(out) == cropped(a, pad)).all()
    assert (grid(out, yr=2000) == cropped(single, pad)).all()
    assert (grid(out, city="b") == empty).all()


@pytest.mark.parametrize("shape, width", [((5, 7), 7), ((5, 7), 3), ((7, 5), 12), ((3, 10), 1), ((4, 4), 9), ((11, 13), 30), ((1, 9), 2)])
def test_resample(pixels, shape, width):
    a = np.arange(shape[0] * shape[1]).reshape(shape)
    height = int(width * (shape[0] / shape[1]))
    out = ras.resample_nearest(pixels({("a", 1990): a.tolist()}), width)
    if height == 0:
        assert out.isEmpty()
        return
    rows = np.floor((np.arange(height) + 0.5) * shape[0] / height).astype(int)
    cols = np.floor((np.arange(width) + 0.5) * shape[1] / width).astype(int)
    assert (grid(out) == a[np.ix_(rows, cols)]).all()


def test_frames_skip_absent_years(pixels):
    df = pixels({("a", y): [[1, 0], [255, 1]] for y in (1990, 2010, 2020)} | {("b", 2000): [[0]]})
    out = ras.timelapse_frames(df, width=4)
    frames = {(r.city, r.yr): r.frame for r in out.select("city", "yr", "frame").distinct().collect()}
    assert frames == {("a", 1990): 1, ("a", 2010): 2, ("a", 2020): 3, ("b", 2000): 1}
    top = out.where("city = 'a' and yr = 1990 and px_row = 0 and px_col = 0").first()
    assert (top.r, top.g, top.b, top.a) == c.MAP_PALETTE["urban"]
    assert out.where("city = 'a' and yr = 1990").count() == 16


def test_tiles_hold_the_whole_extent(spark, pixels):
    a = np.arange(7 * 10).reshape(7, 10)
    rows = [("a", 1990, i, j, int(a[i, j])) for i in range(7) for j in range(10) if not (i < 4 and 4 <= j < 8) and (i, j) != (6, 0)]
    df = spark.createDataFrame(rows, "city string, yr int, px_row int, px_col int, v int")
    tiles = pixels_to_tiles(df, ["v"], tile=4, nodata=-1)
    assert tiles.count() == 6
    assert {(r.tile_row, r.tile_col): len(r.v) for r in tiles.collect()} == {
        (0, 0): 16, (0, 1): 16, (0, 2): 8, (1, 0): 12, (1, 1): 12, (1, 2): 6,
    }
    back = tiles_to_pixels(tiles, ["v"], tile=4)
    want = a.copy()
    want[:4, 4:8], want[6, 0] = -1, -1
    got = np.full((7, 10), 99)
    for r in back.collect():
        got[r.px_row, r.px_col] = r.v
    assert (got == want).all() and back.count() == 70


def test_a_repeated_pixel_stops_the_job(spark, pixels):
    px = pixels({("a", 1990): [[1, 2], [3, 4]]})
    assert pixels_to_tiles(px, ["urban_class"], 2).count() == 1
    with pytest.raises(Exception, match="given twice in tile a 1990 0 0"):
        pixels_to_tiles(px.union(px.limit(1)), ["urban_class"], 2).collect()


def test_grid_sizes_do_not_depend_on_what_was_seen(spark):
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 10 * c.STEP_DEGREES, 3.5 * c.STEP_DEGREES)], "city string, lon_min double, lat_min double, lon_max double, lat_max double")
    sizes = ras.grid_sizes(boxes, [1990, 2000])
    assert sorted(tuple(r) for r in sizes.collect()) == [("a", 1990, 4, 10), ("a", 2000, 4, 10)]
    assert ras.all_cells(sizes).distinct().count() == 80


def test_chunks_follow_row_major_order(spark, monkeypatch):
    monkeypatch.setattr(ras, "LINE_BLOCK", 4)
    rows = [("a", 1990, i, j, 0.1 if (i * 11 + j) % 5 else None) for i in range(6) for j in range(11)]
    rows += [("b", 1990, 0, j, 0.2) for j in range(3)]
    df = spark.createDataFrame(rows, "city string, yr int, px_row int, px_col int, red double")
    df = df.withColumns({b: F.lit(0.1) for b in ("green", "blue", "nir")})
    out = ras.chunk_id(df, 10).where("city = 'a'").orderBy("px_row", "px_col").collect()
    assert [r.ordinal for r in out] == list(range(1, len(out) + 1))
    assert [r.chunk for r in out] == [i // 10 + 1 for i in range(len(out))]


def test_flat_index_round_trip(pixels):
    df = pixels({("a", 1990): [[1, 2, 3], [4, 5, 6]]})
    back = ras.unflatten(ras.flat_index(df, 3).drop("px_row", "px_col"), 3).orderBy("idx")
    assert [(r.px_row, r.px_col, r.idx) for r in back.collect()] == [(0, 0, 0), (0, 1, 1), (0, 2, 2), (1, 0, 3), (1, 1, 4), (1, 2, 5)]


def test_snap_is_the_inverse_of_centres(spark):
    px = spark.range(200).selectExpr("'austin' as city", "1990 as yr", "cast(id * 7 as int) as px_row", "cast(id * 3 as int) as px_col")
    pts = ras.pixel_centres(px, regions_df(spark)).withColumnsRenamed({"px_row": "r0", "px_col": "c0"})
    out = ras.snap_to_grid(pts, regions_df(spark))
    assert out.where("px_row != r0 or px_col != c0").isEmpty() and out.count() == 200


@pytest.mark.parametrize("lat", [30.1, 35.95, 41.0])
def test_a_gapless_scene_fills_every_cell_once(spark, lat):
    lon, span, size = -112.0, 0.02, (0.000325, 0.00027)
    box = spark.createDataFrame([("a", lon, lat, lon + span, lat + span)], "city string, lon_min double, lat_min double, lon_max double, lat_max double")
    n = int(span / size[1]) + 4
    shots = spark.range(n * n).selectExpr(
        "'a' as city", f"{lon - size[0] / 3} + (id % {n}) * {size[0]} as lon", f"{lat + span + size[1] / 3} - floor(id / {n}) * {size[1]} as lat",
        f"double({size[0]}) as lon_size", f"double({size[1]}) as lat_size",
    )
    cells = ras.fill_grid(shots, box)
    sizes = ras.grid_sizes(box, [0]).first()
    assert cells.count() == cells.select("px_row", "px_col").distinct().count() == sizes.height * sizes.width


def test_overlay_from_one_table_equals_the_join(spark):
    px = spark.range(400).selectExpr(
        "'a' as city", "1990 as yr", "cast(id / 20 as int) as px_row", "cast(id % 20 as int) as px_col",
        "id / 400 as red", "if(id % 7 = 0, null, id / 500) as green", "id / 600 as blue", "cast(id % 2 as int) as urban_class",
    )
    one = ras.overlay(px)
    two = ras.overlay(px.drop("urban_class"), px)
    assert one.exceptAll(two.select(*one.columns)).isEmpty() and one.count() == two.count() == 400
    v = np.array([x for r in px.collect() for x in (r.red, r.green, r.blue) if x is not None], dtype=float)
    lo, hi = np.percentile(v, 2), np.percentile(v, 98)
    row = one.where("px_row = 10 and px_col = 1").first()
    assert row.red == pytest.approx((201 / 400 - lo) / (hi - lo)) and row.over_a == 0.1
