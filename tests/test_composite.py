import random
import statistics
from datetime import date

from pyspark.sql import functions as F

from groundshift.operators import composite as comp, medians
from groundshift.sources.dims import grid_df

OBS = "city string, acq_date date, px_row int, px_col int, sr_b1 int, sr_b2 int, sr_b3 int, sr_b4 int, sr_b5 int, qa_pixel int"


def obs(spark, rows):
    return spark.createDataFrame(rows, OBS)


def test_even_odd_and_cloudy_stacks(spark):
    day = date(1990, 5, 1)
    rows = [("a", day, 0, 0, v, v, v, v, v, 64) for v in (10, 30, 20)]
    rows += [("a", day, 0, 1, v, v, v, v, v, 64) for v in (10, 20)]
    rows += [("a", day, 0, 2, 5, 5, 5, 5, 5, 8), ("a", day, 0, 2, 5, 5, 5, 5, 5, 16)]
    got = {r.px_col: r.red for r in comp.build_composites(obs(spark, rows)).collect()}
    assert abs(got[0] - (20 * 2.75e-5 - 0.2)) < 1e-12
    assert abs(got[1] - (15 * 2.75e-5 - 0.2)) < 1e-12
    assert got[2] is None and len(got) == 3


def test_only_the_sensor_of_the_epoch_counts(spark):
    rows = [("a", date(2000, 5, 1), 0, 0, v, v, v, v, v, 0) for v in (10, 90)]
    mixed = obs(spark, rows).withColumn("collection", F.when(F.col("sr_b1") == 10, "LT05").otherwise("LE07"))
    out = comp.build_composites(mixed).collect()
    assert len(out) == 1 and abs(out[0].red - (10 * 2.75e-5 - 0.2)) < 1e-12


def test_sensor_bands_per_epoch(spark):
    rows = [("a", date(y, 5, 1), 0, 0, 1, 2, 3, 4, 5, 0) for y in (1990, 2020)]
    out = {r.yr: r for r in comp.build_composites(obs(spark, rows)).collect()}
    dn = lambda v: round((v + 0.2) / 2.75e-5)
    assert [dn(v) for v in (out[1990].red, out[1990].green, out[1990].blue, out[1990].nir)] == [3, 2, 1, 4]
    assert [dn(v) for v in (out[2020].red, out[2020].green, out[2020].blue, out[2020].nir)] == [4, 3, 2, 5]


def test_one_pixel_with_a_third_of_all_rows(spark):
    rng = random.Random(7)
    rows = [(0 if rng.random() < 0.33 else rng.randrange(1, 60), rng.choice([None, *range(50)]), rng.randrange(1000)) for _ in range(6000)]
    df = spark.createDataFrame(rows, "k int, a int, b int")
    out = comp.median_by_pixel(df, ["a", "b"], ["k"]).collect()
    assert len(out) == len({r[0] for r in rows})
    for r in out:
        for i, name in ((1, "a"), (2, "b")):
            stack = [x[i] for x in rows if x[0] == r.k and x[i] is not None]
            assert r[name] == (statistics.median(stack) if stack else None)


def test_deep_stacks_are_counted_not_gathered(spark):
    """Every stack as a deep one, some, and none: the same medians, by hash aggregates alone."""
    rng = random.Random(11)
    rows = [(rng.choice("abc"), 0 if rng.random() < 0.4 else rng.randrange(30), rng.choice([None, *range(-400, 400, 7)]), rng.randrange(65536)) for _ in range(5000)]
    rows += [("d", 1, None, 5)] * 40 + [("d", 1, None, 6)] * 40
    df = spark.createDataFrame(rows, "g string, k int, a int, b int")
    halves = df.withColumns({"a": F.col("a") / 8, "b": F.col("b") / 1000})
    for deep, share in ((1, 1), (60, 1), (10**9, 1)):
        for table, scale in ((df, (1, 1)), (halves, (8, 1000))):
            found = medians.medians(table, ["a", "b"], ["g", "k"], deep, share)
            text = found._jdf.queryExecution().executedPlan().toString()
            assert "ObjectHashAggregate" not in text and "SortAggregate" not in text
            out = {(r.g, r.k): (r.a, r.b) for r in found.collect()}
            assert set(out) == {r[:2] for r in rows}
            for key, got in out.items():
                for i in (0, 1):
                    stack = [r[2 + i] / scale[i] for r in rows if r[:2] == key and r[2 + i] is not None]
                    assert got[i] == (statistics.median(stack) if stack else None)


def test_state_of_a_deep_stack_is_bounded(spark):
    """A stack of 200,000 values reaches the shuffle as a count per bucket and task."""
    df = spark.range(200_000).selectExpr("1 as k", "cast(pmod(hash(id), 65536) as int) as a")
    found = medians.medians(df, ["a"], ["k"])
    assert medians.deep_stacks(df, ["k"]).count() == 1
    assert found.first().a == statistics.median(r.a for r in df.select("a").toLocalIterator())
    rows = [int(x) for x in _shuffled(found)]
    assert rows and max(rows) <= 8 * 2 * 256


def _shuffled(df):
    """Rows written by every exchange of a plan that has run."""

    def walk(node):
        if node.nodeName() == "Exchange":
            yield node.metrics().apply("shuffleRecordsWritten").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            yield from walk(node.executedPlan())
            return
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            yield from walk(node.plan())
        kids = node.children()
        for i in range(kids.size()):
            yield from walk(kids.apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def test_epoch_windows_are_half_open_and_may_overlap(spark):
    days = [date(1988, 12, 31), date(1989, 1, 1), date(1991, 12, 30), date(1991, 12, 31), date(2000, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "acq_date date")
    got = {(str(r.acq_date), r.yr) for r in comp.assign_epoch(df).collect()}
    assert got == {("1989-01-01", 1990), ("1991-12-30", 1990), ("2000-01-01", 2000)}
    both = comp.assign_epoch(df, [1990, 1991]).where("acq_date = date '1991-12-30'")
    assert sorted(r.yr for r in both.collect()) == [1990, 1991]


def test_region_join_against_brute_force(spark):
    rng = random.Random(3)

    def box(size):
        x, y = rng.choice([rng.uniform(-6, 6), rng.randrange(-6, 6)]), rng.choice([rng.uniform(-6, 6), rng.randrange(-6, 6)])
        return (float(x), float(y), float(x + rng.choice([1.0, rng.uniform(0, size)])), float(y + rng.uniform(0, size)))

    scenes = [(i, *box(3)) for i in range(300)]
    regions = [(f"r{i}", *box(2)) for i in range(25)]
    cols = "lon_min double, lat_min double, lon_max double, lat_max double"
    out = comp.scenes_by_region(
        spark.createDataFrame(scenes, f"scene_id int, {cols}"), spark.createDataFrame(regions, f"city string, {cols}")
    )
    got = sorted((r.scene_id, r.city) for r in out.collect())
    want = sorted(
        (s[0], r[0]) for s in scenes for r in regions if s[1] <= r[3] and s[3] >= r[1] and s[2] <= r[4] and s[4] >= r[2]
    )
    assert got == want and want


def test_boxes_of_all_sizes_and_across_the_date_line(spark):
    rng = random.Random(5)

    def box():
        x, y, size = rng.uniform(-180, 180), rng.uniform(-85, 80), rng.choice([0, 1e-5, 0.01, 1, 40])
        if rng.random() < 0.1:
            return (-180.0, -90.0, 180.0, 90.0)
        x2 = x + rng.uniform(0, size)
        return (x, y, x2 if x2 <= 180 else x2 - 360, min(90.0, y + rng.uniform(0, size)))

    def spans(b):
        return [(b[0], b[2])] if b[0] <= b[2] else [(b[0], 180.0), (-180.0, b[2])]

    def meet(a, b):
        return a[1] <= b[3] and a[3] >= b[1] and any(p[0] <= q[1] and p[1] >= q[0] for p in spans(a) for q in spans(b))

    scenes, regions = [(i, *box()) for i in range(250)], [(f"r{i}", *box()) for i in range(40)]
    scenes += [(900, 170.0, 0.0, -170.0, 1.0), (901, -180.0, -90.0, 180.0, 90.0), (902, None, 0.0, 1.0, 1.0)]
    regions += [("line", 175.0, 0.5, -175.0, 2.0), ("globe", -180.0, -90.0, 180.0, 90.0), ("dot", 5.0, 5.0, 5.0, 5.0)]
    cols = "lon_min double, lat_min double, lon_max double, lat_max double"
    left, right = spark.createDataFrame(scenes, f"scene_id int, {cols}"), spark.createDataFrame(regions, f"city string, {cols}")
    got = sorted((r.scene_id, r.city) for r in comp.scenes_by_region(left, right).collect())
    assert got == sorted((s[0], r[0]) for s in scenes for r in regions if s[1] is not None and meet(s[1:], r[1:]))
    cells = comp._cells(comp._split(left.dropna(), "lon_min", "lon_max", "_s"), ("_s_lo", "_s_hi"), ("lat_min", "lat_max"), 1, list(range(-10, 10)), True)
    assert cells.groupBy("scene_id", "_s", "role", "level").count().agg(F.max("count")).first()[0] <= 4


def test_observations_land_on_every_region_their_scene_meets(spark):
    boxes = "lon_min double, lat_min double, lon_max double, lat_max double"
    regions = spark.createDataFrame([("a", 0.0, 0.0, 1.0, 1.0), ("b", 0.5, 0.0, 1.5, 1.0)], f"city string, {boxes}")
    scenes = spark.createDataFrame(
        [(1, "LT05", date(1990, 1, 1), 0.0, 0.0, 1.0, 1.0), (2, "LE07", date(2010, 1, 1), 5.0, 5.0, 6.0, 6.0)],
        f"scene_id int, collection string, acq_date date, {boxes}",
    )
    shots = spark.createDataFrame([(1, 0.75, 0.9999, 7), (1, 0.25, 0.5, 8), (1, -3.0, 0.5, 9), (2, 0.75, 0.5, 1)], "scene_id int, lon double, lat double, sr_b1 int")
    got = sorted((r.city, r.sr_b1, r.px_row, r.px_col, r.collection) for r in comp.grid_observations(shots, scenes, regions).collect())
    assert [g[:2] for g in got] == [("a", 7), ("a", 8), ("b", 7)]
    assert got[0][2] == 0 and got[0][3] == int(0.75 / (30 / 111319.49)) and got[2][3] == int(0.25 / (30 / 111319.49))
    assert {g[4] for g in got} == {"LT05"}


def test_jobs_skip_what_has_no_scene(spark):
    counts = spark.createDataFrame([("austin", 1990, 3)], "city string, yr int, n_scenes long")
    jobs = comp.composite_jobs(grid_df(spark).select("city", "yr"), counts)
    assert jobs.count() == 16 and jobs.where(F.col("action") == "build").count() == 1
