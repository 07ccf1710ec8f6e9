import hashlib
import random

from pyspark.sql import functions as F

from groundshift.operators import sampling as s


def md5(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


def test_smallest_by_hash_against_brute_force(spark):
    rows = [(i, "big" if i % 3 else "small") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, g string")
    for n in (0, 1, 700, 1500, 5000):
        got = {r.id for r in s.smallest_by_hash(df, ["g"], "id", F.lit(n), F.lit(9)).collect()}
        want = set()
        for g in ("big", "small"):
            want |= set(sorted((i for i, k in rows if k == g), key=lambda i: md5(9, i))[:n])
        assert got == want


def test_quota_per_class(spark):
    rows = [(i, "a", 1990, 0, i, random.Random(i).choice(["urban", "water", "snow"])) for i in range(900)]
    df = spark.createDataFrame(rows, "point_id int, city string, yr int, px_row int, px_col int, subclass string")
    out = s.sample_n_per_class(df, quotas={"urban": (1, 40, 1), "water": (0, 20, 5)})
    counts = {(r.subclass, r.label): r["count"] for r in out.groupBy("subclass", "label").count().collect()}
    assert counts == {("urban", 1): 40, ("water", 0): 20}


def test_sampling_does_not_depend_on_the_partitioning(spark):
    df = spark.range(5000).selectExpr("id as sample_id", "cast(id % 4 = 0 as int) as label")
    a = s.balance_downsample(df.repartition(3))
    b = s.balance_downsample(df.repartition(7, "label"))
    assert a.exceptAll(b).isEmpty() and a.count() == b.count() == 2500


def test_split_shares_at_their_ends(spark):
    df = spark.range(1000).withColumnRenamed("id", "sample_id")
    train = [s.hash_split(df, train=share).where("part = 'train'").count() for share in (0.0, 1e-9, 0.5, 1.0 - 1e-9, 1.0)]
    assert train[0] == train[1] == 0 and 400 < train[2] < 600 and train[3] == train[4] == 1000


def test_balance_cases(spark):
    one = spark.range(10).selectExpr("id as sample_id", "0 as label")
    assert s.balance_downsample(one).count() == 10
    df = spark.range(4000).selectExpr("id as sample_id", "cast(id % 8 = 0 as double) as label")
    sizes = {r.label: r["count"] for r in s.balance_downsample(df).groupBy("label").count().collect()}
    assert sizes == {0.0: 500, 1.0: 500}
    loose = {r.label: r["count"] for r in s.balance_downsample(df, exact=False).groupBy("label").count().collect()}
    assert loose[1.0] == 500 and 350 < loose[0.0] < 650


def test_split_is_a_partition(spark):
    df = spark.range(10_000).withColumnRenamed("id", "sample_id")
    counts = {r.part: r["count"] for r in s.hash_split(df).groupBy("part").count().collect()}
    assert sum(counts.values()) == 10_000 and 7_800 < counts["train"] < 8_200


def test_clean(spark):
    rows = [
        ("1", "0.5", "1", "x", 2000),
        ("1", "0.5", "1", "x", 2000),  # copy
        ("2", "bad", "1", "x", 2000),
        ("3", "NaN", "1", "x", 2000),
        ("4", "0.5", "2", "x", 2000),
        ("5", None, "0", "x", 2000),
        ("6", "0.25", "0", "x", 2000),
    ]
    df = spark.createDataFrame(rows, "id string, red string, label string, city string, yr int")
    out = s.clean_samples(df, city="riverside", year=1990, features=["red"]).orderBy("id").collect()
    assert [(r.id, r.red, r.label, r.city, r.yr) for r in out] == [("1", 0.5, 1.0, "riverside", 1990), ("6", 0.25, 0.0, "riverside", 1990)]
    assert "city" not in s.standardise_keys(df.drop("city"), city="austin").columns


def test_normalise(spark):
    rows = [("1990.0", " Urban ", "0.5"), ("x", "water", "1"), (None, "water", "1"), ("2000", None, "NaN"), ("9e99", "water", "1")]
    out = s.normalise_samples(spark.createDataFrame(rows, "yr string, subclass string, red string"), ["red"]).collect()
    assert sorted((r.yr, r.subclass, r.red) for r in out) == [(1990, "urban", 0.5), (2000, None, None)]


def test_points_on_masked_or_absent_pixels_drop_out(spark):
    px = spark.createDataFrame([("a", 1990, 0, 0, 0.1), ("a", 1990, 0, 1, None)], "city string, yr int, px_row int, px_col int, red double")
    pts = spark.createDataFrame(
        [(1, "a", 1990, 0, 0), (2, "a", 1990, 0, 0), (3, "a", 1990, 0, 1), (4, "a", 1990, 9, 9)],
        "point_id int, city string, yr int, px_row int, px_col int",
    )
    assert sorted(r.point_id for r in s.sample_points(px, pts, ["red"]).collect()) == [1, 2]
