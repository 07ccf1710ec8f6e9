"""The bound on broadcasts."""

from groundshift.operators import small


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_small_table_is_kept_and_broadcast(spark):
    out = small.settle(spark.range(10).withColumnRenamed("id", "k"))
    assert "broadcast" in plan(out)
    assert out.count() == 10


def test_every_size_works_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr("groundshift.session.shared_dir", lambda s: 1 / 0)
    table, big = spark.range(10).withColumnRenamed("id", "k"), spark.range(20).withColumnRenamed("id", "k")
    for bound in (0, 5, 100):
        monkeypatch.setattr(small, "MAX_ROWS", bound)
        assert sorted(r.k for r in small.join_small(big, table, "k").collect()) == list(range(10))


def test_table_over_the_bound_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(small, "MAX_ROWS", 5)
    table = spark.range(10).withColumnRenamed("id", "k")
    out = small.settle(table)
    assert "broadcast" not in plan(out)
    assert out.count() == 10
    assert small.join_small(spark.range(20).withColumnRenamed("id", "k"), table, "k").count() == 10


def test_wide_rows_over_the_byte_bound_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(small, "MAX_BYTES", 100)
    out = small.settle(spark.range(100).selectExpr("id", "repeat('x', 50) as text"))
    assert "broadcast" not in plan(out) and out.count() == 100


def test_empty_table_keeps_its_columns(spark):
    out = small.settle(spark.range(0).selectExpr("id as k", "cast(id as string) as t"))
    assert out.columns == ["k", "t"] and out.isEmpty()
