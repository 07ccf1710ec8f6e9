"""Every query of the subpackage on the smallest tables: SQL where there is some, else its contract."""

import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, differences
from groundshift.llm.queries import CHECKS, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), CHECKS[name]) is None


def test_all_are_registered():
    names = entry.queries()
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(names)


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op6_quality"](spark, sf).collect()
    labels = dict(duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    known = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in known) >= 0.93 * len(known)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, kept = docs, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, SF)
        assert rows.schema == docs.schema
        if name.startswith("SimHash"):
            kept = {r.doc_id for r in rows.collect()}
    mixed = [r.doc_id for r in rows.collect()]
    assert kept and set(mixed) <= kept and max(map(mixed.count, set(mixed))) <= 3
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(mixed)
    assert all(r.n_pieces == len(r.ids) for r in out)
