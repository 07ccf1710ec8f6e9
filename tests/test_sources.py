import gzip
import os
import subprocess
import sys
import time
from types import SimpleNamespace

import pytest

from groundshift.session import scratch_path, shared_dir
from groundshift.sources.tables import METRICS_SCHEMA, audit, read_metrics, read_samples_csv, read_samples_tolerant


def test_tolerant_scan(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)

    put("a_good.csv", "year,subclass,red,extra\n1990,urban,0.1,z\n2000,water,bad,z\n")
    put("b_order.csv", "red,year,subclass\n0.5,2010,farmland\n")
    put("c_quoted.csv", '"year","subclass","red"\n2020,"bare, soil",0.7\n')
    put("d_short.csv", "year,subclass\n1990,urban\n")
    put("e_empty.csv", "")
    put("f_header_only.csv", "year,subclass,red\n")
    whole = gzip.compress(b"year,subclass,red\n" + b"1990,urban,0.9\n" * 5000)
    (tmp_path / "g_broken.csv.gz").write_bytes(whole[:10] + b"\x00" * 40)
    out = read_samples_tolerant(spark, str(tmp_path / "*"), ["year", "subclass", "red"])
    assert sorted(tuple(r) for r in out.collect()) == [
        ("1990", "urban", "0.1"), ("2000", "water", "bad"), ("2010", "farmland", "0.5"), ("2020", "bare, soil", "0.7"),
    ]
    none = read_samples_tolerant(spark, str(tmp_path / "d_*"), ["year", "subclass", "red"])
    assert none.isEmpty() and none.columns == ["year", "subclass", "red"]


def test_unfit_files_leave_whole(spark, tmp_path):
    body = "year,subclass,red\n" + "1990,urban,0.9\n" * 3000
    files = {
        "good.csv": body.encode(),
        "good.csv.gz": gzip.compress(body.encode()),
        "no_last_break.csv.gz": gzip.compress(body.encode()[:-1]),
        "crlf.csv": b"\xef\xbb\xbf" + body.replace("\n", "\r\n").encode(),
        "short_rows.csv": b"\nyear,subclass,red\n\n2000,water\n",
        "ragged.csv": body.encode() + b"1990,urban,0.9,more\n",
        "quoted_comma.csv": b'year,subclass,red\n2010,"a, b",0.1\n',
        "cut.csv.gz": gzip.compress(body.encode())[:-12],
        "cut_early.csv.gz": gzip.compress(os.urandom(50_000).hex().encode())[:20_000],
        "latin.csv": body.encode() + b"1990,caf\xe9,0.9\n",
        "open_quote.csv": body.encode() + b'1990,"urban,0.9\n',
        "no_column.csv": b"year,red\n1990,0.9\n",
        "blank.csv": b"\n\n",
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    verdicts = {os.path.basename(r.path): r.verdict for r in audit(spark, str(tmp_path), ["year", "subclass", "red"]).collect()}
    bad = {"ragged.csv": "ragged", "cut.csv.gz": "damaged", "cut_early.csv.gz": "damaged", "latin.csv": "damaged", "open_quote.csv": "damaged", "no_column.csv": "columns", "blank.csv": "empty"}
    assert {n: verdicts.get(n, "damaged") for n in files} == {n: bad.get(n, "good") for n in files}
    out = [tuple(r) for r in read_samples_tolerant(spark, str(tmp_path), ["red", "year", "subclass"]).collect()]
    assert sorted(set(out), key=str) == [("0.1", "2010", "a, b"), ("0.9", "1990", "urban"), (None, "2000", "water")]
    assert len(out) == 4 * 3000 + 2


def test_inferred_and_declared_types(spark, tmp_path):
    (tmp_path / "s.csv").write_text("red,label,city\n0.5,1,austin\n")
    path = str(tmp_path / "s.csv")
    assert read_samples_csv(spark, path).dtypes == [("red", "double"), ("label", "int"), ("city", "string")]
    assert read_samples_csv(spark, path, "red string, label double, city string").first()[1] == 1.0


def test_absent_metrics_are_empty_but_typed(spark):
    out = read_metrics(spark, scratch_path(spark, "nothing"))
    assert out.isEmpty() and out.columns == [p.split()[0] for p in METRICS_SCHEMA.split(", ")]


def test_scratch_is_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + os.sep)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def fake_session(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master))


def test_a_cluster_must_name_its_shared_folder():
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:7077"):
        with pytest.raises(ValueError):
            shared_dir(fake_session(master))
    assert shared_dir(fake_session("yarn", "hdfs://x/y")) == "hdfs://x/y"
    assert shared_dir(fake_session("local[4]")) == shared_dir(fake_session("local[4]"))


def test_no_scratch_is_left():
    code = """
from groundshift.session import build_session, scratch_path
spark = build_session("left", "local[1]", **{"spark.ui.enabled": "false"})
path = scratch_path(spark, "x")
spark.range(3).write.parquet(path)
print("FOLDER", path)
spark.stop()
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=os.getcwd())
    folder = out.stdout.split("FOLDER ")[1].split()[0].removeprefix("file:")
    for _ in range(100):  # the JVM cleans up as it ends
        if not os.path.exists(folder):
            break
        time.sleep(0.1)
    assert not os.path.exists(folder)
