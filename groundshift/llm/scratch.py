"""Tables and files in the folder that all executors share."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from collections.abc import Callable

from pyarrow import fs as pafs
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import groundshift

from groundshift.session import scratch_path


@functools.cache
def _ship(context: SparkContext) -> None:
    top = os.path.dirname(groundshift.__file__)
    path = os.path.join(tempfile.mkdtemp(), "groundshift.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    out.write(at := os.path.join(folder, name), os.path.relpath(at, os.path.dirname(top)))
    context.addPyFile(path)


def shipped(fn: Callable) -> Callable:
    """``fn(spark, ...)`` with this package sent to the Python workers first, wherever they run."""

    @functools.wraps(fn)
    def call(spark: SparkSession, *args, **kwargs):
        _ship(spark.sparkContext)
        return fn(spark, *args, **kwargs)

    return call


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: the lineage ends there.

    A lost executor takes nothing with it, and whoever reads the table twice
    does not compute it twice.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder named by URI or plain path, and the path in it."""
    return pafs.FileSystem.from_uri(uri) if ":/" in uri else (pafs.LocalFileSystem(), uri)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def columns(df: DataFrame, names: list[str] | None = None) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in names or df.columns]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that tasks may write files to."""
    uri = scratch_path(spark, name)
    files, path = filesystem(uri)
    files.create_dir(path, recursive=True)
    return uri


def one_task_each(rows: DataFrame, n: int) -> DataFrame:
    """Rows that name files, dealt out so that every task opens one or two."""
    return rows.repartition(max(1, n))
