"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build_session(app: str = "groundshift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Adaptive execution sizes the shuffle partitions and splits skewed joins.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a master with all its executors in one process may fall back to a
    temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


@cache
def _local_dir() -> str:
    path = tempfile.mkdtemp(prefix="groundshift-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


@cache
def _own_dir(base: str, context) -> str:
    """A folder of this application in the shared one, deleted with all in it when the application ends."""
    path = f"{base}/groundshift-{uuid.uuid4().hex}"
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(context._jsc.hadoopConfiguration())
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{_own_dir(shared_dir(spark), spark.sparkContext)}/{name}-{uuid.uuid4().hex}"
