"""Temporary folders for queries that write and read back."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: dict[str, str] = {}
_made: list[tuple[SparkSession, str]] = []


def temporary(spark: SparkSession, tag: str) -> str:
    """A fresh path in the folder that the cluster shares (``spark.checkpoint.dir``); one of this machine
    only where that is unset."""
    where, app = spark.sparkContext.getConf().get("spark.checkpoint.dir"), spark.sparkContext.applicationId
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = _own.setdefault(app, "file://" + tempfile.mkdtemp(prefix="skeinwright-"))
    path = f"{where.rstrip('/')}/skeinwright-{tag}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        with contextlib.suppress(Exception):
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
