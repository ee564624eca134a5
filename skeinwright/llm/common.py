"""What the training-data operators share: the shared folder, written tables, batch bounds."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

_own: dict[str, str] = {}
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where that is unset and all runs on one machine (tests) a temporary folder is made and used.
    """
    where = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="skeinwright-")
    return _own[app]


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path under the shared folder that nothing else uses; removed when Python ends."""
    path = f"{shared_dir(spark)}/skeinwright-{tag}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder and read it back, with its path: lineage is cut, and a lost
    executor costs no recomputation of what lies before it."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    return written(df, tag)[0]


def quoted(name: str) -> str:
    """A column's name as an expression."""
    return "`" + name.replace("`", "``") + "`"


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """Names for working columns that no column of ``df`` has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    n = 0
    while any(f"_{s}{n}".lower() in taken for s in stems):
        n += 1
    return [f"_{s}{n}" for s in stems]


def release(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder, through Spark's file systems, once nothing reads it any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


class Remembered:
    """A bounded cache of two generations: when the young one is full it becomes the old one, and what
    is asked for again moves back, so frequent entries stay."""

    def __init__(self, size: int) -> None:
        self.size, self.young, self.old = size, {}, {}

    def missed(self, key: str):
        """The value if the old generation has it, else None; call it when ``young`` lacks the key."""
        found = self.old.get(key)
        if found is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        with contextlib.suppress(Exception):
            release(spark, path)


def bound_batches(spark: SparkSession, rows: int = 512, mb: int = 16) -> None:
    """Arrow batches of at most so many rows and MB, so that long texts don't fill a worker; workers get the package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    with contextlib.suppress(Exception):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def once(function, returns: str):
    """An Arrow function that the optimizer may not copy: a filter on its result would run it again, in
    further worker processes."""
    return F.arrow_udf(function, returns).asNondeterministic()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
