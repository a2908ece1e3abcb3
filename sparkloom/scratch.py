"""Intermediate tables that outlive the loss of an executor.

Iterative operators cut their lineage by writing a Parquet table to the folder
the cluster names in ``spark.checkpoint.dir``. Parquet is preferred to
``DataFrame.checkpoint`` because it is columnar and compressed, so a cut costs
a fraction of the disk that serialised rows need.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """The shared scratch folder: the session's own setting, or a temporary folder in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = found.get() if found.isDefined() else None
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="sparkloom-")
    return _OWN[app]


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` to a new scratch table and read it back."""
    spark = df.sparkSession
    path = f"{root(spark)}/sparkloom-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`cut` that nothing will read again."""
    spark = df.sparkSession
    for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/sparkloom-" in file:
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_side(table: DataFrame, limit: int = 8 << 20) -> DataFrame:
    """A table made by :func:`cut`, marked for broadcast if its files hold ``limit`` bytes at most; else as it is, for a shuffled join."""
    from pyspark.sql import functions as F

    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(table) if size <= limit else table
