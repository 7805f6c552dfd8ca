"""Intermediate tables in the shared folder.

``spark.checkpoint.dir`` names a folder that every executor reads.  Where it is
unset, local sessions use a temporary folder and others are refused, since their
executors would not see one.  Tables live in a folder of the application, which
goes when the driver ends; ``discard`` removes one earlier.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_known: set[str] = set()


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def shared_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if context.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        base = _own.setdefault(context.applicationId, "")
        base = base or "file://" + tempfile.mkdtemp(prefix="siltbed-")
        _own[context.applicationId] = base
    path = f"{base.rstrip('/')}/siltbed-{context.applicationId}"
    if path not in _known:
        fs, target = file_system(spark, path)
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        _known.add(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is run inside leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame, name: str = "t", codec: str = "zstd") -> DataFrame:
    """Write and read back, which ends the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._siltbed_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete the tables behind DataFrames made by ``cut`` once nothing reads them; other DataFrames are left alone."""
    for df in tables:
        path = getattr(df, "_siltbed_path", None)
        if path:
            fs, target = file_system(df.sparkSession, path)
            fs.delete(target, True)
