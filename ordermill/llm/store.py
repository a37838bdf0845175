"""Intermediate tables under the folder that ``spark.checkpoint.dir`` names.

They outlive lost executors, are read as often as needed, and cut lineage. Those written within ``scratch()`` are
deleted when it ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ordermill.session import fresh_path, ship

__all__ = ["deleted", "dropped", "scratch", "ship", "written"]

_open: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables written meanwhile, unless they were written to be kept."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            deleted(spark, path)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again; with ``keep`` it outlives a ``scratch()``."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    if _open and not keep:
        _open[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing needs any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        deleted(df.sparkSession, folder)


def deleted(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared storage."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
