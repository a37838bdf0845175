"""Where jobs may write intermediate tables."""

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="ordermill-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """Unused path under the shared folder."""
    return f"{shared_folder(spark)}/ordermill/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, where it isn't installed on them."""
    if spark.sparkContext.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="ordermill-code-")  # the driver serves the file as long as it runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/{root.name}.zip", "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(f"{folder}/{root.name}.zip")
    _shipped.add(spark.sparkContext.applicationId)


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept on shared storage, where it outlives lost executors.

    Parquet, so that later steps read only the columns and rows they need.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "settled")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile leaves no shuffle files behind, which else stay until the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
