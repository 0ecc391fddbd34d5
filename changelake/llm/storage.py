"""Shared intermediate tables, and the package on the workers."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is missing, a session on this machine gets a temporary folder; a cluster is refused.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _OWN.setdefault(context.applicationId, tempfile.mkdtemp(prefix="spark-shared-"))
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go as soon as each is done."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def saved(df: DataFrame, path: str, compression: str = "zstd") -> DataFrame:
    """The rows written as Parquet and read again; the shuffles behind them are gone then."""
    spark = df.sparkSession
    with tidy(spark):
        df.write.mode("overwrite").option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The rows written as Parquet to the shared folder and read again.

    Cuts the lineage: what follows survives lost executors and doesn't compute the rows twice.
    """
    return saved(df, shared_folder(df.sparkSession, name), compression)


class Scratch:
    """Intermediate tables of one run, in a folder of their own, each to be deleted after its last reader."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.folder = spark, shared_folder(spark, name)

    def written(self, df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
        return saved(df, f"{self.folder}/{name}", compression)

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, f"{self.folder}/{name}")


def _folder(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, in whatever store the path names."""
    files, at = _folder(spark, path)
    return files.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store the path names; none is fine."""
    files, at = _folder(spark, path)
    files.delete(at, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_changelake_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-package-"), "changelake_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for file in names:
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._changelake_shipped = True
