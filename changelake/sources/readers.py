"""Batch and streaming readers, and the folder for intermediate files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.sources.schemas import WRITE_LOG


def table_reader(spark: SparkSession, path: str) -> Callable[[], DataFrame]:
    """Reads a Parquet table anew at every call; its schema is found out once."""
    schema: list[T.StructType] = []

    def read() -> DataFrame:
        if schema:
            return spark.read.schema(schema[0]).parquet(path)
        df = spark.read.parquet(path)
        schema.append(df.schema)
        return df

    return read


def read_log_stream(
    spark: SparkSession,
    path: str,
    *,
    schema: T.StructType = WRITE_LOG,
    max_files: int = 10,
    max_bytes: str | None = None,
    after_id: int | None = None,
) -> DataFrame:
    """The write log as a stream of new files, at most ``max_files`` (or ``max_bytes``) per micro-batch.

    ``after_id`` starts behind a position of the log; row groups before it are skipped.
    """
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(path)
    return stream if after_id is None else stream.where(F.col("id") > after_id)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder for a job's own files, in the shared folder the cluster names.

    Where ``spark.checkpoint.dir`` is unset, a session on this machine alone, as in tests, has a temporary folder; on
    a cluster each executor would write to its own disk, so that is refused.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return tempfile.mkdtemp(prefix=f"{name}-")
