"""Folders for data a job writes on the way."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def fresh_folder(spark: SparkSession, label: str) -> str:
    """Path of a new folder in the storage all executors share.

    That is the folder the cluster names in `spark.checkpoint.dir`. Where it is unset,
    a temporary folder is taken in a local test; on a cluster, where executors would each
    write to their own disk, it raises.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("on a cluster, spark.checkpoint.dir must name a shared folder")
        shared = f"file://{tempfile.mkdtemp(prefix='tillflow-')}"
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as that knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a job's own folder, if it is there."""
    system, place = file_system(spark, path)
    system.delete(place, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Remove what each write inside has shuffled as it ends; nothing reads it later."""
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup)
    spark.conf.set(cleanup, "true")
    try:
        yield
    finally:
        spark.conf.set(cleanup, before)


@contextmanager
def stored(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The rows of df worked out once, in a folder that all executors share, for the time inside."""
    spark = df.sparkSession
    place = fresh_folder(spark, label)
    try:
        with shuffles_removed(spark):
            df.write.parquet(place, compression="zstd")
        yield spark.read.schema(df.schema).parquet(place)
    finally:
        remove_folder(spark, place)
