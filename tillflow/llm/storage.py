"""Results written on the way, so that later steps read them instead of computing them again."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.sources.workspace import fresh_folder, remove_folder


# What a write has shuffled is removed as it ends; nothing reads it later.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folders written inside `scratch`.
_FOLDERS: ContextVar[list[str] | None] = ContextVar("folders", default=None)


def written(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """The rows of df, written once as Parquet to the storage that all executors share.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before. codec: for whole
    texts that stay until the last reader of a result is done, a denser one.
    """
    path = fresh_folder(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        conf.set(_CLEANUP, before)
        if _FOLDERS.get() is not None:
            _FOLDERS.get().append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove what `written` stored for df, once all that is read from it is written too."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        remove_folder(df.sparkSession, folder)


@contextmanager
def scratch(spark) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Remove what is `written` inside at the end, but for frames given to the function it yields."""
    folders, kept = [], set()

    def keep(df: DataFrame) -> DataFrame:
        kept.update(file.rpartition("/")[0].rpartition("/")[2] for file in df.inputFiles())
        return df

    token = _FOLDERS.set(folders)
    try:
        yield keep
    finally:
        _FOLDERS.reset(token)
        for folder in folders:
            if folder.rpartition("/")[2] not in kept:
                remove_folder(spark, folder)
            elif _FOLDERS.get() is not None:
                _FOLDERS.get().append(folder)


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def every_column(df: DataFrame, prefix: str = "") -> list[Column]:
    """All columns by name, whatever characters their names hold."""
    return [F.col(prefix + "`" + name.replace("`", "``") + "`") for name in df.columns]


def text_key(text: Column) -> Column:
    """Equal for equal texts only."""
    return F.md5(F.encode(text, "UTF-8"))
