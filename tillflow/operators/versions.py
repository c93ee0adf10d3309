"""Compaction of an event table by versions, which readers never notice.

The rows of an hour are written to a new version beside the table; then one statement tells the catalog
the hour's new place. A reader finds the old place or the new one, each with all rows; nothing is
renamed, so object stores do as well. Old versions are removed later, when no reader can be in them.

Landing may go on meanwhile. A version lists the landed files whose rows it holds. A landed file that came
to an hour's old place too late to be in that list is a straggler: it stays, and the next compaction
takes it in. A version that was never switched to, as its run was cut off, counts for nothing.

One compaction of a table runs at a time.
"""

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.operators.maintenance import TARGET_FILE_BYTES, laid_out
from tillflow.sources.workspace import file_system, remove_folder
from tillflow.streaming.event_table import LANDED, hour_places, table_root
from tillflow.streaming.hours import (
    Hour,
    hour_folder,
    hour_folders,
    hour_of,
    mark,
    partition,
    statuses,
    take_off,
    touched_hours,
    touched_list,
)
from tillflow.streaming.landing import PARTITIONS, table_schema

_TAKEN_SCHEMA = "event_date date, event_hour int, name string"


@dataclass(frozen=True)
class File:
    path: str
    name: str
    bytes: int


@dataclass(frozen=True)
class HourFiles:
    """Files of an hour at its current place, and stragglers at others."""

    hour: Hour
    place: str
    current: tuple[File, ...]
    stragglers: tuple[File, ...]

    def wanted(self, target_file_bytes: int) -> int:
        """How many files the hour is worth, one at least."""
        size = sum(file.bytes for file in (*self.current, *self.stragglers))
        return max(1, -(-size // target_file_bytes))


def _versions(root: str) -> str:
    return f"{root}_versions"


def _taken_list(root: str, version: int) -> str:
    return f"{_versions(root)}/{version}_taken"


def retired_list(root: str) -> str:
    """Where the hours are listed that have files at an old place."""
    return f"{root}_retired"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    names = [entry.getPath().getName() for entry in statuses(spark, _versions(root))]
    return sorted(int(name) for name in names if name.isdigit())


def _plain(path: str) -> str:
    """A path as one spells it, whatever the number of slashes behind its scheme."""
    scheme, colon, rest = path.rpartition(":")
    return f"{scheme}{colon}/{rest.lstrip('/')}" if colon else path


def _version_at(root: str, place: str) -> int | None:
    """Number of the version at a place, None for the table's own folder."""
    head = _plain(_versions(root)) + "/"
    place = _plain(place)
    return int(place[len(head) :].split("/")[0]) if place.startswith(head) else None


def _data_files(spark: SparkSession, folder: str) -> list[File]:
    return [
        File(f"{folder}/{name}", name, entry.getLen())
        for entry in statuses(spark, folder)
        if not (name := entry.getPath().getName()).startswith(("_", "."))
    ]


def _taken(spark: SparkSession, root: str, places: dict[Hour, str]) -> dict[Hour, set[str]]:
    """Names of the landed files whose rows are at the current place of each hour."""
    found: dict[Hour, set[str]] = {hour: set() for hour in places}
    numbers = {_version_at(root, place) for place in places.values()} - {None}
    for number in sorted(numbers):
        own = {hour for hour, place in places.items() if _version_at(root, place) == number}
        for row in spark.read.schema(_TAKEN_SCHEMA).parquet(_taken_list(root, number)).collect():
            if (row.event_date, row.event_hour) in own:
                found[row.event_date, row.event_hour].add(row.name)
    return found


def _old_places(root: str, numbers: list[int], hour: Hour, place: str) -> list[str]:
    bases = [root, *[f"{_versions(root)}/{number}" for number in numbers]]
    return [f for f in (hour_folder(b, hour) for b in bases) if _plain(f) != _plain(place)]


def _look_up(spark: SparkSession, table: str, root: str, hours: list[Hour]) -> list[HourFiles]:
    places = hour_places(spark, table, hours)
    taken = _taken(spark, root, places)
    numbers = _numbers(spark, root)
    return [
        HourFiles(
            hour,
            place,
            tuple(_data_files(spark, place)),
            tuple(
                file
                for folder in _old_places(root, numbers, hour, place)
                for file in _data_files(spark, folder)
                if file.name.startswith(LANDED) and file.name not in taken[hour]
            ),
        )
        for hour, place in places.items()
    ]


def _rows_of(spark: SparkSession, files: list[File]) -> DataFrame:
    """Rows of files, with the hour that their folder says."""
    path = F.col("_metadata.file_path")
    fields = [field for field in table_schema() if field.name not in PARTITIONS]
    return spark.read.schema(T.StructType(fields)).parquet(*[file.path for file in files]).select(
        *[field.name for field in fields],
        F.regexp_extract(path, "event_date=([0-9-]+)", 1).cast("date").alias("event_date"),
        F.regexp_extract(path, "event_hour=([0-9]+)", 1).cast("int").alias("event_hour"),
    )


def _per_hour(rows: DataFrame) -> set:
    return {tuple(row) for row in rows.groupBy(PARTITIONS).agg(F.count("*")).collect()}


def switch(spark: SparkSession, table: str, root: str, hour: Hour, place: str) -> None:
    """The one step that readers notice, all rows at once."""
    mark(spark, retired_list(root), hour, "switched")
    spark.sql(f"ALTER TABLE {table} {partition(hour)} SET LOCATION '{place}'")


def compact_hours(
    spark: SparkSession,
    table: str,
    hours: list[Hour],
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> list[Hour]:
    """Bring hours to as few files as their bytes need, in one job; returns those rewritten."""
    root = table_root(spark, table)
    todo = [
        found
        for found in _look_up(spark, table, root, hours)
        if found.stragglers or len(found.current) > found.wanted(target_file_bytes)
    ]
    if not todo:
        return []
    number = max(_numbers(spark, root), default=0) + 1
    base = f"{_versions(root)}/{number}"
    rows = _rows_of(spark, [f for found in todo for f in (*found.current, *found.stragglers)])
    sizes = {found.hour: found.wanted(target_file_bytes) for found in todo}
    laid_out(rows, sizes).write.mode("overwrite").partitionBy(*PARTITIONS).parquet(base)
    if _per_hour(rows) != _per_hour(_rows_of(spark, _written_files(spark, base))):
        remove_folder(spark, base)
        raise RuntimeError(f"hours of {table} changed while they were compacted; none was switched")
    before = _taken(spark, root, {found.hour: found.place for found in todo})
    names = [
        (*found.hour, name)
        for found in todo
        for name in sorted(
            before[found.hour]
            | {f.name for f in (*found.current, *found.stragglers) if f.name.startswith(LANDED)}
        )
    ]
    taken = spark.createDataFrame(names, _TAKEN_SCHEMA)
    taken.coalesce(1).write.mode("overwrite").parquet(_taken_list(root, number))
    for found in todo:
        switch(spark, table, root, found.hour, hour_folder(base, found.hour))
    spark.catalog.refreshTable(table)
    return [found.hour for found in todo]


def _written_files(spark: SparkSession, base: str) -> list[File]:
    return [f for folder in hour_folders(spark, base) for f in _data_files(spark, folder)]


def compact_touched(
    spark: SparkSession,
    table: str,
    closed_before: datetime | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> list[Hour]:
    """Compact the hours that landing touched, of any age, but for those that are still open."""
    touched = touched_hours(spark, table_root(spark, table), closed_before)
    done = compact_hours(spark, table, list(touched), target_file_bytes)
    take_off(spark, touched)
    return done


def remove_old_versions(spark: SparkSession, table: str, now: datetime, keep: timedelta) -> int:
    """Remove files at old places of hours that were switched `keep` ago or earlier; returns how many.

    Readers that began before a switch need its old place as long as they run. Stragglers stay, and
    their hour is put on the list of touched hours again.
    """
    root = table_root(spark, table)
    numbers, removed = _numbers(spark, root), 0
    border = (now - keep).timestamp() * 1000
    retired = [hour_of(folder) for folder in hour_folders(spark, retired_list(root))]
    places = hour_places(spark, table, retired)
    taken = _taken(spark, root, places)
    for hour, place in places.items():
        listed = hour_folder(retired_list(root), hour)
        marks = statuses(spark, listed)
        if any(entry.getModificationTime() > border for entry in marks):
            continue
        stays = False
        for folder in _old_places(root, numbers, hour, place):
            for file in _data_files(spark, folder):
                if file.name.startswith(LANDED) and file.name not in taken[hour]:
                    mark(spark, touched_list(root), hour, "straggler")
                    stays = True
                    continue
                system, path = file_system(spark, file.path)
                removed += bool(system.delete(path, False))
            if not _data_files(spark, folder):
                remove_folder(spark, folder)
        if not stays:
            remove_folder(spark, listed)
    return removed
