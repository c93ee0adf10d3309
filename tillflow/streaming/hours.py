"""Hours of an event table: their folders, their names in the catalog, and lists of them."""

import re
from datetime import date, datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tillflow.sources.workspace import file_system, remove_folder

HOURS_PER_STATEMENT = 200
_HOUR_FOLDER = re.compile(r"event_date=(\d{4,}-\d\d-\d\d)/event_hour=(\d+)$")

Hour = tuple[date, int]


def partition(hour: Hour) -> str:
    return f"PARTITION (event_date = '{hour[0].isoformat()}', event_hour = {hour[1]})"


def hour_name(day: date, hour: int) -> str:
    return f"{day.isoformat()} {hour}"


def hour_key() -> Column:
    """`hour_name` of a row, from the partition columns alone, so that a filter prunes folders."""
    return F.concat_ws(" ", F.col("event_date").cast("string"), "event_hour")


def hour_folder(base: str, hour: Hour) -> str:
    return f"{base}/event_date={hour[0].isoformat()}/event_hour={hour[1]}"


def hour_of(folder: str) -> Hour:
    day, hour = _HOUR_FOLDER.search(folder.rstrip("/")).groups()
    return date.fromisoformat(day), int(hour)


def statuses(spark: SparkSession, folder: str) -> list:
    """What lies in a folder, nothing if there is none."""
    system, place = file_system(spark, folder)
    return list(system.listStatus(place)) if system.exists(place) else []


def hour_folders(spark: SparkSession, base: str) -> list[str]:
    """Folders of hours below a folder of dates."""
    return [
        f"{base}/{day.getPath().getName()}/{hour.getPath().getName()}"
        for day in statuses(spark, base)
        if day.getPath().getName().startswith("event_date=")
        for hour in statuses(spark, f"{base}/{day.getPath().getName()}")
    ]


def mark(spark: SparkSession, base: str, hour: Hour, name: str) -> None:
    """Put an hour on a list of hours: an empty file in its folder."""
    system, place = file_system(spark, f"{hour_folder(base, hour)}/{name}")
    system.create(place, True).close()


def touched_list(root: str) -> str:
    """Where the hours are listed that got files since they were last looked after."""
    return f"{root}_touched"


def touched_hours(
    spark: SparkSession, root: str, before: datetime | None = None
) -> dict[Hour, list[str]]:
    """Hours, of those that begin before a time, that are on the list, each with its marks."""
    found = {}
    for folder in hour_folders(spark, touched_list(root)):
        day, hour = hour_of(folder)
        if before is None or datetime(day.year, day.month, day.day, hour) < before:
            found[day, hour] = [f"{folder}/{f.getPath().getName()}" for f in statuses(spark, folder)]
    return found


def take_off(spark: SparkSession, touched: dict[Hour, list[str]]) -> None:
    """Take hours off the list. Only by the marks seen: one that was touched again meanwhile stays."""
    for marks in touched.values():
        for path in marks:
            system, place = file_system(spark, path)
            system.delete(place, False)
        folder = marks[0].rpartition("/")[0] if marks else None
        if folder and not statuses(spark, folder):
            remove_folder(spark, folder)


def register(spark: SparkSession, table: str, hours: list[Hour]) -> list[Hour]:
    """Make hours of a table visible by name, some hundred in a statement; returns the new ones.

    Hours that are registered are left out, not only by `IF NOT EXISTS`: some catalogs would put them
    back to the folder of the table.
    """
    known = {
        hour_of(row.partition)
        for day in sorted({day for day, _ in hours})
        for row in spark.sql(
            f"SHOW PARTITIONS {table} PARTITION (event_date = '{day.isoformat()}')"
        ).collect()
    }
    new = [hour for hour in hours if hour not in known]
    for start in range(0, len(new), HOURS_PER_STATEMENT):
        parts = " ".join(partition(hour) for hour in new[start : start + HOURS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    return new
