"""Upkeep of the event table: small files and new partitions.

Parquet folders have no transactions: run a compaction where nothing else writes
to the same hours, which is why it takes hours that are over for a while.
"""

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schemas as S
from tillflow.sources.workspace import file_system, remove_folder
from tillflow.streaming.hours import Hour, hour_key, hour_name, register
from tillflow.streaming.landing import (
    PARTITIONS,
    by_hour,
    read_events,
    read_events_if_any,
    table_schema,
)

TARGET_FILE_BYTES = 128 * 1024 * 1024
_FINISHED = "_SUCCESS"


def closed_hour(now: datetime, lag_hours: int = 1) -> tuple[date, int]:
    """Date and hour that ended at least `lag_hours - 1` hours ago."""
    hour = now - timedelta(hours=lag_hours)
    return hour.date(), hour.hour


def stage_folder(path: str) -> str:
    """Where hours of the table at `path` wait for their swap: beside it, in the same storage."""
    return f"{path.rstrip('/')}_compacting"


def _finished_stages(spark: SparkSession, stage: str) -> list[str]:
    """Stages that were written to their end, oldest first; there are two at most."""
    system, place = file_system(spark, stage)
    if not system.exists(place):
        return []
    found = sorted(int(entry.getPath().getName()) for entry in system.listStatus(place))
    stages = [f"{stage}/{number}" for number in found]
    return [s for s in stages if system.exists(file_system(spark, f"{s}/{_FINISHED}")[1])]


def _discard(spark: SparkSession, stage: str) -> None:
    """Remove stages, the marks of finished ones first, so that no half-removed one counts."""
    for finished in _finished_stages(spark, stage):
        system, mark = file_system(spark, f"{finished}/{_FINISHED}")
        system.delete(mark, False)
    remove_folder(spark, stage)


def _write_hours(rows: DataFrame, path: str, **options) -> None:
    (
        rows.write.mode("overwrite")
        .options(**options)
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def _per_hour(rows: DataFrame) -> DataFrame:
    return rows.groupBy(PARTITIONS).agg(F.count("*").alias("rows"))


def _swap(spark: SparkSession, path: str, staged: str) -> None:
    """Move staged hours to the place of the table's; those not moved yet stay in the stage.

    Folders are renamed, no row is written a second time.
    """
    system, root = file_system(spark, staged)
    for day in system.listStatus(root):
        if not day.isDirectory():
            continue
        for hour in system.listStatus(day.getPath()):
            name = f"{day.getPath().getName()}/{hour.getPath().getName()}"
            _, target = file_system(spark, f"{path.rstrip('/')}/{name}")
            system.delete(target, True)
            system.mkdirs(target.getParent())
            if not system.rename(hour.getPath(), target):
                raise RuntimeError(f"{name} could not be moved; the next run moves it")
    _discard(spark, stage_folder(path))


def finish_compaction(spark: SparkSession, path: str) -> bool:
    """Finish a swap that an earlier run left half done; True if there was one.

    Rows that came to a staged hour after it was staged, known by their epoch, are joined to
    the stage first, in a stage of their own, so no crash loses them.
    """
    stages = _finished_stages(spark, stage_folder(path))
    if not stages:
        # What is left of a stage that was not written to its end is written anew.
        return False
    staged = read_events(spark, stages[-1])
    stored = read_events_if_any(spark, path)
    if stored is not None:
        came_later = stored.join(staged.select(PARTITIONS).distinct(), PARTITIONS, "left_semi").join(
            staged.select(*PARTITIONS, S.EVENT_EPOCH).distinct(),
            [*PARTITIONS, S.EVENT_EPOCH],
            "left_anti",
        )
        if not came_later.isEmpty():
            number = int(stages[-1].rsplit("/", 1)[1]) + 1
            stages.append(f"{stage_folder(path)}/{number}")
            _write_hours(by_hour(staged.unionByName(came_later)), stages[-1])
    _swap(spark, path, stages[-1])
    return True


def _rewrite(spark: SparkSession, path: str, hours: DataFrame, laid_out: DataFrame) -> None:
    """Stage hours in their new layout, compare row counts, swap."""
    staged = f"{stage_folder(path)}/1"
    _write_hours(laid_out, staged)
    before, after = _per_hour(hours), _per_hour(read_events(spark, staged))
    if not before.exceptAll(after).isEmpty() or not after.exceptAll(before).isEmpty():
        _discard(spark, stage_folder(path))
        raise RuntimeError(f"hours of {path} changed while they were compacted; nothing was swapped")
    _swap(spark, path, staged)


def laid_out(rows: DataFrame, files: dict[Hour, int]) -> DataFrame:
    """Rows dealt out so that each hour becomes as many files as named.

    One shuffle. An hour of several files is spread by a hash of its rows, so a hot hour is written by
    as many tasks as it gets files.
    """
    several = [
        pair
        for (day, hour), n in files.items()
        if n > 1
        for pair in (F.lit(hour_name(day, hour)), F.lit(n))
    ]
    # Small hours share tasks; a part of a hot hour is a task's work.
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = sum(n for n in files.values() if n > 1)
    tasks = min(sum(files.values()), max(least, 2 * hot))
    if not several:
        return rows.repartition(tasks, *PARTITIONS)
    share = F.coalesce(F.try_element_at(F.create_map(*several), hour_key()), F.lit(1))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(*S.EVENT_COLUMNS, S.EVENT_EPOCH), share))
    return dealt.repartition(tasks, *PARTITIONS, "part").drop("part")


def files_per_hour(spark: SparkSession, path: str) -> DataFrame:
    """event_date, event_hour, rows, files and bytes of every landed hour."""
    per_file = (
        read_events(spark, path)
        .groupBy(*PARTITIONS, "_metadata.file_path", "_metadata.file_size")
        .agg(F.count("*").alias("rows"))
    )
    return per_file.groupBy(PARTITIONS).agg(
        F.sum("rows").alias("rows"),
        F.count("*").alias("files"),
        F.sum("file_size").alias("bytes"),
    )


def compact_partition(
    spark: SparkSession,
    path: str,
    event_date: date,
    event_hour: int,
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> bool:
    """Rewrite one hour as few files; True if it was rewritten, False if there was no need.

    The number of files follows from the bytes stored, one for a small hour. Scan
    splits are merged where they are read, so staging needs no shuffle. The hour is staged
    beside the table, its rows counted, then swapped; a swap that was cut off is finished
    by the next run from the stage.
    """
    finish_compaction(spark, path)
    stored = read_events_if_any(spark, path)
    if stored is None:
        return False
    hour = stored.where(
        (F.col("event_date") == F.lit(event_date)) & (F.col("event_hour") == event_hour)
    )
    files, size = (
        hour.select("_metadata.file_path", "_metadata.file_size")
        .distinct()
        .agg(F.count("*"), F.sum("file_size"))
        .first()
    )
    wanted = -(-(size or 0) // target_file_bytes)
    if files <= wanted:
        return False
    _rewrite(spark, path, hour, hour.coalesce(wanted))
    return True


def compact_range(
    spark: SparkSession,
    path: str,
    start: date,
    end: date,
    closed_before: datetime | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
) -> DataFrame | None:
    """Rewrite hours of the dates [start, end) in one job, each as few files; returns those hours.

    Hours that are as few files as their bytes need already are left alone, and so are, with
    `closed_before`, hours that begin at that time or later. None if there was nothing to do.
    Rows are shuffled once; an hour with a third of all rows is written by as many tasks as it gets
    files.
    """
    finish_compaction(spark, path)
    if read_events_if_any(spark, path) is None:
        return None
    wanted = F.ceil(F.col("bytes") / target_file_bytes)
    in_range = (F.col("event_date") >= F.lit(start)) & (F.col("event_date") < F.lit(end))
    if closed_before is not None:
        last, hour = F.lit(closed_before.date()), closed_before.hour
        in_range &= (F.col("event_date") < last) | (
            (F.col("event_date") == last) & (F.col("event_hour") < hour)
        )
    # A row per hour: kept as rows of the driver, as the swap changes the files they count.
    scattered = files_per_hour(spark, path).where(in_range & (F.col("files") > wanted))
    todo = scattered.select(*PARTITIONS, wanted.cast("int").alias("wanted")).collect()
    if not todo:
        return None
    files = {(row.event_date, row.event_hour): row.wanted for row in todo}
    names = [hour_name(*hour) for hour in files]
    # On the partition columns alone, so it prunes folders and needs no join.
    hours = read_events(spark, path).where(in_range & hour_key().isin(names))
    _rewrite(spark, path, hours, laid_out(hours, files))
    return spark.createDataFrame(list(files), "event_date date, event_hour int")


def landed_hours(spark: SparkSession, path: str, start: date, end: date) -> DataFrame:
    """Hours of the dates [start, end) that have rows; no column of a file is read."""
    hours = read_events(spark, path).select(PARTITIONS)
    return hours.where(
        (F.col("event_date") >= F.lit(start)) & (F.col("event_date") < F.lit(end))
    ).distinct()


def register_hours(spark: SparkSession, table: str, hours: DataFrame) -> None:
    """Make these hours of a table visible by name, without listing its other folders."""
    rows = hours.select(PARTITIONS).where("event_date IS NOT NULL").distinct().collect()
    register(spark, table, [tuple(row) for row in rows])


def create_event_table(spark: SparkSession, table: str, path: str) -> None:
    """Register a landed folder as a table; its partitions become visible by a repair."""
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in table_schema()
    )
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
        f" PARTITIONED BY ({', '.join(S.EVENT_PARTITIONS)}) LOCATION '{path}'"
    )


def repair_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Make all partition folders of a table visible; returns the table.

    Lists the whole table: a repair tool. `register_hours` adds those just landed.
    """
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)
