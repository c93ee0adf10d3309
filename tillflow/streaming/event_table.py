"""Landing of app events in a table of the catalog, so that every reader sees whole hours.

A micro-batch is first written to a folder of its own, its stage. When the stage is whole its hours are
put on the list of touched hours and registered, then its files are moved, one by one, to the folder
that the catalog names for their hour. A moved file's name holds its epoch, so it is known for good, and
no file of another epoch is ever rewritten or removed:

* a batch that is replayed before its stage was whole writes the stage anew;
* one that is replayed later moves what is left there, which may be nothing.

The table shows an event however late it comes, since its hour is registered by the batch that brings it.
"""

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow import schemas as S
from tillflow.sources.workspace import file_system, remove_folder
from tillflow.streaming.events import good_events, parse_events, quarantine_events
from tillflow.streaming.hours import (
    Hour,
    hour_folder,
    hour_folders,
    hour_key,
    hour_name,
    hour_of,
    mark,
    partition,
    register,
    statuses,
    touched_list,
)
from tillflow.streaming.landing import PARTITIONS, by_hour

# Landed files begin with this, files of a compaction don't.
LANDED = "landed-"
_WHOLE = "_SUCCESS"

def table_root(spark: SparkSession, table: str) -> str:
    """Folder of the table."""
    return _location(spark.sql(f"DESCRIBE TABLE EXTENDED {table}"))


def hour_location(spark: SparkSession, table: str, hour: Hour) -> str:
    """Folder that the catalog names for an hour."""
    return _location(spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition(hour)}"))


def hour_places(spark: SparkSession, table: str, hours: list[Hour]) -> dict[Hour, str]:
    """Folders that the catalog names for many hours.

    Found by the files there; only for hours without files the catalog is asked one by one.
    """
    spark.catalog.refreshTable(table)
    files = spark.table(table).where(hour_key().isin([hour_name(*hour) for hour in hours])).inputFiles()
    folders = {unquote(file).rpartition("/")[0] for file in files}
    found = {hour_of(folder): folder for folder in folders}
    return {hour: found.get(hour) or hour_location(spark, table, hour) for hour in hours}


def _location(described: DataFrame) -> str:
    # Of a partition its own place comes first.
    rows = [row.data_type for row in described.collect() if row.col_name == "Location"]
    return rows[0].rstrip("/")


def _stage(root: str, epoch: str) -> str:
    stream, _, batch = epoch.rpartition("/")
    return f"{root}_epochs/{stream or 'stream'}/{batch}"


def _write_stage(rows: DataFrame, stage: str) -> None:
    by_hour(rows).write.mode("overwrite").partitionBy(*PARTITIONS).parquet(stage)


def _publish(spark: SparkSession, table: str, root: str, stage: str, epoch: str) -> None:
    name = epoch.replace("/", "-")
    folders = {hour_of(folder): folder for folder in hour_folders(spark, stage)}
    for hour in folders:
        mark(spark, touched_list(root), hour, name)
    new = register(spark, table, list(folders))
    known = [hour for hour in folders if hour not in new]
    places = {hour: hour_folder(root, hour) for hour in new} | hour_places(spark, table, known)
    for hour, folder in folders.items():
        target = places[hour]
        system, place = file_system(spark, target)
        system.mkdirs(place)
        for file in statuses(spark, folder):
            _, moved = file_system(spark, f"{target}/{LANDED}{name}-{file.getPath().getName()}")
            if not system.rename(file.getPath(), moved):
                raise RuntimeError(f"{file.getPath()} could not be moved; a replay moves it")
        system.delete(file_system(spark, folder)[1], True)


def land_epoch(events: DataFrame, table: str, epoch: str) -> None:
    """Add the rows of one epoch, `stream/number`, to the table, once however often it is tried."""
    spark = events.sparkSession
    root = table_root(spark, table)
    stage = _stage(root, epoch)
    system, whole = file_system(spark, f"{stage}/{_WHOLE}")
    if not system.exists(whole):
        _write_stage(events.withColumn(S.EVENT_EPOCH, F.lit(epoch)), stage)
    _publish(spark, table, root, stage, epoch)
    spark.catalog.refreshTable(table)
    # An epoch begins when the ones before are committed; they are not replayed any more.
    base, _, own = stage.rpartition("/")
    for other in statuses(spark, base):
        number = other.getPath().getName()
        if number.isdigit() and own.isdigit() and int(number) < int(own):
            remove_folder(spark, f"{base}/{number}")


def land_events(
    records: DataFrame, table: str, rejects_path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Start landing a stream of JSON records in a table made by `create_event_table`.

    `trigger` is passed to the writer. Records that cannot be decoded are kept under `rejects_path`,
    by epoch.
    """
    spark = records.sparkSession
    run = {"stream": None}

    def land(batch: DataFrame, batch_id: int) -> None:
        if run["stream"] is None:
            run["stream"] = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        epoch = f"{run['stream']}/{batch_id}"
        land_epoch(good_events(batch), table, epoch)
        rejects = quarantine_events(batch).withColumn(S.EVENT_EPOCH, F.lit(epoch))
        (
            rejects.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(S.EVENT_EPOCH)
            .parquet(rejects_path)
        )

    writer = parse_events(records).writeStream.foreachBatch(land)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
