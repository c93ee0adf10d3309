"""Incremental landing of raw files: each new file is taken once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillflow import schemas as S
from tillflow.sources.drops import SOURCE_FILE, scan_files
from tillflow.sources.workspace import file_system, remove_folder
from tillflow.streaming.events import ANY_AGE
from tillflow.streaming.hours import statuses

INGEST_HOUR = "ingest_hour"
INGEST_EPOCH = "ingest_epoch"
# Folder names of the raw zone.
INGEST_HOUR_PATTERN = "yyyy-MM-dd-HH"
_FILE_COLUMNS = "path string, modificationTime timestamp, length bigint, content binary"


def set_aside_folder(zone: str) -> str:
    """Where the names of files that could not be landed are kept, with the columns they lack."""
    return f"{zone.rstrip('/')}_set_aside"


def taken_list(zone: str) -> str:
    """Where the names of files taken are kept until they are in the archive."""
    return f"{zone.rstrip('/')}_taken"


def _list_taken(spark: SparkSession, folder: str, paths: list[str]) -> None:
    names = spark.createDataFrame([(path,) for path in paths], "path string")
    names.coalesce(1).write.mode("overwrite").parquet(folder)


def archive_taken(spark: SparkSession, zone: str, checkpoint: str, archive: str) -> int:
    """Move the files of committed batches out of the drops; returns how many were moved.

    A batch that may be replayed still needs its files, so they stay. After that the drops hold only
    what is new or about to be taken: listing them stays quick, and when the last batch is committed
    and archived a new checkpoint may be started, with an empty list of files seen; it takes none
    twice. A run that was cut off is finished by the next one.
    """
    stream = spark.read.json(f"{checkpoint}/metadata").first()["id"]
    commits = [f.getPath().getName() for f in statuses(spark, f"{checkpoint}/commits")]
    last = max((int(name) for name in commits if name.isdigit()), default=-1)
    moved = 0
    for folder in statuses(spark, f"{taken_list(zone)}/{stream}"):
        number = folder.getPath().getName()
        if int(number) > last:
            continue
        listed = f"{taken_list(zone)}/{stream}/{number}"
        for row in spark.read.schema("path string").parquet(listed).collect():
            system, place = file_system(spark, row.path)
            group, name = place.getParent().getName(), place.getName()
            _, target = file_system(spark, f"{archive.rstrip('/')}/{stream}-{number}/{group}/{name}")
            if system.exists(place):
                system.mkdirs(target.getParent())
                if not system.rename(place, target):
                    raise RuntimeError(f"{row.path} could not be moved; the next run moves it")
                moved += 1
        remove_folder(spark, listed)
    return moved


def _write(rows: DataFrame, path: str, *partitions: str) -> None:
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def land_raw_files(
    spark: SparkSession,
    drops: str,
    kind: str,
    zone: str,
    checkpoint: str,
    max_files: int | None = None,
    **trigger,
) -> StreamingQuery:
    """Copy rows of new files of one kind below `drops/<group>/` to the raw zone.

    The stream is one of file names; each file is then read by its own header, columns by name.
    A file that lacks a column does not stop the stream: its name goes to `set_aside_folder`.
    The checkpoint remembers the files taken. The zone is partitioned by the hour of
    ingestion and by epoch; the hour is the batch's own clock, which a replayed batch
    repeats, so a replay replaces its folder. `max_files` bounds one micro-batch. Files
    of any age are taken.

    The names taken by a batch are listed beside the zone until `archive_taken` moves their files.
    The list of files seen in the checkpoint grows by some hundred bytes a file.
    """
    # Only the names are selected, so this source opens no file.
    reader = (
        spark.readStream.format("binaryFile").schema(_FILE_COLUMNS).option("maxFileAge", ANY_AGE)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    names = reader.load(f"{drops.rstrip('/')}/*/{kind}_*.csv").select(
        "path", F.date_format(F.current_timestamp(), INGEST_HOUR_PATTERN).alias(INGEST_HOUR)
    )
    run = {"stream": None}

    def land(batch: DataFrame, batch_id: int) -> None:
        if run["stream"] is None:
            run["stream"] = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        taken = batch.collect()
        if not taken:
            return
        stamp = {
            INGEST_HOUR: F.lit(taken[0][INGEST_HOUR]),
            INGEST_EPOCH: F.lit(f"{run['stream']}-{batch_id}"),
        }
        paths = sorted(row.path for row in taken)
        _list_taken(spark, f"{taken_list(zone)}/{run['stream']}/{batch_id}", paths)
        rows, lacking = scan_files(spark, paths, kind)
        if rows is not None:
            _write(rows.withColumns(stamp), zone, INGEST_HOUR, INGEST_EPOCH)
        if lacking:
            files = spark.createDataFrame(lacking, f"{SOURCE_FILE} string, missing string")
            _write(files.withColumns(stamp), set_aside_folder(zone), INGEST_EPOCH)

    writer = names.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_raw_zone(spark: SparkSession, zone: str, kind: str, ingest_hour: str | None = None):
    """Landed rows of one kind, all or those of one ingestion hour (`yyyy-MM-dd-HH`)."""
    columns = (*S.RAW_COLUMNS[kind], SOURCE_FILE, INGEST_HOUR, INGEST_EPOCH)
    rows = spark.read.schema(S.raw_schema(columns)).parquet(zone)
    return rows if ingest_hour is None else rows.where(F.col(INGEST_HOUR) == ingest_hour)
