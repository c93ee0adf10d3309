"""Landing of app events in a date- and hour-partitioned parquet table.

Micro-batches are delivered at least once. Every landed row carries the epoch it
came from, so a batch that is replayed after a failure replaces its own rows and
no others, also when a compaction has moved them to another file meanwhile.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tillflow import schemas as S
from tillflow.streaming.events import good_events, parse_events, quarantine_events
from tillflow.streaming.hours import mark, touched_list

PARTITIONS = list(S.EVENT_PARTITIONS)


def table_schema() -> T.StructType:
    """Schema of the landed table."""
    columns = {**S.EVENT_COLUMNS, S.EVENT_EPOCH: "string", **S.EVENT_PARTITIONS}
    return T.StructType.fromDDL(", ".join(f"{name} {type_}" for name, type_ in columns.items()))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The landed table."""
    return spark.read.schema(table_schema()).parquet(path)


def read_events_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """The landed table, or None before anything was landed."""
    try:
        return read_events(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def by_hour(rows: DataFrame) -> DataFrame:
    """Bring rows of one hour together, so that an hour gets few files; hot hours are split."""
    return rows.hint("rebalance", *PARTITIONS)


def _write(rows: DataFrame, path: str, mode: str, partitions) -> None:
    (
        rows.write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def _stored_hours_of_epoch(rows: DataFrame, path: str, epoch: str) -> DataFrame | None:
    """Hours in which an earlier attempt at this epoch left rows; None when there are none.

    Looks only into the batch's own hours, so one very late event adds one hour to the search.
    """
    stored = read_events_if_any(rows.sparkSession, path)
    if stored is None:
        return None
    hours = _epoch_in_hours(stored, rows.select(PARTITIONS).distinct(), epoch)
    return None if hours.isEmpty() else hours


def _epoch_in_hours(stored: DataFrame, hours: DataFrame, epoch: str) -> DataFrame:
    return (
        stored.where(F.col(S.EVENT_EPOCH) == epoch)
        .join(hours, PARTITIONS, "left_semi")
        .select(PARTITIONS)
        .distinct()
    )


def land_epoch(events: DataFrame, path: str, epoch: str, may_be_replay: bool) -> None:
    """Add one epoch's rows to the table; a replay replaces what its first attempt left."""
    rows = events.withColumn(S.EVENT_EPOCH, F.lit(epoch))
    # A row per hour of the batch; upkeep registers what is on the list, however old it is.
    for hour in rows.select(PARTITIONS).distinct().collect():
        mark(events.sparkSession, touched_list(path.rstrip("/")), tuple(hour), epoch.replace("/", "-"))
    hours = _stored_hours_of_epoch(rows, path, epoch) if may_be_replay else None
    if hours is None:
        _write(by_hour(rows), path, "append", PARTITIONS)
        return
    others = read_events(events.sparkSession, path).where(F.col(S.EVENT_EPOCH) != epoch)
    whole_hours = others.unionByName(rows).join(hours, PARTITIONS, "left_semi")
    # New hours first: should the job die in between, the next attempt finds them all.
    _write(by_hour(rows.join(hours, PARTITIONS, "left_anti")), path, "append", PARTITIONS)
    _write(by_hour(whole_hours), path, "overwrite", PARTITIONS)


def land_events(
    records: DataFrame, path: str, rejects_path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Start landing a stream of JSON records; late events go to the hour they happened in.

    `trigger` is passed to the writer, e.g. `availableNow=True` for a job that ends;
    without it the query runs until stopped. Records that cannot be decoded are kept
    under `rejects_path`, by epoch. The rows of a micro-batch are brought together by
    hour, which shuffles them once; what a micro-batch reads at most is an option of the source.
    """
    spark = records.sparkSession
    run = {"stream": None}

    def land(batch: DataFrame, batch_id: int) -> None:
        may_be_replay = run["stream"] is None
        if may_be_replay:
            run["stream"] = spark.read.json(f"{checkpoint}/metadata").first()["id"]
        epoch = f"{run['stream']}/{batch_id}"
        parsed = batch.persist()
        try:
            land_epoch(good_events(parsed), path, epoch, may_be_replay)
            rejects = quarantine_events(parsed).withColumn(S.EVENT_EPOCH, F.lit(epoch))
            _write(rejects, rejects_path, "overwrite", [S.EVENT_EPOCH])
        finally:
            parsed.unpersist()

    writer = parse_events(records).writeStream.foreachBatch(land)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
