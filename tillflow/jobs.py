"""Jobs a scheduler would call; times come in as arguments."""

from datetime import UTC, date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import fixed_values as V
from tillflow import schemas as S
from tillflow.operators import cleaning, maintenance, star, versions
from tillflow.plans.b2b import daily_report_order, daily_sales_dump
from tillflow.session import small_splits
from tillflow.sources import tables
from tillflow.sources.drops import hour_folder, scan_drop
from tillflow.sources.reports import write_csv_report
from tillflow.sources.tables import KEYLESS_TABLE as KEYLESS_TABLE
from tillflow.sources.workspace import fresh_folder, remove_folder
from tillflow.streaming.hours import register, take_off, touched_hours
from tillflow.streaming.raw_files import archive_taken, land_raw_files, read_raw_zone

_KINDS = (V.SALES_KIND, V.AGENTS_KIND, V.BRANCHES_KIND)


def load_batch(
    spark: SparkSession,
    database: str,
    sales: DataFrame,
    agents: DataFrame,
    branches: DataFrame,
    load_hour: str | None = None,
) -> None:
    """Clean one batch and load it into the fact and the four dimensions.

    With `load_hour` a rerun replaces the hour's facts, without it facts are appended.
    The cleaned lines feed several tables: they are written once, as they come, to a folder all
    executors share, which is removed at the end. Copies are taken out where they matter. Rows that
    enter no dimension, as they have no key, are kept in a table of their own.
    """
    folder = fresh_folder(spark, "clean-sales")
    try:
        cleaning.clean_lines(sales).write.parquet(folder, compression="zstd")
        lines = spark.read.parquet(folder)
        fact = star.fact_of_lines(lines)
        fact_table = tables.create_fact_table(spark, database, by_load_hour=load_hour is not None)
        with small_splits(spark):
            if load_hour is None:
                tables.append_fact(fact, fact_table, grouped=True)
            else:
                tables.replace_fact_hour(fact, fact_table, load_hour, grouped=True)
        clean = cleaning.with_address_parts(lines)
        sources = {
            V.CUSTOMER_TABLE: (clean, star.customer_dim),
            V.PRODUCT_TABLE: (clean, star.product_dim),
            V.AGENT_TABLE: (cleaning.clean_agents(agents), star.sales_agent_dim),
            V.BRANCH_TABLE: (cleaning.clean_branches(branches), star.branch_dim),
        }
        for name, (rows, dimension) in sources.items():
            table = tables.create_dimension_table(spark, database, name)
            tables.append_dimension(dimension(rows), table)
            tables.compact_dimension(spark, table)
        keyless = []
        for name, (rows, _) in sources.items():
            lost = star.without_key(rows, S.DIMENSION_COLUMNS[name][0])
            lost = lost.dropDuplicates() if rows is clean else lost
            keyless.append(
                lost.select(F.lit(name).alias("dimension"), F.to_json(F.struct("*")).alias("fields"))
            )
        tables.keep_keyless(reduce(DataFrame.unionByName, keyless), database, load_hour)
    finally:
        remove_folder(spark, folder)


def load_hour(spark: SparkSession, base: str, run_hour: datetime, database: str) -> None:
    """Load the drops of one hour; running it again changes nothing."""
    tables.create_database(spark, database)
    folder = hour_folder(base, run_hour)
    drops = [scan_drop(spark, folder, kind) for kind in _KINDS]
    load_batch(spark, database, *drops, load_hour=run_hour.strftime("%Y-%m-%d-%H"))


def land_new_files(
    spark: SparkSession,
    drops: str,
    zone: str,
    checkpoints: str,
    archive: str | None = None,
    **limits,
) -> None:
    """Take the files that appeared below `drops/<group>/` since the last run to the raw zone.

    With `archive`, a folder in the same storage, files taken are moved there.
    """
    for kind in _KINDS:
        land_raw_files(
            spark,
            drops,
            kind,
            f"{zone}/{kind}",
            f"{checkpoints}/{kind}",
            availableNow=True,
            **limits,
        ).awaitTermination()
        if archive:
            archive_taken(spark, f"{zone}/{kind}", f"{checkpoints}/{kind}", f"{archive}/{kind}")


def load_landed_hour(spark: SparkSession, zone: str, ingest_hour: str, database: str) -> None:
    """Load what was landed in one hour (`yyyy-MM-dd-HH`); running it again changes nothing."""
    tables.create_database(spark, database)
    landed = [read_raw_zone(spark, f"{zone}/{kind}", kind, ingest_hour) for kind in _KINDS]
    load_batch(spark, database, *landed, load_hour=ingest_hour)


def daily_report(spark: SparkSession, database: str, day: date, folder: str) -> str:
    """Write the report of one day as CSV; returns its path, which ends in the day, unpadded."""
    report = daily_sales_dump(
        spark.table(f"{database}.{V.FACT_TABLE}"),
        spark.table(f"{database}.{V.AGENT_TABLE}"),
        spark.table(f"{database}.{V.PRODUCT_TABLE}"),
        day,
    )
    path = f"{folder.rstrip('/')}/sales_data_{day.year}-{day.month}-{day.day}"
    write_csv_report(report, path, *daily_report_order())
    return path


def upkeep_events(
    spark: SparkSession, table: str, path: str, now: datetime, days_back: int = 2, lag_hours: int = 1
) -> None:
    """Hourly upkeep of landed events: compact the hours that are over, then register hours.

    Compacts the hours of the last `days_back` days that ended `lag_hours - 1` hours ago or
    earlier; late events scatter older hours again, which a longer look back takes up. Hours
    are registered after their swap, so that the table never lists a file that is gone: those of
    these days, and all that landing touched since the last run, of any age.
    """
    day, hour = maintenance.closed_hour(now, lag_hours)
    open_from = datetime(day.year, day.month, day.day, hour) + timedelta(hours=1)
    start, end = day - timedelta(days=days_back), day + timedelta(days=1)
    maintenance.compact_range(spark, path, start, end, closed_before=open_from)
    maintenance.register_hours(
        spark, table, maintenance.landed_hours(spark, path, start, now.date() + timedelta(days=1))
    )
    touched = touched_hours(spark, path.rstrip("/"))
    register(spark, table, list(touched))
    take_off(spark, touched)
    spark.catalog.refreshTable(table)


def upkeep_event_table(
    spark: SparkSession,
    table: str,
    now: datetime,
    lag_hours: int = 1,
    keep: timedelta = timedelta(days=1),
    target_file_bytes: int = maintenance.TARGET_FILE_BYTES,
) -> list[tuple[date, int]]:
    """Hourly upkeep of a table that `event_table.land_events` fills; returns the hours compacted.

    Takes the hours that landing touched since the last run, however old they are, and that ended
    `lag_hours - 1` hours ago or earlier. Old versions go when they are out of use for `keep`, by the
    clock of the storage.
    """
    day, hour = maintenance.closed_hour(now, lag_hours)
    open_from = datetime(day.year, day.month, day.day, hour) + timedelta(hours=1)
    done = versions.compact_touched(spark, table, open_from, target_file_bytes)
    versions.remove_old_versions(spark, table, datetime.now(UTC), keep)
    return done
