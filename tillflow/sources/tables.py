"""Warehouse tables: definitions, appends and the catalog."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import fixed_values as V
from tillflow import schemas as S
from tillflow.operators.star import new_rows
from tillflow.sources.workspace import file_system, fresh_folder, remove_folder, shuffles_removed

LOAD_HOUR = "load_hour"
KEYLESS_TABLE = "rows_without_key"
_NO_HOUR = "appended"
_VERSIONS = "_versions/"


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if it is missing."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")


def list_databases(spark: SparkSession) -> DataFrame:
    """Names of all databases."""
    return spark.sql("SHOW DATABASES")


def create_fact_table(spark: SparkSession, database: str, by_load_hour: bool = False) -> str:
    """Create the fact table, partitioned by date, or by load hour and date; returns its name.

    Its own option says that an overwrite of an hour is static, whatever the session says.
    """
    table = f"{database}.{V.FACT_TABLE}"
    columns = ", ".join(f"{name} {type_name}" for name, type_name in S.FACT_COLUMNS.items())
    partitions = [LOAD_HOUR] * by_load_hour + [S.FACT_PARTITION]
    columns += "".join(f", {name} string" for name in partitions)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
        " OPTIONS (partitionOverwriteMode 'static')"
        f" PARTITIONED BY ({', '.join(partitions)})"
    )
    return table


def create_dimension_table(spark: SparkSession, database: str, name: str) -> str:
    """Create one dimension table; returns its qualified name."""
    table = f"{database}.{name}"
    columns = ", ".join(f"{column} string" for column in S.DIMENSION_COLUMNS[name])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")
    return table


def _grouped_by_date(fact: DataFrame) -> DataFrame:
    """Bring rows of one date together, so that each date gets few files.

    As a rebalance, not a repartition: a date with a third of all rows is split
    over several tasks at run time, small dates share a task.
    """
    return fact.hint("rebalance", S.FACT_PARTITION)


def append_fact(fact: DataFrame, table: str, grouped: bool = False) -> None:
    """Append rows to the date partitions they belong to; a rerun appends them again.

    grouped: as in `replace_fact_hour`.
    """
    (
        (fact if grouped else _grouped_by_date(fact))
        .write.mode("append")
        .format("parquet")
        .partitionBy(S.FACT_PARTITION)
        .saveAsTable(table)
    )


def replace_fact_hour(
    fact: DataFrame, table: str, load_hour: str, grouped: bool = False
) -> None:
    """Write the rows of one load hour; a rerun replaces what that hour wrote before.

    Needs a table made with `by_load_hour`. The hour is a static partition, so dates
    that an earlier run wrote and this one does not are removed as well.

    grouped: the rows of a date lie in few tasks already; they are not shuffled again.
    """
    rows = (fact if grouped else _grouped_by_date(fact)).select(*S.FACT_COLUMNS, S.FACT_PARTITION)
    with shuffles_removed(fact.sparkSession):
        fact.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {table}"
            f" PARTITION ({LOAD_HOUR} = '{load_hour}', {S.FACT_PARTITION})"
            " SELECT * FROM {rows}",
            rows=rows,
        )


def _key_bytes(rows: DataFrame, key: str) -> int:
    """Bytes that the keys take in a broadcast, with what each row takes besides."""
    size = F.sum(F.octet_length(F.coalesce(F.col(key), F.lit(""))).cast("long") + 64)
    return rows.agg(F.coalesce(size, F.lit(0))).first()[0]


def append_dimension(
    dimension: DataFrame, table: str, broadcast_bytes: int = 64 * 1024 * 1024
) -> None:
    """Insert rows whose key the table does not hold yet; one loader per table at a time.

    The rows given are written to a folder first, so they are worked out once and their size is known.
    Keys of up to `broadcast_bytes` are sent to the table, as an hour's are; more meet it in a shuffle.
    """
    spark = dimension.sparkSession
    spark.catalog.refreshTable(table)
    key = dimension.columns[0]
    place = fresh_folder(spark, "dimension-rows")
    try:
        dimension.write.parquet(place)
        given = spark.read.schema(dimension.schema).parquet(place)
        few = _key_bytes(given, key) <= broadcast_bytes
        fresh = new_rows(given, spark.table(table), key, few)
        # Small partitions are merged, so an hour adds few files.
        fresh.hint("rebalance").write.mode("append").format("parquet").saveAsTable(table)
    finally:
        remove_folder(spark, place)


def table_location(spark: SparkSession, table: str) -> str:
    """Folder of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0].data_type.rstrip("/")


def _data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    system, place = file_system(spark, folder)
    entries = system.listStatus(place) if system.exists(place) else []
    named = [(entry.getPath().getName(), entry.getLen()) for entry in entries]
    return [(name, size) for name, size in named if not name.startswith(("_", "."))]


def _switch(spark: SparkSession, table: str, place: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")


def compact_dimension(
    spark: SparkSession,
    table: str,
    most_files: int = 64,
    target_file_bytes: int = 128 * 1024 * 1024,
) -> bool:
    """Rewrite a dimension of more than `most_files` files as few; True if there was a need.

    The rows are written to a new folder beside the table, then one statement tells the catalog of it:
    readers find the old rows or the new ones, and a run that is cut off before has changed nothing.
    The folder left last stays for readers that are still in it, the one before is removed. Runs in
    the loader of the table, as appends do: one at a time.
    """
    spark.catalog.refreshTable(table)
    place = table_location(spark, table)
    files = _data_files(spark, place)
    size = sum(length for _, length in files)
    wanted = max(1, -(-size // target_file_bytes))
    if len(files) <= max(most_files, wanted):
        return False
    root, _, number = place.rpartition(_VERSIONS)
    root, number = (root, int(number)) if root else (place, 0)
    new = f"{root}{_VERSIONS}{number + 1}"
    rows = spark.table(table)
    # Scan splits are merged where they are read; nothing is shuffled.
    rows.coalesce(wanted).write.mode("overwrite").parquet(new)
    if spark.read.schema(rows.schema).parquet(new).count() != rows.count():
        remove_folder(spark, new)
        raise RuntimeError(f"{table} changed while it was compacted; it was not switched")
    _switch(spark, table, new)
    spark.catalog.refreshTable(table)
    if number > 0:
        remove_folder(spark, f"{root}{_VERSIONS}{number - 1}" if number > 1 else root)
    return True


def keep_keyless(rows: DataFrame, database: str, load_hour: str | None) -> None:
    """Keep rows (dimension, fields) that no dimension can hold, by load hour.

    A rerun of an hour replaces its rows; without an hour, rows are appended.
    """
    spark = rows.sparkSession
    table = f"{database}.{KEYLESS_TABLE}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (dimension string, fields string, {LOAD_HOUR} string)"
        f" USING parquet PARTITIONED BY ({LOAD_HOUR})"
    )
    verb, hour = ("INTO", _NO_HOUR) if load_hour is None else ("OVERWRITE TABLE", load_hour)
    spark.sql(
        f"INSERT {verb} {table} PARTITION ({LOAD_HOUR} = '{hour}')"
        " SELECT dimension, fields FROM {rows}",
        rows=rows.hint("rebalance"),
    )


def register_views(frames: dict[str, DataFrame], prefix: str = "batch_") -> None:
    """Make frames of one batch queryable as `<prefix><name>`, apart from the stored tables."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")


def table_sample(table: DataFrame, rows: int, *order) -> DataFrame:
    """First rows of a table by `order`; without an order, any rows."""
    return (table.orderBy(*[F.col(name) for name in order]) if order else table).limit(rows)
