"""Hourly CSV drops: <base>/YYYY/MM/DD/HH/<group>/<kind>_*.csv."""

import csv
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import fixed_values as V
from tillflow import schemas as S

SOURCE_FILE = "source_file"
_OPEN_COST = "spark.sql.files.openCostInBytes"


def hour_folder(base: str, run_hour: datetime) -> str:
    """Folder of one hour's drops."""
    return f"{base.rstrip('/')}/{run_hour.strftime(V.HOUR_FOLDER_FORMAT)}"


def _read(spark: SparkSession, columns, paths) -> DataFrame:
    return (
        spark.read.schema(S.raw_schema(columns))
        .option("header", True)
        .option("enforceSchema", False)
        .csv(paths)
    )


def _first_lines(spark: SparkSession, paths: list[str]) -> list[tuple[str, str]]:
    """Path and first line of each file that is not blank, in one job, by the executors.

    Every split is a task of its own, which stops at its first line, so of a large file little is read.
    """

    def first(batches):
        for batch in batches:
            for k, line in enumerate(batch.column("value").to_pylist()):
                if line.strip():
                    # A split behind the first one begins somewhere in the file.
                    starts = batch.column("start")[k].as_py() == 0
                    yield batch.slice(k, int(starts)).select(["path", "value"])
                    return

    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        "value",
        F.col("_metadata.file_block_start").alias("start"),
    )
    before = spark.conf.get(_OPEN_COST)
    # Opening a file counts as much as a whole task, so no two splits share one.
    spark.conf.set(_OPEN_COST, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        found = lines.mapInArrow(first, "path string, value string").collect()
    finally:
        spark.conf.set(_OPEN_COST, before)
    return sorted((unquote(row.path), row.value) for row in found)


def files_by_header(spark: SparkSession, paths: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files with the same header line together; only first lines are read. Empty files drop out."""
    found: dict[tuple[str, ...], list[str]] = {}
    for path, line in _first_lines(spark, paths):
        found.setdefault(tuple(next(csv.reader([line]))), []).append(path)
    return found


def scan_files(
    spark: SparkSession, paths: list[str], kind: str
) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """Rows of files of one kind, each read by its own header, and the files that lack a column.

    The rows hold the columns of the kind, as text, and `source_file`; None where no file can
    be read. Columns that the kind does not know are left out.
    """
    wanted = S.RAW_COLUMNS[kind]
    rows, lacking = None, []
    for header, files in files_by_header(spark, paths).items():
        present = {name.lower() for name in header}
        missing = [name for name in wanted if name.lower() not in present]
        if missing:
            lacking += [(path, ", ".join(missing)) for path in files]
            continue
        source = F.col("_metadata.file_path").alias(SOURCE_FILE)
        part = _read(spark, header, files).select(*wanted, source)
        rows = part if rows is None else rows.unionByName(part)
    return rows, lacking


def scan_drop(spark: SparkSession, folder: str, kind: str, file_columns=None) -> DataFrame:
    """All files of one kind in all groups of an hour, as text columns; duplicates are kept.

    Each file is read by its own header, so files may hold more columns, or hold them in
    another order. A file that lacks a column raises rather than shifting values, and so does a
    missing folder. With `file_columns`, the header all files are known to have, no header is
    looked up first, and a file that differs from it raises.
    """
    glob = f"{folder}/*/{kind}_*.csv"
    if file_columns:
        return _read(spark, file_columns, glob).select(list(S.RAW_COLUMNS[kind]))
    paths = sorted(unquote(path) for path in spark.read.text(glob).inputFiles())
    rows, lacking = scan_files(spark, paths, kind)
    if lacking:
        raise ValueError(f"columns are missing in the header of files: {lacking}")
    if rows is None:
        return spark.createDataFrame([], S.raw_schema(S.RAW_COLUMNS[kind]))
    return rows.drop(SOURCE_FILE)
