"""Compaction of dimension tables."""

import threading
import uuid

import pytest

from tillflow import fixed_values as V
from tillflow.operators import star
from tillflow.sources import tables

COLUMNS = "sales_person_id string, name string"


@pytest.fixture
def agents(spark):
    database = f"dims_{uuid.uuid4().hex}"
    tables.create_database(spark, database)
    return tables.create_dimension_table(spark, database, V.AGENT_TABLE)


def append(spark, table, *keys):
    rows = spark.createDataFrame([(str(k), f"name {k}") for k in keys], COLUMNS)
    tables.append_dimension(rows, table)


def files(spark, table):
    return tables._data_files(spark, tables.table_location(spark, table))


def keys(spark, table):
    return sorted(int(row.sales_person_id) for row in spark.table(table).collect())


def test_many_appends_leave_few_files(spark, agents):
    first = tables.table_location(spark, agents)
    most = 0
    for hour in range(12):
        append(spark, agents, hour, hour + 1)
        tables.compact_dimension(spark, agents, most_files=3)
        most = max(most, len(files(spark, agents)))
    assert most <= 4 and keys(spark, agents) == list(range(13))
    assert not tables._data_files(spark, first)


def test_large_tables_keep_files_of_the_size_wanted(spark, agents):
    for hour in range(6):
        append(spark, agents, hour)
    size = sum(length for _, length in files(spark, agents))
    assert tables.compact_dimension(spark, agents, 2, target_file_bytes=size // 2 + 1)
    assert len(files(spark, agents)) == 2 and keys(spark, agents) == list(range(6))
    assert not tables.compact_dimension(spark, agents, 2, target_file_bytes=size // 2 + 1)


def test_a_compaction_cut_off_changes_nothing(spark, agents, monkeypatch):
    for hour in range(4):
        append(spark, agents, hour)

    def fails(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(tables, "_switch", fails)
    with pytest.raises(RuntimeError, match="driver lost"):
        tables.compact_dimension(spark, agents, 1)
    assert keys(spark, agents) == [0, 1, 2, 3] and len(files(spark, agents)) == 4
    monkeypatch.undo()
    append(spark, agents, 4)
    assert tables.compact_dimension(spark, agents, 1)
    assert keys(spark, agents) == [0, 1, 2, 3, 4] and len(files(spark, agents)) == 1


def test_readers_see_all_rows_during_a_compaction(spark, agents):
    for hour in range(4):
        append(spark, agents, hour)
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            seen.add(spark.table(agents).count())

    reader = threading.Thread(target=read)
    reader.start()
    assert tables.compact_dimension(spark, agents, 1)
    stop.set()
    reader.join()
    assert seen == {4}


@pytest.mark.parametrize("broadcast_bytes", [64 * 1024 * 1024, 0])
def test_appends_add_each_new_key_once(spark, agents, broadcast_bytes):
    schema = "sales_person_id string, name string"
    hours = [[("1", "Ann"), ("2", "Bob")], [], [("2", "Rob"), ("3", None)], [("1", "Eve"), ("3", "Joe")]]
    for rows in hours:
        tables.append_dimension(spark.createDataFrame(rows, schema), agents, broadcast_bytes)
    kept = sorted(tuple(row) for row in spark.table(agents).collect())
    assert kept == [("1", "Ann"), ("2", "Bob"), ("3", None)]


def _above(plan, leaf):
    """Names of the operators above the first line that holds `leaf`, nearest first."""
    lines = plan.splitlines()
    at = next(k for k, line in enumerate(lines) if leaf in line)
    depth, names = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            depth = own
            names.append(line.strip(" :+-"))
    return names


def test_few_rows_do_not_shuffle_the_table(spark, agents):
    append(spark, agents, *range(50))
    rows = spark.createDataFrame([("7", "known"), ("70", "new")], COLUMNS)
    plans = {}
    for few in (True, False):
        fresh = star.new_rows(rows, spark.table(agents), "sales_person_id", few)
        assert [row.sales_person_id for row in fresh.collect()] == ["70"]
        with_plan = star.new_rows(rows, spark.table(agents), "sales_person_id", few)
        plans[few] = with_plan._jdf.queryExecution().sparkPlan().toString()
    above = _above(plans[True], "FileScan parquet")
    first_join = next(k for k, name in enumerate(above) if "Join" in name)
    assert "BroadcastHashJoin" in above[first_join] and "LeftSemi" in above[first_join]
    assert "LeftSemi" not in plans[False]
