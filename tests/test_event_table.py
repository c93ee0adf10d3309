"""Landing in a table, and compaction by versions: replays, cuts, late events and readers meanwhile."""

import json
import threading
from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streams import PURCHASE, VIEW, parsed

from tillflow import jobs
from tillflow.operators import maintenance, versions
from tillflow.sources import tables, workspace
from tillflow.streaming import event_table, events, hours, landing

DAY = date(2024, 1, 1)
LATER = datetime(2024, 1, 3)


class Landed:
    """A table that a stream of text files fills."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        (base / "incoming").mkdir()
        tables.create_database(spark, "app")
        self.table = f"app.landed_{base.name.replace('-', '_')}"
        maintenance.create_event_table(spark, self.table, str(base / "table"))

    def drop(self, name, *values):
        lines = [v if isinstance(v, str) else json.dumps(v) for v in values]
        (self.base / "incoming" / name).write_text("\n".join(lines) + "\n")

    def run(self):
        source = events.event_source(self.spark, "text", {}, path=str(self.base / "incoming"))
        event_table.land_events(
            source, self.table, str(self.base / "rejects"), str(self.base / "checkpoint"), availableNow=True
        ).awaitTermination()

    def forget_last_commit(self):
        commits = self.base / "checkpoint" / "commits"
        last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
        for path in (commits / str(last), commits / f".{last}.crc"):
            path.unlink(missing_ok=True)

    def amounts(self):
        rows = self.spark.table(self.table).select(F.coalesce("totalAmount", F.lit(0.0)).alias("a"))
        return sorted(row.a for row in rows.collect())

    def files(self, hour):
        place = event_table.hour_location(self.spark, self.table, (DAY, hour))
        return versions._data_files(self.spark, place)

    def epoch(self, number, *values):
        good = events.good_events(parsed(self.spark, *[json.dumps(v) for v in values]))
        event_table.land_epoch(good, self.table, f"s/{number}")


@pytest.fixture
def landed(spark, tmp_path):
    return Landed(spark, tmp_path)


def paid(amount, **more):
    return {**PURCHASE, "totalAmount": amount, **more}


def test_events_of_any_age_are_in_the_table_at_once(landed):
    landed.drop("a", VIEW, paid(1.0), "junk")
    landed.run()
    landed.drop("b", paid(2.0, timestamp="2022-11-27T05:00:00"))
    landed.run()
    assert landed.amounts() == [0.0, 1.0, 2.0]
    assert landed.spark.read.parquet(str(landed.base / "rejects")).count() == 1
    assert set(hours.touched_hours(landed.spark, str(landed.base / "table"))) == {
        (DAY, 5),
        (DAY, 23),
        (date(2022, 11, 27), 5),
    }


def test_a_replay_adds_nothing(landed):
    landed.drop("a", paid(1.0), VIEW)
    landed.run()
    landed.drop("b", paid(2.0), VIEW)
    landed.run()
    landed.forget_last_commit()
    landed.run()
    assert landed.amounts() == [0.0, 0.0, 1.0, 2.0]


def test_a_replay_after_a_compaction_adds_nothing(landed):
    for number in range(2):
        landed.drop(f"f{number}", paid(float(number + 1)))
        landed.run()
    assert jobs.upkeep_event_table(landed.spark, landed.table, LATER, keep=timedelta()) == [(DAY, 23)]
    landed.forget_last_commit()
    landed.run()
    assert landed.amounts() == [1.0, 2.0] and len(landed.files(23)) == 1


@pytest.mark.parametrize("cut", ["stage", "moves"])
def test_a_batch_cut_off_is_finished_by_its_replay(landed, monkeypatch, cut):
    landed.epoch(0, paid(5.0), VIEW)
    if cut == "stage":
        # As if a task of the stage died: files, but no mark.
        write = event_table._write_stage

        def half(rows, stage):
            write(rows.where("event_hour = 5"), stage)
            (landed.base / "table_epochs" / "s" / "1" / "_SUCCESS").unlink()
            raise RuntimeError("driver lost")

        monkeypatch.setattr(event_table, "_write_stage", half)
    else:
        calls, look = [], event_table.statuses

        def second_fails(spark, folder):
            calls.extend([folder] * ("epochs" in folder and "event_hour" in folder))
            if len(calls) == 2:
                raise RuntimeError("driver lost")
            return look(spark, folder)

        monkeypatch.setattr(event_table, "statuses", second_fails)
    with pytest.raises(RuntimeError, match="driver lost"):
        landed.epoch(1, paid(6.0), VIEW)
    # The rows of the other epoch are there all the time.
    landed.spark.catalog.refreshTable(landed.table)
    assert {0.0, 5.0} <= set(landed.amounts())
    monkeypatch.undo()
    landed.epoch(1, paid(6.0), VIEW)
    assert landed.amounts() == [0.0, 0.0, 5.0, 6.0]
    landed.epoch(1, paid(6.0), VIEW)
    assert landed.amounts() == [0.0, 0.0, 5.0, 6.0]


def test_upkeep_leaves_open_hours_and_hours_of_one_file(landed):
    landed.epoch(0, VIEW, paid(1.0), {**VIEW, "timestamp": "2024-01-01T04:00:00"})
    landed.epoch(1, VIEW, paid(2.0))
    assert jobs.upkeep_event_table(landed.spark, landed.table, datetime(2024, 1, 1, 23, 10)) == [(DAY, 5)]
    assert [len(landed.files(hour)) for hour in (4, 5, 23)] == [1, 1, 2]
    # The open hour is looked after when it is over, without being touched again.
    assert jobs.upkeep_event_table(landed.spark, landed.table, LATER) == [(DAY, 23)]
    assert jobs.upkeep_event_table(landed.spark, landed.table, LATER) == []
    assert landed.amounts() == [0.0, 0.0, 0.0, 1.0, 2.0]


def test_readers_never_miss_a_row_nor_see_one_twice(landed):
    for number in range(4):
        landed.epoch(number, *[paid(float(k)) for k in range(20)], VIEW)
    seen, stop = set(), threading.Event()

    def read():
        while not stop.is_set():
            seen.add(landed.spark.table(landed.table).where("event_hour = 23").count())

    reader = threading.Thread(target=read)
    reader.start()
    for _ in range(3):
        versions.compact_hours(landed.spark, landed.table, [(DAY, 23), (DAY, 5)], 1)
        versions.compact_hours(landed.spark, landed.table, [(DAY, 23), (DAY, 5)])
    stop.set()
    reader.join()
    assert seen == {80}
    assert len(landed.files(23)) == 1


def test_a_version_that_was_never_switched_to_counts_for_nothing(landed, monkeypatch):
    for number in range(2):
        landed.epoch(number, paid(float(number)), VIEW)

    def fails(*_):
        raise RuntimeError("driver lost")

    switch = versions.switch
    monkeypatch.setattr(versions, "switch", fails)
    with pytest.raises(RuntimeError, match="driver lost"):
        versions.compact_touched(landed.spark, landed.table)
    assert landed.amounts() == [0.0, 0.0, 0.0, 1.0] and len(landed.files(23)) == 2
    done = []

    def once(*args):
        if done:
            raise RuntimeError("driver lost")
        done.append(switch(*args))

    monkeypatch.setattr(versions, "switch", once)
    with pytest.raises(RuntimeError, match="driver lost"):
        versions.compact_touched(landed.spark, landed.table)
    assert landed.amounts() == [0.0, 0.0, 0.0, 1.0]
    monkeypatch.undo()
    versions.compact_touched(landed.spark, landed.table)
    assert landed.amounts() == [0.0, 0.0, 0.0, 1.0]
    assert len(landed.files(23)) == len(landed.files(5)) == 1


def test_a_straggler_is_taken_in_by_the_next_run(landed):
    spark = landed.spark
    for number in range(2):
        landed.epoch(number, paid(float(number)))
    old = event_table.hour_location(spark, landed.table, (DAY, 23))
    versions.compact_touched(spark, landed.table)
    # A batch that asked for the hour's place before the switch, and moved its file after it.
    landed.epoch(2, paid(7.0))
    new = event_table.hour_location(spark, landed.table, (DAY, 23))
    (late,) = [f for f in versions._data_files(spark, new) if "s-2" in f.name]
    system, source = workspace.file_system(spark, late.path)
    assert system.rename(source, workspace.file_system(spark, f"{old}/{late.name}")[1])
    versions.compact_touched(spark, landed.table)
    spark.catalog.refreshTable(landed.table)
    assert landed.amounts() == [0.0, 1.0, 7.0]
    landed.epoch(3, paid(8.0))
    now = datetime.now(UTC) + timedelta(hours=1)
    assert versions.remove_old_versions(spark, landed.table, now, timedelta()) > 0
    versions.compact_touched(spark, landed.table)
    assert landed.amounts() == [0.0, 1.0, 7.0, 8.0] and len(landed.files(23)) == 1


def test_old_versions_go_after_a_while(landed):
    for number in range(3):
        landed.epoch(number, paid(float(number)))
    spark, now = landed.spark, datetime.now(UTC)
    versions.compact_touched(spark, landed.table)
    assert versions.remove_old_versions(spark, landed.table, now, timedelta(hours=1)) == 0
    assert versions.remove_old_versions(spark, landed.table, now + timedelta(hours=2), timedelta(hours=1)) == 3
    assert versions.remove_old_versions(spark, landed.table, now + timedelta(hours=2), timedelta()) == 0
    assert landed.amounts() == [0.0, 1.0, 2.0]


def test_a_hot_hour_is_written_by_several_tasks_in_one_shuffle(landed, monkeypatch):
    values = [paid(float(k), customerId=str(k)) for k in range(400)]
    for number in range(4):
        landed.epoch(number, *values[number::4], VIEW)
    size = sum(f.bytes for f in landed.files(23))
    plans, lay = [], versions.laid_out

    def noted(rows, files):
        plans.append(lay(rows, files)._jdf.queryExecution().executedPlan().toString())
        return lay(rows, files)

    monkeypatch.setattr(versions, "laid_out", noted)
    target, small = size // 3 + 1, sum(f.bytes for f in landed.files(5))
    versions.compact_hours(landed.spark, landed.table, [(DAY, 23), (DAY, 5)], target)
    assert len(landed.files(23)) == 3 and 1 <= len(landed.files(5)) <= -(-small // target)
    assert plans[0].count("Exchange") == 1 and "Join" not in plans[0]
    assert len(landed.amounts()) == 404


def test_hours_are_registered_in_blocks(landed, monkeypatch):
    monkeypatch.setattr(hours, "HOURS_PER_STATEMENT", 3)
    landed.epoch(0, *[{**VIEW, "timestamp": f"2024-01-01T{h:02}:00:00"} for h in range(8)])
    assert landed.spark.sql(f"SHOW PARTITIONS {landed.table}").count() == 8


def test_upkeep_of_a_folder_registers_hours_of_any_age(spark, landed):
    """Events that landed by path, one of them long ago."""
    path, rows = str(landed.base / "folder"), [VIEW, paid(3.0, timestamp="2022-11-27T05:00:00")]
    good = events.good_events(parsed(spark, *[json.dumps(v) for v in rows]))
    landing.land_epoch(good, path, "s/0", may_be_replay=False)
    table = f"{landed.table}_folder"
    maintenance.create_event_table(spark, table, path)
    jobs.upkeep_events(spark, table, path, datetime(2024, 1, 1, 23, 10))
    assert spark.table(table).count() == landing.read_events(spark, path).count() == 2
    assert not hours.touched_hours(spark, path)


def test_compaction_of_a_folder_splits_a_hot_hour(spark, landed, monkeypatch):
    path = str(landed.base / "folder")
    for number in range(5):
        values = [paid(float(k), customerId=str(k)) for k in range(number, 500, 5)]
        good = events.good_events(parsed(spark, *[json.dumps(v) for v in [*values, VIEW]]))
        landing.land_epoch(good, path, f"s/{number}", may_be_replay=False)
    sizes = {r.event_hour: r.bytes for r in maintenance.files_per_hour(spark, path).collect()}
    target = sizes[23] // 3 + 1
    plans, write = [], maintenance._write_hours

    def noted(rows, to, **options):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, to, **options)

    monkeypatch.setattr(maintenance, "_write_hours", noted)
    maintenance.compact_range(spark, path, DAY, date(2024, 1, 2), target_file_bytes=target)
    files = {r.event_hour: r.files for r in maintenance.files_per_hour(spark, path).collect()}
    assert files[23] == 3 and 1 <= files[5] <= -(-sizes[5] // target)
    assert plans[0].count("Exchange") == 1 and "Join" not in plans[0]
    assert landing.read_events(spark, path).count() == 505
