"""App events and raw files as streams: restarts, replays, junk and late events."""

import json
import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from test_loading import sale_line, write_file

from tillflow import fixed_values as V
from tillflow import jobs
from tillflow import schemas as S
from tillflow.operators import maintenance
from tillflow.sources import tables
from tillflow.streaming import events, landing, raw_files

VIEW = {
    "eventType": "productView",
    "customerId": "1",
    "productId": "2",
    "timestamp": "2024-01-01T05:10:00",
    "metadata": {"category": "Books", "source": "Search"},
}
PURCHASE = {
    "eventType": "purchase",
    "customerId": "1",
    "productId": "2",
    "timestamp": "2024-01-01T23:59:59",
    "metadata": {},
    "quantity": 3,
    "totalAmount": 12.5,
    "paymentMethod": "PayPal",
}


def parsed(spark, *values):
    return events.parse_events(spark.createDataFrame([(v,) for v in values], "value string"))


def test_events_are_flattened(spark):
    good = events.good_events(parsed(spark, json.dumps(VIEW), json.dumps(PURCHASE)))
    assert [(f.name, f.dataType.simpleString()) for f in good.schema] == [
        *S.EVENT_COLUMNS.items(),
        *S.EVENT_PARTITIONS.items(),
    ]
    view, purchase = good.orderBy("timestamp").collect()
    assert (view.category, view.source, view.quantity) == ("Books", "Search", None)
    assert view.timestamp == datetime(2024, 1, 1, 5, 10)
    assert (view.event_date, view.event_hour) == (date(2024, 1, 1), 5)
    assert (purchase.quantity, purchase.totalAmount, purchase.paymentMethod) == (3, 12.5, "PayPal")
    assert (purchase.category, purchase.event_hour) == (None, 23)


def test_kafka_values_are_binary(spark):
    records = spark.createDataFrame([(bytearray(json.dumps(VIEW), "utf8"),)], "value binary")
    assert events.good_events(events.parse_events(records)).first().customerId == "1"


@pytest.mark.parametrize(
    "value, reason",
    [
        ("not json", "unreadable"),
        (None, "unreadable"),
        (json.dumps({**PURCHASE, "quantity": "many"}), "unreadable"),
        (json.dumps(PURCHASE)[:40], "unreadable"),
        (json.dumps({**VIEW, "timestamp": "bad"}), "no event time"),
        (json.dumps({**VIEW, "timestamp": "12:30:00"}), "no event time"),
        (json.dumps({"eventType": "purchase"}), "no event time"),
        (json.dumps({**PURCHASE, "totalAmount": "NaN"}), None),
    ],
)
def test_records_that_cannot_be_used_are_set_aside(spark, value, reason):
    frame = parsed(spark, value, json.dumps(VIEW))
    assert events.good_events(frame).count() == 1
    (reject,) = events.quarantine_events(frame).collect()
    assert reject.raw_value == value
    assert reason is None or reject.reject_reason == reason


def test_a_record_is_decoded_once(spark):
    plan = events.good_events(parsed(spark, "x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


class Stream:
    """A landing stream over text files in a folder."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        (base / "incoming").mkdir()
        self.table, self.rejects = str(base / "table"), str(base / "rejects")

    def drop(self, name, *values):
        lines = [v if isinstance(v, str) else json.dumps(v) for v in values]
        (self.base / "incoming" / name).write_text("\n".join(lines) + "\n")

    def run(self):
        source = events.event_source(self.spark, "text", {}, path=str(self.base / "incoming"))
        landing.land_events(
            source, self.table, self.rejects, str(self.base / "checkpoint"), availableNow=True
        ).awaitTermination()

    def read(self):
        return landing.read_events(self.spark, self.table)

    def forget_last_commit(self):
        """As if the driver died after the write and before the commit."""
        commits = self.base / "checkpoint" / "commits"
        last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
        for path in (commits / str(last), commits / f".{last}.crc"):
            path.unlink(missing_ok=True)


@pytest.fixture
def stream(spark, tmp_path):
    return Stream(spark, tmp_path)


def amounts(stream):
    rows = stream.read().select(F.coalesce("totalAmount", F.lit(0.0)).alias("a")).collect()
    return sorted(row.a for row in rows)


def test_landing_partitions_by_event_time_and_keeps_rejects(stream):
    stream.drop("a", VIEW, PURCHASE, "junk")
    stream.run()
    hours = [
        (row.event_date, row.event_hour)
        for row in stream.read()
        .select(landing.PARTITIONS)
        .distinct()
        .orderBy("event_hour")
        .collect()
    ]
    assert hours == [(date(2024, 1, 1), 5), (date(2024, 1, 1), 23)]
    assert (stream.base / "table" / "event_date=2024-01-01" / "event_hour=5").is_dir()
    rejects = stream.spark.read.parquet(stream.rejects).collect()
    assert [(row.raw_value, row.reject_reason) for row in rejects] == [("junk", "unreadable")]


def test_restart_takes_only_what_is_new_and_late_events_join_their_hour(stream):
    stream.drop("a", PURCHASE)
    stream.run()
    stream.run()
    assert amounts(stream) == [12.5]
    late = {**PURCHASE, "timestamp": "2023-12-31T00:00:00"}
    stream.drop("b", {**PURCHASE, "totalAmount": 1.0}, late)
    stream.run()
    assert amounts(stream) == [1.0, 12.5, 12.5]
    landed = stream.read().where("event_date = '2023-12-31' and event_hour = 0")
    assert landed.count() == 1


def test_a_replayed_batch_replaces_its_own_rows(stream):
    stream.drop("a", PURCHASE, "junk 1")
    stream.run()
    stream.drop("b", {**PURCHASE, "totalAmount": 2.0}, VIEW, "junk 2")
    stream.run()
    before = sorted(map(str, stream.read().collect()))
    stream.forget_last_commit()
    stream.run()
    assert sorted(map(str, stream.read().collect())) == before
    assert stream.spark.read.parquet(stream.rejects).count() == 2


def test_a_batch_replayed_after_a_compaction_is_recognised(stream):
    stream.drop("a", PURCHASE)
    stream.run()
    stream.drop("b", {**PURCHASE, "totalAmount": 2.0})
    stream.run()
    assert maintenance.compact_partition(stream.spark, stream.table, date(2024, 1, 1), 23)
    stream.forget_last_commit()
    stream.run()
    assert amounts(stream) == [2.0, 12.5]


def test_a_half_written_batch_is_completed(stream):
    stream.drop("a", {**PURCHASE, "totalAmount": 7.0}, {**VIEW, "timestamp": "2024-01-02T01:00:00"})
    stream.run()
    whole = events.good_events(parsed(stream.spark, json.dumps(VIEW), json.dumps(PURCHASE)))
    landing.land_epoch(whole.where("event_hour = 23"), stream.table, "s/9", may_be_replay=True)
    landing.land_epoch(whole, stream.table, "s/9", may_be_replay=True)
    assert amounts(stream) == [0.0, 0.0, 7.0, 12.5]


def test_the_same_batch_number_of_another_stream_is_other_data(stream):
    rows = events.good_events(parsed(stream.spark, json.dumps(PURCHASE)))
    landing.land_epoch(rows, stream.table, "s1/0", may_be_replay=True)
    landing.land_epoch(rows, stream.table, "s2/0", may_be_replay=True)
    assert amounts(stream) == [12.5, 12.5]


def files_of(stream, hour):
    folder = stream.base / "table" / "event_date=2024-01-01" / f"event_hour={hour}"
    return list(folder.glob("part-*.parquet"))


def test_compaction_leaves_one_file_and_all_rows(stream):
    for number in range(3):
        stream.drop(f"f{number}", {**PURCHASE, "totalAmount": float(number)}, VIEW)
        stream.run()
    assert len(files_of(stream, 23)) == len(files_of(stream, 5)) == 3
    before = sorted(map(str, stream.read().collect()))
    spark, day = stream.spark, date(2024, 1, 1)
    assert maintenance.compact_partition(spark, stream.table, day, 23) is True
    assert (len(files_of(stream, 23)), len(files_of(stream, 5))) == (1, 3)
    assert maintenance.compact_partition(spark, stream.table, day, 23) is False
    assert maintenance.compact_partition(spark, stream.table, day, 4) is False
    assert sorted(map(str, stream.read().collect())) == before
    maintenance.compact_range(spark, stream.table, day, date(2024, 1, 2))
    assert (len(files_of(stream, 23)), len(files_of(stream, 5))) == (1, 1)
    assert sorted(map(str, stream.read().collect())) == before


def test_compaction_keeps_large_hours_in_several_files(stream):
    for number in range(4):
        stream.drop(f"f{number}", VIEW)
        stream.run()
    size = sum(path.stat().st_size for path in files_of(stream, 5))
    maintenance.compact_partition(
        stream.spark, stream.table, date(2024, 1, 1), 5, target_file_bytes=size // 2 + 1
    )
    assert len(files_of(stream, 5)) == 2
    assert stream.read().count() == 4


@pytest.mark.parametrize("late", [False, True])
def test_a_swap_cut_off_half_way_loses_no_row(stream, monkeypatch, late):
    for number in range(2):
        stream.drop(f"f{number}", {**PURCHASE, "totalAmount": float(number)}, VIEW)
        stream.run()
    spark, day = stream.spark, date(2024, 1, 1)
    swap = maintenance._swap

    def cut_off(spark, path, staged):
        for file in files_of(stream, 23):
            file.unlink()
        raise RuntimeError("driver lost")

    monkeypatch.setattr(maintenance, "_swap", cut_off)
    with pytest.raises(RuntimeError, match="driver lost"):
        maintenance.compact_range(spark, stream.table, day, date(2024, 1, 2))
    assert amounts(stream) == [0.0, 0.0]
    monkeypatch.setattr(maintenance, "_swap", swap)
    if late:
        stream.drop("late", {**PURCHASE, "totalAmount": 9.0})
        stream.run()
    assert maintenance.finish_compaction(spark, stream.table)
    assert amounts(stream) == [0.0, 0.0, 0.0, 1.0] + [9.0] * late
    assert not maintenance.finish_compaction(spark, stream.table)
    assert len(files_of(stream, 23)) == 1


def test_compaction_skips_hours_that_are_one_file_or_open(stream):
    early = {**VIEW, "timestamp": "2024-01-01T04:00:00"}
    for number in range(2):
        stream.drop(f"f{number}", VIEW, PURCHASE, *[early] * (number == 0))
        stream.run()
    (kept,) = files_of(stream, 4)
    day, spark = date(2024, 1, 1), stream.spark
    now = datetime(2024, 1, 1, 23, 10)
    done = maintenance.compact_range(
        spark, stream.table, day, date(2024, 1, 2), closed_before=now.replace(minute=0)
    )
    assert [tuple(row) for row in done.collect()] == [(day, 5)]
    assert files_of(stream, 4) == [kept]
    assert (len(files_of(stream, 5)), len(files_of(stream, 23))) == (1, 2)
    assert maintenance.compact_range(spark, stream.table, day, day) is None


def test_a_micro_batch_leaves_one_file_per_hour(stream):
    for number in range(6):
        stream.drop(f"f{number}", VIEW, PURCHASE)
    stream.run()
    assert (len(files_of(stream, 5)), len(files_of(stream, 23))) == (1, 1)


def test_hourly_upkeep_compacts_closed_hours_and_then_registers_them(spark, stream):
    for number in range(2):
        stream.drop(f"f{number}", VIEW, PURCHASE)
        stream.run()
    tables.create_database(spark, "app")
    table = f"app.upkeep_{stream.base.name.replace('-', '_')}"
    maintenance.create_event_table(spark, table, stream.table)
    jobs.upkeep_events(spark, table, stream.table, datetime(2024, 1, 1, 23, 10), days_back=1)
    assert (len(files_of(stream, 5)), len(files_of(stream, 23))) == (1, 2)
    assert spark.table(table).count() == 4


def test_a_file_with_another_header_does_not_stop_the_landing(spark, tmp_path):
    folder, zone = tmp_path / "drops" / "g", str(tmp_path / "zone")
    known, more = V.AGENT_COLUMNS, ("phone", *reversed(V.AGENT_COLUMNS))
    write_file(folder / f"{V.AGENTS_KIND}_1.csv", known, [f"{c} 1" for c in known])
    write_file(folder / f"{V.AGENTS_KIND}_2.csv", more, [f"{c} 2" for c in more])
    write_file(folder / f"{V.AGENTS_KIND}_3.csv", known[:1], ["5"])
    raw_files.land_raw_files(
        spark,
        str(tmp_path / "drops"),
        V.AGENTS_KIND,
        zone,
        str(tmp_path / "checkpoint"),
        availableNow=True,
    ).awaitTermination()
    rows = raw_files.read_raw_zone(spark, zone, V.AGENTS_KIND).select(*known).collect()
    assert sorted(map(tuple, rows)) == [tuple(f"{c} {n}" for c in known) for n in (1, 2)]
    (aside,) = spark.read.parquet(raw_files.set_aside_folder(zone)).collect()
    assert aside.source_file.endswith("_3.csv")
    assert aside.missing == ", ".join(known[1:])


def test_compaction_before_anything_landed_does_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    assert maintenance.compact_partition(spark, path, date(2024, 1, 1), 5) is False


def test_closed_hour():
    assert maintenance.closed_hour(datetime(2024, 1, 2, 0, 5)) == (date(2024, 1, 1), 23)
    assert maintenance.closed_hour(datetime(2024, 1, 2, 12, 5), lag_hours=3) == (date(2024, 1, 2), 9)


def test_repair_makes_new_partitions_visible(spark, stream):
    stream.drop("a", VIEW)
    stream.run()
    tables.create_database(spark, "app")
    table = f"app.events_{stream.base.name.replace('-', '_')}"
    maintenance.create_event_table(spark, table, stream.table)
    assert spark.table(table).count() == 0
    assert maintenance.repair_partitions(spark, table).count() == 1
    stream.drop("b", PURCHASE)
    stream.run()
    assert maintenance.repair_partitions(spark, table).count() == 2
    assert maintenance.repair_partitions(spark, table).count() == 2


def test_each_raw_file_is_landed_once(spark, tmp_path):
    def run():
        raw_files.land_raw_files(
            spark,
            str(tmp_path / "drops"),
            V.SALES_KIND,
            str(tmp_path / "zone"),
            str(tmp_path / "checkpoint"),
            max_files=1,
            availableNow=True,
        ).awaitTermination()
        return raw_files.read_raw_zone(spark, str(tmp_path / "zone"), V.SALES_KIND)

    for group in ("group1", "group2"):
        path = tmp_path / "drops" / group / f"{V.SALES_KIND}_1.csv"
        write_file(path, V.SALES_COLUMNS, sale_line(), sale_line(transaction_id="2"))
    zone = run()
    assert zone.count() == 4
    assert zone.select(raw_files.INGEST_EPOCH).distinct().count() == 2
    assert run().count() == 4

    commits = tmp_path / "checkpoint" / "commits"
    for name in ("1", ".1.crc"):
        (commits / name).unlink(missing_ok=True)
    assert run().count() == 4

    write_file(
        tmp_path / "drops" / "group3" / f"{V.SALES_KIND}_1.csv", V.SALES_COLUMNS, sale_line()
    )
    zone = run()
    assert zone.count() == 5
    hour = zone.first()[raw_files.INGEST_HOUR]
    assert raw_files.read_raw_zone(spark, str(tmp_path / "zone"), V.SALES_KIND, hour).count() > 0
    assert zone.select(raw_files.SOURCE_FILE).distinct().count() == 3


@pytest.mark.parametrize("kind", ["raw files", "text events"])
def test_files_of_any_age_are_taken(spark, tmp_path, kind):
    drops, zone = tmp_path / "drops" / "g", str(tmp_path / "zone")

    def run():
        if kind == "raw files":
            stream = raw_files.land_raw_files(
                spark,
                str(tmp_path / "drops"),
                V.SALES_KIND,
                zone,
                str(tmp_path / "checkpoint"),
                availableNow=True,
            )
        else:
            stream = (
                events.event_source(spark, "text", {}, path=str(drops))
                .writeStream.option("checkpointLocation", str(tmp_path / "checkpoint"))
                .trigger(availableNow=True)
                .start(zone, format="parquet")
            )
        stream.awaitTermination()
        return spark.read.parquet(zone).count()

    write_file(drops / f"{V.SALES_KIND}_new.csv", V.SALES_COLUMNS, sale_line())
    first = run()
    old = drops / f"{V.SALES_KIND}_old.csv"
    write_file(old, V.SALES_COLUMNS, sale_line(transaction_id="2"))
    long_ago = time.time() - 400 * 86400
    os.utime(old, (long_ago, long_ago))
    assert run() == 2 * first
