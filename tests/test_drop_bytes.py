"""What the drops of the test tables take."""

import gzip

import __spark_entry__ as entry
from tillflow import fixed_values as V
from tillflow.sources import drops, tpch

FOLDER = "/root/testdata/sf0.001"


def test_drops_are_packed_and_hold_each_line_once(spark, tmp_path):
    entry._write_sales_drops(spark, FOLDER, str(tmp_path))
    files = [p for p in tmp_path.glob(f"*/{V.SALES_KIND}_*.csv/*") if p.name.startswith("part-")]
    plain = sum(len(gzip.decompress(p.read_bytes())) for p in files)
    assert sum(p.stat().st_size for p in files) < plain / 3
    raw = tpch.raw_sales(spark, FOLDER)
    back = drops.scan_drop(spark, str(tmp_path), V.SALES_KIND)
    assert back.count() == raw.count()
    assert back.exceptAll(raw).count() == 0
    for group, online in ((1, True), (2, False)):
        rows = spark.read.option("header", True).csv(f"{tmp_path}/group={group}/{V.SALES_KIND}_file=1.csv")
        assert {r.is_online == V.ONLINE_WORD for r in rows.select("is_online").distinct().collect()} == {online}


def test_drops_without_sales_have_a_header(spark, tmp_path):
    for name in ("nation", "region", "customer", "supplier", "part", "orders"):
        tpch.table(spark, FOLDER, name).write.parquet(f"{tmp_path}/in/{name}.parquet")
    tpch.table(spark, FOLDER, "lineitem").limit(0).write.parquet(f"{tmp_path}/in/lineitem.parquet")
    entry._write_sales_drops(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    rows = drops.scan_drop(spark, f"{tmp_path}/out", V.SALES_KIND)
    assert rows.columns == list(V.SALES_COLUMNS) and rows.count() == 0
