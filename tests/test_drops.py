"""Headers of many files in one job, and the archive of files taken."""

from test_loading import sale_line, write_file

from tillflow import fixed_values as V
from tillflow import jobs
from tillflow.sources import drops
from tillflow.streaming import raw_files


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    known, other = V.AGENT_COLUMNS, ("phone", *reversed(V.AGENT_COLUMNS))
    for number in range(500):
        header = other if number % 5 == 0 else known
        path = tmp_path / f"g {number % 7}" / f"{V.AGENTS_KIND}_{number}.csv"
        write_file(path, header, [f"{c} {number}" for c in header])
    (tmp_path / "g 1" / f"{V.AGENTS_KIND}_empty.csv").write_text("")
    paths = [str(p) for p in tmp_path.glob("*/*.csv")]
    # Jobs are numbered through; those of this thread's group alone are counted.
    spark.sparkContext.setJobGroup("headers", "headers")
    found = drops.files_by_header(spark, paths)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {header: len(files) for header, files in found.items()} == {known: 400, other: 100}
    # Listing so many files may be a job of its own.
    assert len(jobs) <= 2
    rows = drops.scan_drop(spark, str(tmp_path), V.AGENTS_KIND)
    assert sorted(r.name for r in rows.collect()) == sorted(f"name {n}" for n in range(500))


def test_only_the_first_line_of_a_file_of_several_splits_is_its_header(spark, tmp_path):
    path = tmp_path / "g" / f"{V.AGENTS_KIND}_1.csv"
    write_file(path, ("a b", 'q"'), *[[f"{k}", "x" * 50] for k in range(4000)])
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "16384")
    try:
        ((header, files),) = drops.files_by_header(spark, [str(path)]).items()
        assert header == ("a b", 'q"') and len(files) == 1 and files[0].endswith(str(path))
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 5
    finally:
        spark.conf.set(size, before)


def test_files_taken_go_to_the_archive(spark, tmp_path):
    folder, archive = tmp_path / "drops" / "g", tmp_path / "archive"
    zone = tmp_path / "zone"

    def drop(number):
        path = folder / f"{V.SALES_KIND}_{number}.csv"
        write_file(path, V.SALES_COLUMNS, sale_line(transaction_id=str(number)))

    def run(checkpoints="checkpoints", archive=str(archive)):
        jobs.land_new_files(spark, str(tmp_path / "drops"), str(zone), str(tmp_path / checkpoints), archive)
        rows = raw_files.read_raw_zone(spark, f"{zone}/{V.SALES_KIND}", V.SALES_KIND)
        return sorted(int(r.transaction_id) for r in rows.collect())

    for number in range(3):
        drop(number)
    assert run() == [0, 1, 2]
    assert not list(folder.glob("*.csv")) and len(list(archive.rglob("*.csv"))) == 3
    drop(3)
    assert run(archive=None) == [0, 1, 2, 3] and len(list(folder.glob("*.csv"))) == 1
    # As if the driver died before the commit: the batch is replayed and needs its file.
    commits = tmp_path / "checkpoints" / V.SALES_KIND / "commits"
    for name in ("1", ".1.crc"):
        (commits / name).unlink(missing_ok=True)
    state = [str(zone / V.SALES_KIND), str(tmp_path / "checkpoints" / V.SALES_KIND), str(archive)]
    assert raw_files.archive_taken(spark, *state) == 0
    assert run() == [0, 1, 2, 3]
    assert not list(folder.glob("*.csv")) and len(list(archive.rglob("*.csv"))) == 4
    # The drops hold no file taken, so a stream that knows none takes none again.
    drop(4)
    assert run("other checkpoints") == [0, 1, 2, 3, 4]
