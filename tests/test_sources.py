import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from runtrail import schemas
from runtrail.operators import fold
from runtrail.sources import tables
from runtrail.sources.derived import derived_stream, derived_table
from runtrail.sources.workdir import new_folder


@pytest.mark.parametrize("name", schemas.TABLES)
def test_derived_tables_have_the_stated_schema(spark, name):
    kinds = [(f.name, f.dataType) for f in derived_table(spark, SMALL, name).schema]
    assert kinds == [(f.name, f.dataType) for f in schemas.TABLES[name]]


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_tables_are_read_with_their_schema(spark, tmp_path, fmt):
    runs = derived_table(spark, SMALL, "runs")
    runs.write.format(fmt).save(f"{tmp_path}/runs")
    read = tables.read_table(spark, "runs", f"{tmp_path}/runs", fmt)
    assert read.schema == schemas.RUNS
    assert sorted(read.collect(), key=str) == sorted(runs.collect(), key=str)


def test_named_readers(spark, tmp_path):
    readers = {
        "submit_log": tables.read_submit_log, "status_polls": tables.read_status_polls,
        "app_info": tables.read_app_info, "history": tables.read_history,
        "executors": tables.read_executors, "log_pages": tables.read_log_pages,
        "pod_log": tables.read_pod_log,
    }
    for name, read in readers.items():
        spark.createDataFrame([], schemas.TABLES[name]).write.parquet(f"{tmp_path}/{name}")
        assert read(spark, f"{tmp_path}/{name}").schema == schemas.TABLES[name]
    spark.createDataFrame([(1, b"x")], schemas.POD_LOG_BYTES).write.parquet(f"{tmp_path}/bytes")
    assert tables.read_pod_log_bytes(spark, f"{tmp_path}/bytes").first().log == b"x"


def test_text_logs_keep_their_line_order(spark, tmp_path):
    """A log is cut into many blocks; the place of a line still gives first and last."""
    for run in (1, 2):
        folder = tmp_path / f"run_id={run}"
        folder.mkdir()
        lines = [f"application_{run}_{n} driver-{n}" for n in range(5000)]
        (folder / "submit.log").write_bytes("\n".join(lines).encode())
    odd = tmp_path / "run_id=3"
    odd.mkdir()
    (odd / "submit.log").write_bytes(b"application_1\r\napplication_2\rapplication_3\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        log = tables.read_submit_log_text(spark, str(tmp_path))
        assert log.rdd.getNumPartitions() > 5
        ids = {r.run_id: r for r in fold.fold_submit_log(log).collect()}
        counts = {r.run_id: r["count"] for r in log.groupBy("run_id").count().collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert counts == {1: 5000, 2: 5000, 3: 4}
    for run in (1, 2):
        assert ids[run].application_id == f"application_{run}_4999"
        assert ids[run].announced_application_id == f"application_{run}_0"
        assert ids[run].driver_id == "driver-0"
    assert (ids[3].application_id, ids[3].announced_application_id) == ("application_3", "application_1")


def test_shared_text_logs_number_each_runs_lines(spark, tmp_path):
    """Many runs in few files; a long run spans splits, null runs and lines and line ends are kept."""
    rows = [(1, n, f"line {n}") for n in range(3000)] + [(run, n, f"{run}\t{n}") for run in range(2, 300) for n in (1, 2)]
    rows += [(None, 1, "lost"), (400, 1, None), (400, 2, "a\r\nb\rc\n"), (400, 3, "")]
    log = spark.createDataFrame(rows, schemas.SUBMIT_LOG)
    tables.write_shared_text(log, f"{tmp_path}/text")
    assert len(list((tmp_path / "text").glob("part-*"))) < 10
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        read = tables.read_submit_log_text(spark, f"{tmp_path}/text", shared=True)
        found = sorted(map(tuple, read.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = [(1, n + 1, f"line {n}") for n in range(3000)] + [(run, n, f"{run}\t{n}") for run in range(2, 300) for n in (1, 2)]
    expected += [(None, 1, "lost")] + [(400, n, t) for n, t in enumerate(["", "a", "b", "c", "", ""], 1)]
    assert found == sorted(expected, key=str)


def test_facts_are_partitioned_by_date(spark, tmp_path):
    facts = spark.range(100).select(
        F.col("id").alias("run_id"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 3).cast("int")).alias("run_date")
    )
    tables.write_facts(facts, f"{tmp_path}/facts")
    read = spark.read.parquet(f"{tmp_path}/facts")
    assert sorted(p.name for p in (tmp_path / "facts").glob("run_date=*")) == [
        "run_date=2024-01-01", "run_date=2024-01-02", "run_date=2024-01-03",
    ]
    assert read.count() == 100
    day = read.where("run_date = '2024-01-02'")
    assert len(day.inputFiles()) and day.count() == 33


def test_streamed_facts_are_written_once_by_date(spark, tmp_path):
    day = F.concat(F.lit("2024-01-0"), F.col("run_id") % 2 + 1).cast("date").alias("run_date")
    lines = spark.createDataFrame([(n, 1, f"driver-{n}") for n in range(20)], schemas.SUBMIT_LOG)
    for _ in range(2):
        lines.write.mode("append").parquet(f"{tmp_path}/in")
        stream = tables.stream_table(spark, "submit_log", f"{tmp_path}/in")
        found = fold.line_ids(stream).select("run_id", "driver_id", day)
        tables.stream_facts(
            found, f"{tmp_path}/out", f"{tmp_path}/state", date="run_date"
        ).awaitTermination()
    read = spark.read.parquet(f"{tmp_path}/out")
    assert read.count() == 40 and read.where("run_date = '2024-01-02'").count() == 20


def test_stream_of_a_derived_table_is_a_stream(spark):
    stream = derived_stream(spark, SMALL, "submit_log")
    assert stream.isStreaming and stream.columns == ["run_id", "line_no", "line"]


def test_work_folder_lies_in_the_shared_folder(spark, tmp_path, monkeypatch):
    before = spark.conf.get("spark.checkpoint.dir", None)

    class Session:
        def __init__(self, **settings):
            self.conf = self
            self.settings = {k.replace("_", "."): v for k, v in settings.items()}

        def get(self, key, default=None):
            return self.settings.get(key, default)

    shared = new_folder(Session(spark_checkpoint_dir="/shared/", spark_master="spark://h:7077"), "x")
    assert shared.startswith("/shared/x-")
    with pytest.raises(ValueError):
        new_folder(Session(spark_master="spark://h:7077"), "x")
    if before:
        assert new_folder(spark, "x").startswith(before)
