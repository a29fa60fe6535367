import random
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from runtrail import schemas
from runtrail.operators import fold, polls
from runtrail.sources.derived import derived_table
from runtrail.sources.tables import stream_table
from runtrail.streaming import parts

ONE_FILE = {"maxFilesPerTrigger": 1}


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def land(table, path, files):
    """The table cut into files at random, so that runs and polls spread over several."""
    table.repartition(files, F.xxhash64(*table.columns)).write.mode("append").parquet(path)


@pytest.fixture
def log(spark):
    return derived_table(spark, SMALL, "submit_log").where("run_id % 5 = 0")


@pytest.fixture
def status_polls(spark):
    return derived_table(spark, SMALL, "status_polls").where("run_id % 5 = 0")


def test_stream_fold_equals_the_batch_fold(spark, log, tmp_path):
    land(log, f"{tmp_path}/in", 4)

    def run():
        lines = stream_table(spark, "submit_log", f"{tmp_path}/in", **ONE_FILE)
        query = parts.stream_fold(lines, f"{tmp_path}/parts", f"{tmp_path}/state")
        query.awaitTermination()

    run()
    batches = list((tmp_path / "parts").glob("stream_batch=*"))
    assert len(batches) == 4
    assert rows(parts.read_fold(spark, f"{tmp_path}/parts")) == rows(fold.fold_submit_log(log))

    more = spark.createDataFrame([(5, 99, "application_99"), (-1, 1, "application_1")], schemas.SUBMIT_LOG)
    land(more, f"{tmp_path}/in", 1)
    run()
    whole = fold.fold_submit_log(log.unionByName(more))
    assert rows(parts.read_fold(spark, f"{tmp_path}/parts")) == rows(whole)


def test_a_repeated_batch_counts_once(spark, log, tmp_path):
    """A new checkpoint makes Spark deliver everything again under the same numbers."""
    land(log, f"{tmp_path}/in", 2)
    for attempt in (1, 2):
        lines = stream_table(spark, "submit_log", f"{tmp_path}/in")
        query = parts.stream_fold(lines, f"{tmp_path}/parts", f"{tmp_path}/state-{attempt}")
        query.awaitTermination()
    assert rows(parts.read_fold(spark, f"{tmp_path}/parts")) == rows(fold.fold_submit_log(log))


def test_stateful_fold_equals_the_batch_fold(spark, log, tmp_path):
    land(log, f"{tmp_path}/in", 3)
    lines = stream_table(spark, "submit_log", f"{tmp_path}/in", **ONE_FILE)
    updates = parts.stateful_fold(lines)
    parts.append_updates(updates, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    latest = parts.latest_updates(spark, f"{tmp_path}/out")
    assert rows(latest) == rows(fold.fold_submit_log(log))


def test_stateful_fold_in_complete_mode(spark, log, tmp_path):
    land(log, f"{tmp_path}/in", 2)
    lines = stream_table(spark, "submit_log", f"{tmp_path}/in", **ONE_FILE)
    query = (
        parts.stateful_fold(lines).writeStream.outputMode("complete").format("memory")
        .queryName("folded").option("checkpointLocation", f"{tmp_path}/state").start()
    )
    query.processAllAvailable()
    query.stop()
    assert rows(spark.table("folded")) == rows(fold.fold_submit_log(log))


def test_stream_track_equals_the_batch_tracking(spark, status_polls, tmp_path):
    land(status_polls, f"{tmp_path}/in", 4)
    stream = stream_table(spark, "status_polls", f"{tmp_path}/in", **ONE_FILE)
    parts.stream_track(stream, f"{tmp_path}/parts", f"{tmp_path}/state").awaitTermination()
    assert len(list((tmp_path / "parts").glob("stream_batch=*"))) == 4
    streamed = parts.read_track(spark, f"{tmp_path}/parts")
    assert rows(streamed) == rows(polls.track_polls(status_polls))


def test_lines_of_one_poll_may_come_in_several_batches_and_out_of_order(spark, tmp_path):
    lines = [
        (1, 1, 2, '"driverState" : "RUNNING"', 0), (1, 1, 1, '"driverState" : "FAILED"', 0),
        (1, 2, 1, "{", 0), (1, 2, 2, '"driverState" : "KILLED"', 0),
        (2, 1, 1, "nothing", 0),
    ]
    random.Random(2).shuffle(lines)
    for line in lines:
        land(spark.createDataFrame([line], schemas.STATUS_POLLS), f"{tmp_path}/in", 1)
    stream = stream_table(spark, "status_polls", f"{tmp_path}/in", **ONE_FILE)
    parts.stream_track(stream, f"{tmp_path}/parts", f"{tmp_path}/state").awaitTermination()
    found = {r.run_id: (r.tracked_state, r.stop_poll)
             for r in parts.read_track(spark, f"{tmp_path}/parts").collect()}
    assert found == {1: ("KILLED", 2), 2: ("UNKNOWN", 1)}


def test_compaction_changes_no_result(spark, log, status_polls, tmp_path):
    land(log, f"{tmp_path}/log", 4)
    lines = stream_table(spark, "submit_log", f"{tmp_path}/log", **ONE_FILE)
    parts.stream_fold(lines, f"{tmp_path}/folds", f"{tmp_path}/state-1").awaitTermination()
    land(status_polls, f"{tmp_path}/polls", 3)
    stream = stream_table(spark, "status_polls", f"{tmp_path}/polls", **ONE_FILE)
    parts.stream_track(stream, f"{tmp_path}/tracks", f"{tmp_path}/state-2").awaitTermination()
    for upto in (0, 2, 9):
        merged = parts.compact_fold(spark, f"{tmp_path}/folds", upto, f"{tmp_path}/merged-folds-{upto}")
        found = parts.read_fold(spark, f"{tmp_path}/folds", merged)
        assert rows(found) == rows(fold.fold_submit_log(log))
        merged = parts.compact_track(spark, f"{tmp_path}/tracks", upto, f"{tmp_path}/merged-tracks-{upto}")
        found = parts.read_track(spark, f"{tmp_path}/tracks", merged)
        assert rows(found) == rows(polls.track_polls(status_polls))


def test_a_compaction_goes_on_from_the_last_one(spark, log, tmp_path):
    land(log, f"{tmp_path}/in", 4)
    lines = stream_table(spark, "submit_log", f"{tmp_path}/in", **ONE_FILE)
    parts.stream_fold(lines, f"{tmp_path}/folds", f"{tmp_path}/state").awaitTermination()
    first = parts.compact_fold(spark, f"{tmp_path}/folds", 1, f"{tmp_path}/merged-1")
    shutil.rmtree(tmp_path / "folds" / f"{parts.BATCH}=0")  # the batches it has merged are not read again
    shutil.rmtree(tmp_path / "folds" / f"{parts.BATCH}=1")
    later = parts.compact_fold(spark, f"{tmp_path}/folds", 2, f"{tmp_path}/merged-2", last=first)
    for merged in (first, later):
        assert rows(parts.read_fold(spark, f"{tmp_path}/folds", merged)) == rows(fold.fold_submit_log(log))
    with pytest.raises(Exception, match="already exists"):
        parts.compact_fold(spark, f"{tmp_path}/folds", 3, f"{tmp_path}/merged-1", last=later)


def test_many_polls_are_dealt_to_more_tasks(spark, status_polls, tmp_path, monkeypatch):
    """What a task sorts stays the same however many polls come in."""
    monkeypatch.setattr(parts, "ROWS_PER_TASK", 100)
    land(status_polls, f"{tmp_path}/in", 1)
    stream = stream_table(spark, "status_polls", f"{tmp_path}/in")
    parts.stream_track(stream, f"{tmp_path}/parts", f"{tmp_path}/state").awaitTermination()
    tasks = -(-status_polls.count() // 100)
    assert len(list((tmp_path / "parts").glob("stream_batch=0/part-*"))) > tasks / 2 > 4
    tracked = parts.read_track(spark, f"{tmp_path}/parts")
    polled = tracked._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [run_id" in polled
    assert rows(tracked) == rows(polls.track_polls(status_polls))
