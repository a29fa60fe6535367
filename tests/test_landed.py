"""Facts landed by run, replies landed as variants, and logs read through a runtime filter."""

import json
import uuid

import pytest
from conftest import SMALL
from plan_checks import plan_text, rows_written_to_shuffle
from pyspark.sql import functions as F

from runtrail import schemas
from runtrail.operators import pages
from runtrail.plans import catalogue
from runtrail.plans.by_run import buckets_for
from runtrail.plans import runs as plans
from runtrail.plans.by_run import RunTables
from runtrail.sources.derived import derived_table
from runtrail.sources.tables import land_replies, read_replies, read_table

KINDS = ("runs", "submit_log", "status_polls")


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("inputs")
    for name in (*KINDS, "connections"):
        derived_table(spark, SMALL, name).write.parquet(f"{path}/{name}")
    return {name: read_table(spark, name, f"{path}/{name}") for name in (*KINDS, "connections")}


@pytest.fixture
def by_run(spark, tmp_path):
    made = RunTables(spark, "t" + uuid.uuid4().hex, str(tmp_path), 3)
    yield made
    made.drop()


def everything(frame):
    columns = sorted(frame.columns)
    return sorted(map(str, frame.select(*columns).collect()))


def test_outcomes_of_landed_facts_need_no_exchange_by_run(inputs, by_run):
    runs, log, polls = (inputs[k] for k in KINDS)
    by_run.append(submit_log=log.where("line_no <= 3"), status_polls=polls.where("poll_no > 6"))
    by_run.append(submit_log=log.where("line_no > 3"), status_polls=polls.where("poll_no <= 6"), runs=runs)
    found = by_run.outcomes(inputs["connections"])
    assert "hashpartitioning(run_id" not in plan_text(found)
    expected = plans.run_outcomes(runs, inputs["connections"], log, polls)
    assert plan_text(expected).count("hashpartitioning(run_id") >= 3
    assert everything(found.select(*expected.columns)) == everything(expected)


def test_increments_that_come_again_change_only_the_count_of_notices(inputs, by_run):
    runs, log, polls = (inputs[k] for k in KINDS)
    for _ in range(2):
        by_run.append(submit_log=log.where("line_no > 2"), status_polls=polls.where("poll_no < 9"))
    by_run.append(runs, log.where("line_no <= 2"), polls.where("poll_no >= 9"))
    expected = plans.run_outcomes(runs, inputs["connections"], log, polls).drop("pod_notices")
    assert everything(by_run.outcomes(inputs["connections"]).select(*expected.columns)) == everything(expected)


def test_a_hot_run_lands_as_few_rows(spark, by_run):
    polls = spark.range(50_000).select(
        F.lit(7).cast("long").alias("run_id"), F.col("id").cast("int").alias("poll_no"), F.lit(1).alias("line_no"),
        F.lit('  "driverState" : "RUNNING",').alias("line"), (F.col("id") % 2).cast("int").alias("returncode"),
    )
    log = spark.range(50_000).select(
        F.lit(7).cast("long").alias("run_id"), F.col("id").cast("int").alias("line_no"),
        F.concat(F.lit("application_1_"), F.col("id").cast("string")).alias("line"),
    )
    by_run.append(submit_log=log, status_polls=polls)
    assert by_run._read("log_facts").count() == 1
    assert by_run._read("poll_facts").count() == 11


def test_runs_without_facts_and_empty_increments(spark, inputs, by_run):
    runs, log, polls = (inputs[k] for k in KINDS)
    by_run.append(runs, log.limit(0), polls.limit(0))
    expected = plans.run_outcomes(runs, inputs["connections"], log.limit(0), polls.limit(0))
    found = by_run.outcomes(inputs["connections"])
    assert everything(found.select(*expected.columns)) == everything(expected)


BODIES = [
    None, "", "no json", "[]", "{}", "7", "null", '{"app":{}}', '{"app":null}', '{"app":{"amContainerLogs":null}}',
    '{"app":{"amContainerLogs":"http://a/é\\n"}}', '{"attempts":[]}', '{"attempts":[{},{"a":[1,2]},3]}', '{"attempts":{}}',
    '{"attempts":null}', '{"attempts":"x"}',
    json.dumps([{"id": "1"}, {"id": "driver", "executorLogs": {"stdout": "o", "stderr": "e"}, "more": [1]}]),
    json.dumps([{"id": "driver"}, {"id": "driver", "executorLogs": {"stdout": "late"}}]),
    json.dumps([{"id": "driver", "executorLogs": {"stderr": "only"}}]), json.dumps([{"id": None}, {}]),
]


@pytest.mark.parametrize("name, question", [
    ("app_info", pages.app_log_address), ("executors", pages.driver_log_links),
    ("history", lambda h: pages.history_address(
        h.select("run_id", F.lit("application_1_1").alias("application_id")).distinct(), h, "http://h")),
])
def test_replies_landed_as_variants_say_what_their_text_says(spark, tmp_path, name, question):
    columns = {"run_id": "long", "attempt": "int", "status_code": "int", "body": "string"}
    values = {"attempt": 1, "status_code": 200}
    rows = [{"run_id": i, "body": b, **values} for i, b in enumerate(BODIES)] + [
        {"run_id": 99, "body": BODIES[16], "attempt": 1, "status_code": 500}]
    texts = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in columns.items()))
    texts = texts.select(*schemas.TABLES[name].names)
    land_replies(texts, f"{tmp_path}/r")
    landed = read_replies(spark, name, f"{tmp_path}/r")
    assert dict(landed.dtypes)["reply"] == "variant"
    assert everything(question(landed)) == everything(question(texts))


def test_logs_of_cancelled_runs_are_read_through_a_filter(spark, inputs):
    """What the Bloom filter lets through is folded; the rest of the log never reaches the fold."""
    runs, log = inputs["runs"], inputs["submit_log"]
    few = runs.withColumn("cancelled", F.col("run_id") % 50 == 0)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    few.write.mode("overwrite").parquet(path := inputs["runs"].inputFiles()[0].rsplit("/", 2)[0] + "/few")
    few = read_table(spark, "runs", path)
    question = lambda: plans.run_cleanup(few, inputs["connections"], log)
    plain = everything(question())
    moved = rows_written_to_shuffle(question())
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        lines = question()._jdf.queryExecution().optimizedPlan().toString().splitlines()
        scan = next(i for i, line in enumerate(lines) if "Relation" in line and ",line#" in line)
        # The node above the scan; what lies between belongs to the filter's own subquery.
        at = lines[scan].index("+- Relation") - 3
        above = next(line for line in reversed(lines[:scan]) if line[at:at + 2] in ("+-", ":-"))
        assert "Filter" in above and "might_contain" in above
        assert everything(question()) == plain
        assert rows_written_to_shuffle(question()) < moved / 3
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_buckets_grow_with_the_runs():
    assert [buckets_for(n) for n in (0, 800_000, 800_001, 54_000_000)] == [8, 8, 9, 540]


def test_streams_land_in_as_many_files_as_tasks_derive(spark, tmp_path, monkeypatch):
    """Each of the four batches takes its share of the files, however many there are."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    monkeypatch.setattr(catalogue, "new_folder", lambda spark, purpose: str(tmp_path))
    try:
        catalogue._landed_stream(spark, SMALL, "status_polls")
        assert len(list((tmp_path / "landed").glob("part-*"))) == 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
