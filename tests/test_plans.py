"""The plans that make the operators hold at scale."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from plan_checks import plan_text, rows_written_to_shuffle
from runtrail import schemas
from runtrail.operators import fold, pages, polls
from runtrail.plans import runs as plans
from runtrail.plans.catalogue import QUERIES
from runtrail.sources.derived import derived_table
from runtrail.sources.tables import by_run_date, read_table


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    """The derived tables as parquet, so that plans start at real scans."""
    path = tmp_path_factory.mktemp("landed")
    for name in schemas.TABLES:
        derived_table(spark, SMALL, name).write.parquet(f"{path}/{name}")
    return {name: read_table(spark, name, f"{path}/{name}") for name in schemas.TABLES}


@pytest.fixture
def big(spark):
    """Makes Spark treat every table as too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_no_query_leaves_the_jvm_or_crosses_tables(spark):
    landing = {n for n in QUERIES if n.startswith(("read_", "stream_", "sink_"))}
    for name in set(QUERIES) - landing:
        text = plan_text(QUERIES[name](spark, SMALL))
        for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
            assert word not in text, (name, word)


def test_fold_reads_only_candidate_lines_and_folds_before_the_shuffle(landed):
    text = plan_text(fold.fold_submit_log(landed["submit_log"]))
    assert text.count("Exchange") == 1
    assert "partial_max" in text
    assert "StringContains(line,application)" in text


def test_connections_are_broadcast_only_while_small(landed, big):
    flagged = plans.flagged_runs(landed["runs"], landed["connections"])
    assert "BroadcastHashJoin" not in plan_text(flagged)
    assert "SortMergeJoin" in plan_text(flagged)


def test_small_connections_are_broadcast(landed):
    flagged = plans.flagged_runs(landed["runs"], landed["connections"])
    assert plan_text(flagged).count("BroadcastHashJoin") == 1


def test_run_keyed_tables_are_never_broadcast_and_shuffled_once(landed):
    text = plan_text(plans.run_outcomes(
        landed["runs"], landed["connections"], landed["submit_log"], landed["status_polls"]
    ))
    assert text.count("BroadcastHashJoin") == 1
    assert text.count("SortMergeJoin") == 2
    # Runs, the fold of the log, the polls of all runs, the few polls that count, connections.
    assert text.count("Exchange hashpartitioning") == 5


def test_tracking_reads_the_polls_once(landed):
    text = plan_text(polls.track_polls(landed["status_polls"]))
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 2


def test_only_the_chosen_page_is_parsed(landed):
    text = plan_text(pages.first_log_text(landed["log_pages"]))
    parsed, _, below = text.partition("Exchange")
    assert "regexp_extract_all" in parsed and "regexp_extract_all" not in below


def test_unused_columns_are_not_read(landed):
    outcomes = plans.run_outcomes(
        landed["runs"], landed["connections"], landed["submit_log"], landed["status_polls"]
    )
    text = plan_text(outcomes.select("run_id", "outcome"))
    assert "ReadSchema: struct<run_id:bigint,conn_id:string,returncode:int>" in text
    assert "ReadSchema: struct<conn_id:string,host:string,port:int,extra:string>" in text


def test_text_never_reaches_a_shuffle(landed, big):
    lines = plan_text(fold.route_lines(
        landed["submit_log"], plans.flagged_runs(landed["runs"], landed["connections"])
    ))
    assert "line#" in lines
    for step in lines.split("Exchange")[:-1]:
        assert "Scan" not in step or "line#" not in step.rsplit("+-", 1)[-1]


@pytest.fixture
def tiny_partitions(spark, big):
    """Makes Spark see a partition as skewed at test size."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def test_hot_run_in_routing_is_split(spark, tiny_partitions):
    """One run holds nearly all lines; the join reads it in several pieces."""
    lines = spark.range(0, 200000, 1, 8).select(
        F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(1).alias("run_id"),
        F.col("id").cast("int").alias("line_no"),
        F.concat(F.lit("application_1_"), F.col("id").cast("string")).alias("line"),
    )
    runs = spark.range(0, 200000, 1, 4).select(F.col("id").alias("run_id"), F.lit("app").alias("route"))
    routed = fold.route_lines(lines, runs)
    routed.collect()
    assert "skew=true" in plan_text(routed)
    assert routed.where("application_id IS NOT NULL").count() == 200000


def test_hot_connection_is_split_where_connections_are_too_large_to_broadcast(spark, tiny_partitions):
    """Nearly all runs share one connection."""
    runs = spark.range(0, 200000, 1, 8).selectExpr(
        "id AS run_id", "CASE WHEN id % 50 = 0 THEN concat('c', id) ELSE 'c0' END AS conn_id",
        "CAST(NULL AS string) AS spark_binary", "CAST(NULL AS string) AS conf",
    )
    connections = spark.range(0, 200000, 1, 4).selectExpr(
        "concat('c', id) AS conn_id", "concat('h', id) AS host", "1 AS port", "'{}' AS extra",
    )
    resolved = plans.flagged_runs(runs, connections).select("run_id", "master")
    resolved.collect()
    assert "skew=true" in plan_text(resolved)
    assert resolved.where("master = 'h0:1'").count() == 196001


def test_hot_run_in_tracking_is_cut_to_eleven_polls_in_each_task(spark):
    """One run was polled 20000 times and failed each time, with no final state."""
    states = spark.range(1, 20001, 1, 4).select(
        F.when(F.col("id") < 0, 0).otherwise(1).alias("run_id"), F.col("id").cast("int").alias("poll_no"),
        F.lit("RUNNING").alias("state"), F.lit(1).alias("returncode"), F.lit(False).alias("malformed"),
    )
    stops = polls.stop_polls(states)
    assert rows_written_to_shuffle(stops) == 4 * 11
    row = stops.first()
    assert (row.tracked_state, row.stop_poll, row.misses) == ("POLL_GAVE_UP", 11, 11)


def test_polls_of_one_run_spread_over_tasks(landed):
    text = plan_text(polls.fold_polls(landed["status_polls"]))
    assert "Exchange hashpartitioning(run_id" in text and ", poll_no" in text
    assert text.count("Exchange") == 1 and "partial_max" in text


def test_pages_and_replies_fold_before_the_shuffle(landed):
    for frame in (pages.first_log_text(landed["log_pages"]), pages.first_history_reply(landed["history"])):
        text = plan_text(frame)
        assert text.count("Exchange") == 1 and "partial_min" in text


def test_one_page_is_parsed_once(landed):
    text = plan_text(pages.first_log_text(landed["log_pages"]))
    assert text.count("|[^<]+|<, 0)") == 1


def test_cjk_lines_are_filtered_without_a_shuffle(landed):
    text = plan_text(pages.cjk_lines(landed["pod_log"]))
    assert "Exchange" not in text


def test_same_result_for_any_partitioning_and_order(spark, landed):
    def outcomes(tables):
        frame = plans.run_outcomes(*(tables[n] for n in ("runs", "connections", "submit_log", "status_polls")))
        return sorted(frame.select("run_id", *fold.ID_COLUMNS, "outcome", "misses").collect())

    shuffled = {name: table.repartition(7).orderBy(F.rand(3)) for name, table in landed.items()}
    assert [str(r) for r in outcomes(landed)] == [str(r) for r in outcomes(shuffled)]
    assert schemas.TABLES.keys() == landed.keys()


def test_rows_get_the_date_of_their_run_without_a_broadcast(landed):
    starts = landed["runs"].selectExpr("run_id", "date'1998-03-01' AS run_date")
    dated = by_run_date(landed["submit_log"], starts)
    assert "Broadcast" not in plan_text(dated) and "SortMergeJoin" in plan_text(dated)
    assert dated.count() == landed["submit_log"].count()
