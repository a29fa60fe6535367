"""Whole questions about runs, put together from the operators.

Everything keys on ``run_id``: the runs, the fold of their logs and the stops of their
polls meet on one partitioning.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtrail.operators.connections import deployment_flags, executable_path, resolve_connections
from runtrail.operators.fold import fold_routed_log
from runtrail.operators.outcome import (
    classify_runs,
    cleanup_actions,
    error_texts,
    log_fetch_plan,
    mask_commands,
    poll_addresses,
)
from runtrail.operators.pages import app_log_address, first_log_text, pod_texts
from runtrail.operators.polls import fold_polls, stop_polls


def flagged_runs(runs: DataFrame, connections: DataFrame, via_operator=False) -> DataFrame:
    """Runs with their connection and kind of cluster."""
    return deployment_flags(resolve_connections(runs, connections, via_operator))


def routed_runs(runs, connections, submit_log) -> DataFrame:
    """Runs with connection, kind of cluster and the ids of their logs."""
    return fold_routed_log(submit_log, flagged_runs(runs, connections))


def run_outcomes(runs, connections, submit_log, status_polls) -> DataFrame:
    """Runs with everything that decides their outcome, and the outcome."""
    stops = stop_polls(fold_polls(status_polls))
    return classify_runs(routed_runs(runs, connections, submit_log), stops)


def run_cleanup(runs, connections, submit_log) -> DataFrame:
    """What is left to clean up of the cancelled runs."""
    # A comparison counts as selective, so Spark builds a Bloom filter of these runs' ids at run time
    # and reads the log through it, ahead of the fold.
    cancelled = runs.where(F.col("cancelled").eqNullSafe(F.lit(True)))
    return cleanup_actions(routed_runs(cancelled, connections, submit_log))


def run_report(
    runs, connections, submit_log, status_polls, app_info, log_pages, pod_log
) -> DataFrame:
    """All facts of each run in one row."""
    outcomes = mask_commands(run_outcomes(runs, connections, submit_log, status_polls))
    # The page that is read also says whether one was ready at all.
    pages = first_log_text(log_pages).select("run_id", "log_text", F.col("attempt").alias("page_attempt"))
    classified = error_texts(poll_addresses(executable_path(outcomes)))
    for facts in (app_log_address(app_info), pages, pod_texts(pod_log)):
        classified = classified.join(facts.hint("merge"), "run_id", "left")
    report = log_fetch_plan(classified, page_ready=F.col("page_attempt").isNotNull())
    return report.select(
        "run_id", "conn_id", "master", "deploy_mode", "queue", "namespace", "executable",
        "masked_command", "application_id", "driver_pod", "exit_code", "driver_id",
        "tracked_state", "misses", "outcome", "reason", "error_text", "poll_address",
        *[F.when(F.col("fetch_yarn"), F.col(c)).alias(c) for c in ("log_address", "log_text")],
        "fetch_pod",
        F.when(F.col("fetch_pod"), F.coalesce("pod_lines", F.lit(0))).alias("pod_lines"),
        *[F.when(F.col("fetch_pod"), F.col(c)).alias(c) for c in ("pod_first", "pod_last")],
    )
