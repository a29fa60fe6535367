"""From log lines to the ids of each run.

The ids depend on line order, so every pick is a minimum or maximum over a struct that
starts with ``line_no``. Such picks merge: map tasks shrink a run's lines to one row
before the shuffle, however long its log is, and folds of parts fold to the whole.
``line_no`` may be any orderable type.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtrail import fixed_values as fixed
from runtrail.functions import text

ID_COLUMNS = ("application_id", "driver_pod", "exit_code", "driver_id")


def line_ids(log: DataFrame, *keep: str) -> DataFrame:
    """Every line with the ids found in it. The text is dropped unless kept by name."""
    line = F.col("line")
    return log.select(
        "run_id", "line_no", *keep,
        text.application_id(line).alias("application_id"),
        text.driver_pod(line).alias("driver_pod"),
        text.exit_digits(line).alias("exit_digits"),
        text.driver_id(line).alias("driver_id"),
    )


def extract_line_ids(log: DataFrame) -> DataFrame:
    found = line_ids(log)
    code = F.col("exit_digits").try_cast("bigint")
    return found.withColumn("exit_code", code).drop("exit_digits")


def route_lines(log: DataFrame, flagged_runs: DataFrame) -> DataFrame:
    """Per line: the kind of id its run is searched for and what the line holds of it.

    The ids are taken out before the join, so the text never reaches the shuffle. A run
    with very many lines is split by the adaptive skew join.
    """
    routes = flagged_runs.select("run_id", "route")
    wanted = {
        "application_id": "app", "driver_pod": "pod", "exit_code": "pod", "driver_id": "driver",
    }
    routed = extract_line_ids(log).join(routes, "run_id", "left")
    return routed.select(
        "run_id", "line_no", "route",
        *[F.when(F.col("route") == r, F.col(c)).alias(c) for c, r in wanted.items()],
    )


def fold_parts(log: DataFrame) -> DataFrame:
    """Mergeable picks per run: last application, pod and exit code, first driver and notice."""
    line = F.col("line")
    candidate = (
        line.contains(fixed.APPLICATION_TEXT) | line.contains(fixed.POD_TEXT)
        | line.contains(fixed.EXIT_TEXT) | line.contains(fixed.DRIVER_TEXT)
    )

    return picks_of_ids(log.where(candidate))


def picks_of_ids(log: DataFrame, *by, keep: tuple = ()) -> DataFrame:
    """The picks over all given lines, per run and whatever else they are grouped by."""

    def at_line(name):
        return f"CASE WHEN {name} IS NOT NULL THEN struct(line_no, {name} AS value) END"

    return line_ids(log, *keep).groupBy("run_id", *by).agg(
        F.expr(f"max({at_line('application_id')}) AS last_application"),
        F.expr(f"min({at_line('application_id')}) AS first_application"),
        F.expr(f"max({at_line('driver_pod')}) AS last_pod"),
        F.expr("count(driver_pod) AS pod_notices"),
        F.expr(f"max({at_line('exit_digits')}) AS last_exit"),
        F.expr(f"min({at_line('driver_id')}) AS first_driver"),
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """Fold the picks of several parts of the logs into one row per run."""
    return parts.groupBy("run_id").agg(
        F.max("last_application").alias("last_application"),
        F.min("first_application").alias("first_application"),
        F.max("last_pod").alias("last_pod"),
        F.sum("pod_notices").alias("pod_notices"),
        F.max("last_exit").alias("last_exit"),
        F.min("first_driver").alias("first_driver"),
    )


def ids_of_parts(parts: DataFrame) -> DataFrame:
    """The ids of each run, and what was announced about them while the log was read."""
    return parts.selectExpr(
        "run_id",
        "last_application.value AS application_id",
        "last_pod.value AS driver_pod",
        "try_cast(last_exit.value AS bigint) AS exit_code",
        "last_exit.value AS exit_digits",
        "first_driver.value AS driver_id",
        "first_application.value AS announced_application_id",
        "first_application.line_no AS announced_line_no",
        "pod_notices",
    )


def fold_submit_log(log: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """One row per run with every kind of id in its log; ``runs`` keeps runs without any."""
    ids = ids_of_parts(fold_parts(log))
    if runs is not None:
        ids = runs.select("run_id").join(ids.hint("merge"), "run_id", "left")
    return ids.withColumn("pod_notices", F.coalesce("pod_notices", F.lit(0)))


def route_ids(flagged_runs: DataFrame, ids: DataFrame) -> DataFrame:
    """Keep on each run only the ids its route looks for.

    A run's route is the same on all its lines, so folding first and routing after gives
    what routing every line would, and only one row per run meets the join. Both sides
    grow with the number of runs, so neither is ever broadcast; the fold already has the
    partitioning and the order a merge join needs.
    """
    clash = [c for c in ids.columns if c != "run_id" and c in flagged_runs.columns]
    kept = [c for c in flagged_runs.columns if c not in clash]
    joined = flagged_runs.drop(*clash).join(ids.hint("merge"), "run_id", "left")
    return joined.selectExpr(
        *kept,
        "CASE WHEN route = 'app' THEN application_id END AS application_id",
        "CASE WHEN route = 'pod' THEN driver_pod END AS driver_pod",
        "CASE WHEN route = 'pod' THEN exit_code END AS exit_code",
        "CASE WHEN route = 'pod' THEN exit_digits END AS exit_digits",
        "CASE WHEN route = 'driver' THEN driver_id END AS driver_id",
        "CASE WHEN route = 'app' THEN announced_application_id END AS announced_application_id",
        "CASE WHEN route = 'app' THEN announced_line_no END AS announced_line_no",
        "CASE WHEN route = 'pod' THEN coalesce(pod_notices, 0L) ELSE 0L END AS pod_notices",
    )


def fold_routed_log(log: DataFrame, flagged_runs: DataFrame) -> DataFrame:
    """The runs with the ids found in their logs, one row per run."""
    return route_ids(flagged_runs, ids_of_parts(fold_parts(log)))
