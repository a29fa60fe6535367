"""Driver states from status polls."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runtrail import fixed_values as fixed
from runtrail.functions.text import driver_state, names_state


def poll_parts(polls: DataFrame) -> DataFrame:
    """Mergeable picks per poll: the last state line and the return code."""
    line = F.col("line")
    lines = polls.select(
        "run_id", "poll_no", "line_no", "returncode",
        driver_state(line).alias("state"),
        names_state(line).alias("names_state"),
    )
    pick = F.when(F.col("state").isNotNull(), F.struct("line_no", "state"))
    return lines.groupBy("run_id", "poll_no").agg(
        F.max(pick).alias("last_state"),
        F.max("returncode").alias("returncode"),
        F.max(F.col("names_state") & F.col("state").isNull()).alias("malformed"),
    )


def merge_poll_parts(parts: DataFrame, *by: str) -> DataFrame:
    """Fold the picks of several parts into one row per poll; ``by`` names columns that follow from the poll."""
    return parts.groupBy("run_id", *by, "poll_no").agg(
        F.max("last_state").alias("last_state"),
        F.max("returncode").alias("returncode"),
        F.max("malformed").alias("malformed"),
    )


def states_of_parts(parts: DataFrame, *by: str) -> DataFrame:
    return parts.select(
        "run_id", *by, "poll_no",
        F.coalesce("last_state.state", F.lit(fixed.NO_STATE)).alias("state"),
        "returncode", "malformed",
    )


def fold_polls(polls: DataFrame) -> DataFrame:
    """One row per poll: its last state, UNKNOWN if it shows none, and its return code.

    Keyed by run and poll, so the polls of one long run spread over all tasks.
    """
    return states_of_parts(poll_parts(polls))


def _counts(states: DataFrame) -> tuple:
    """Whether a poll's status line is malformed, its state final, and its call failed."""
    malformed = F.coalesce("malformed", F.lit(False))
    final = F.col("state").isin(*fixed.FINAL_STATES) | malformed
    return malformed, final, F.coalesce(F.col("returncode") != 0, F.lit(False))


def counted_polls(states: DataFrame, tolerated: int = fixed.TOLERATED_MISSES, by: tuple = ()) -> DataFrame:
    """The polls of each run that can decide how its tracking ends, numbered in ``counted``.

    A poll counts if its state is final, its status line is malformed or its call failed. Of those
    only the earliest, one more than tolerated, are needed, and Spark cuts each run to that many
    inside every task before the shuffle. They come first in the window's order, so a run without
    any still keeps a row. Applied to parts of the polls, such as the slices that ``by``
    names, the union of what is left gives the same.
    """
    _, final, missed = _counts(states)
    in_order = Window.partitionBy("run_id", *by).orderBy(~(final | missed), "poll_no")
    return (
        states.withColumn("counted", F.row_number().over(in_order))
        .where(F.col("counted") <= tolerated + 1)
    )


def follow_polls(states: DataFrame, tolerated: int = fixed.TOLERATED_MISSES) -> DataFrame:
    """All polled runs, with the poll at which their tracking stops, if it does.

    Tracking stops at the first final state, at the first malformed line, or at the failed
    call after the ``tolerated`` ones, which wins even over a final state. One pass over the polls
    that count finds all runs and their stops.
    """
    last_miss = tolerated + 1
    counted = counted_polls(states, tolerated)
    malformed, final, missed = _counts(counted)
    misses = F.col("counted") - F.when(missed, 0).otherwise(1)
    gives_up = missed & ~malformed & (misses >= last_miss)
    state = F.when(malformed, fixed.MALFORMED_STATE).otherwise(F.col("state"))
    stop = F.struct(
        "poll_no", state.alias("state"), "returncode", misses.alias("misses"),
        gives_up.alias("gave_up"),
    )
    first = counted.groupBy("run_id").agg(F.min(F.when(final | gives_up, stop)).alias("stop"))
    return first.select(
        "run_id",
        F.when(F.col("stop").isNull(), fixed.STILL_RUNNING)
        .when(F.col("stop.gave_up"), fixed.POLL_GAVE_UP)
        .otherwise(F.col("stop.state")).alias("tracked_state"),
        F.col("stop.state").alias("driver_state"),
        F.col("stop.poll_no").alias("stop_poll"),
        F.col("stop.returncode").alias("stop_returncode"),
        F.col("stop.misses").alias("misses"),
        F.coalesce("stop.gave_up", F.lit(False)).alias("gave_up"),
    )


def stop_polls(states: DataFrame, tolerated: int = fixed.TOLERATED_MISSES) -> DataFrame:
    """The same for the runs whose tracking has stopped: only the polls that count are shuffled by run."""
    _, final, missed = _counts(states)
    return follow_polls(states.where(final | missed), tolerated).where(F.col("stop_poll").isNotNull())


def with_running(runs: DataFrame, stops: DataFrame) -> DataFrame:
    """All given runs; those whose tracking has not stopped are STILL_RUNNING."""
    return runs.join(stops.hint("merge"), "run_id", "left").withColumns({
        "tracked_state": F.coalesce("tracked_state", F.lit(fixed.STILL_RUNNING)),
        "gave_up": F.coalesce("gave_up", F.lit(False)),
    })


def track_polls(
    polls: DataFrame, runs: DataFrame | None = None, tolerated: int = fixed.TOLERATED_MISSES
) -> DataFrame:
    """How the tracking of each run ended, for ``runs`` or every run that was polled."""
    followed = follow_polls(fold_polls(polls), tolerated)
    if runs is None:
        return followed
    return with_running(runs.select("run_id").distinct(), followed)
