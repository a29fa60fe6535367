"""What became of each run, and what is still to be done about it."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrail import fixed_values as fixed
from runtrail.functions import command


def mask_commands(resolved: DataFrame) -> DataFrame:
    """Add the masked command. The raw tokens stay inside the expression."""
    program = command.executable(F.col("spark_home"), F.col("binary"))
    masked = command.mask_command(command.build_argv(program, F.col("cmd")))
    return resolved.withColumn("masked_command", masked)


def poll_addresses(routed: DataFrame) -> DataFrame:
    """Add where a tracked driver's state can be looked up."""
    address = command.poll_address(F.col("master"), F.col("driver_id"))
    return routed.withColumn("poll_address", F.when(F.col("is_tracked"), address))


def classify_runs(routed: DataFrame, stops: DataFrame) -> DataFrame:
    """Add outcome and reason to runs that carry flags and ids.

    ``stops`` holds the runs whose tracking has stopped. The first case that holds counts.
    Nothing is decided before the launcher has returned. A run on Kubernetes fails unless its
    exit code is known to be 0 (``exit_digits``, if there, tells a code too large for a number from
    none), and a tracked run that has not stopped is still running.
    What the polls say is NULL for runs that are never tracked: not standalone, without a
    driver id, or not submitted.
    """
    digits = "exit_digits" if "exit_digits" in routed.columns else "exit_code"
    cases = [
        ("returncode IS NULL", fixed.STILL_RUNNING, "no return code"),
        ("returncode != 0", fixed.SUBMIT_FAILED, "return code"),
        (f"is_k8s AND {digits} IS NULL", fixed.SUBMIT_FAILED, "no exit code"),
        ("is_k8s AND NOT exit_code <=> 0", fixed.SUBMIT_FAILED, "exit code"),
        ("is_tracked AND driver_id IS NULL", fixed.NO_DRIVER_ID, "no driver id"),
        ("is_tracked AND stop_poll IS NULL", fixed.STILL_RUNNING, "no final poll"),
        ("is_tracked AND gave_up", fixed.POLL_GAVE_UP, "failed polls"),
        (f"is_tracked AND tracked_state = '{fixed.MALFORMED_STATE}'", fixed.POLL_MALFORMED,
         "malformed status"),
        (f"is_tracked AND tracked_state != '{fixed.GOOD_STATE}'", None, "driver state"),
    ]
    state = f"concat('{fixed.DRIVER_PREFIX}', tracked_state)"
    outcomes = " ".join(
        f"WHEN {holds} THEN {repr(value) if value else state}" for holds, value, _ in cases
    )
    reasons = " ".join(f"WHEN {holds} THEN '{reason}'" for holds, _, reason in cases)
    joined = routed.join(stops.hint("merge"), "run_id", "left").withColumn(
        "tracking", F.expr("is_tracked AND driver_id IS NOT NULL AND returncode <=> 0")
    )
    followed = {c: F.when(F.col("tracking"), F.col(c)) for c in stops.columns if c != "run_id"}
    followed["tracked_state"] = F.when(
        F.col("tracking"), F.coalesce("tracked_state", F.lit(fixed.STILL_RUNNING))
    )
    return joined.withColumns(followed).drop("tracking").selectExpr(
        "*",
        f"CASE {outcomes} ELSE '{fixed.SUCCESS}' END AS outcome",
        f"CASE {reasons} END AS reason",
    )


def error_texts(
    classified: DataFrame, tolerated: int = fixed.TOLERATED_MISSES
) -> DataFrame:
    """Add the message of each failed run; it needs ``masked_command``."""
    outcome = F.col("outcome")
    text = (
        F.when(
            outcome == fixed.SUBMIT_FAILED,
            command.submit_error(F.col("masked_command"), F.col("returncode")),
        )
        .when(outcome == fixed.NO_DRIVER_ID, fixed.NO_DRIVER_ERROR)
        .when(outcome == fixed.POLL_GAVE_UP, command.poll_error(F.col("stop_returncode"), tolerated))
        .when(
            outcome.startswith(fixed.DRIVER_PREFIX),
            command.driver_error(F.col("driver_id"), F.col("tracked_state")),
        )
    )
    return classified.withColumn("error_text", text)


def log_fetch_plan(classified: DataFrame, page_ready: Column | None = None) -> DataFrame:
    """Add whether the driver's log is wanted, from which places.

    It is wanted after a failed submit and after success. On YARN it needs an application
    id and a page with a log in time; without either the pod log is not read. ``page_ready``
    says of a run whether it had such a page; without it all had.
    """
    wanted = F.col("outcome").isin(fixed.SUBMIT_FAILED, fixed.SUCCESS)
    on_yarn = F.col("is_yarn") & F.col("application_id").isNotNull()
    page = F.lit(True) if page_ready is None else page_ready
    return classified.withColumns({
        "fetch_log": wanted,
        "fetch_yarn": wanted & on_yarn,
        "fetch_pod": wanted & F.col("is_k8s") & (~F.col("is_yarn") | (on_yarn & page)),
    })


def cleanup_actions(routed: DataFrame) -> DataFrame:
    """One row per thing left to clean up of a cancelled run, in order.

    The application and the pod are only listed while the launcher is alive.
    """
    program = command.executable(F.col("spark_home"), F.col("binary"))
    alive = F.coalesce(F.col("launcher_alive"), F.lit(False))
    kill = F.concat(program, F.lit(" --master "), F.col("master"), F.lit(" --kill "), F.col("driver_id"))
    nothing = F.lit(None).cast("string")

    def action(holds, seq, kind, target, namespace=nothing):
        row = F.struct(
            F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), target.alias("target"),
            namespace.alias("namespace"),
        )
        return F.when(holds, row)

    actions = F.array_compact(F.array(
        action(F.col("is_tracked") & F.col("driver_id").isNotNull(), 1, "driver", kill),
        action(alive, 2, "launcher", F.col("binary")),
        action(alive & F.col("application_id").isNotNull(), 3, "application",
               F.concat(F.lit("yarn application -kill "), F.col("application_id"))),
        action(alive & F.col("driver_pod").isNotNull(), 4, "pod", F.col("driver_pod"),
               F.col("namespace")),
    ))
    return (
        routed.where(F.col("cancelled"))
        .select("run_id", F.explode(actions).alias("action"))
        .select("run_id", "action.*")
    )
