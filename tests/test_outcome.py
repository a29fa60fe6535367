from collections import Counter

from pyspark.sql import functions as F

from conftest import SMALL
from runtrail.operators import outcome
from runtrail.plans import catalogue

ROUTED = (
    "run_id bigint, returncode int, is_yarn boolean, is_k8s boolean, is_tracked boolean, "
    "application_id string, driver_pod string, exit_code bigint, driver_id string, "
    "master string, spark_home string, binary string, namespace string, cancelled boolean, launcher_alive boolean"
)
STOPS = (
    "run_id bigint, tracked_state string, driver_state string, stop_poll int, "
    "stop_returncode int, misses int, gave_up boolean"
)
DEFAULTS = dict(
    returncode=0, is_yarn=False, is_k8s=False, is_tracked=False, application_id=None,
    driver_pod=None, exit_code=None, driver_id=None, master="m", spark_home="/opt", binary="b", namespace=None,
    cancelled=True, launcher_alive=True,
)


def routed(spark, *runs):
    rows = [dict(DEFAULTS, run_id=n, **run) for n, run in enumerate(runs)]
    names = [f.split()[0] for f in ROUTED.split(", ")]
    return spark.createDataFrame([[r[c] for c in names] for r in rows], ROUTED)


def classify(spark, *runs, stops=()):
    rows = [(n, s, s, 1, 1, 1, s == "POLL_GAVE_UP") for n, s in stops]
    frame = outcome.classify_runs(routed(spark, *runs), spark.createDataFrame(rows, STOPS))
    return frame.orderBy("run_id")


def test_outcomes_by_hand(spark):
    tracked = dict(is_tracked=True, driver_id="driver-1")
    runs = [
        (dict(), "SUCCESS"),
        (dict(returncode=-9), "SUBMIT_FAILED"),
        (dict(is_k8s=True), "SUBMIT_FAILED"),
        (dict(is_k8s=True, exit_code=1), "SUBMIT_FAILED"),
        (dict(is_k8s=True, exit_code=0), "SUCCESS"),
        (dict(is_k8s=True, exit_code=0, returncode=1), "SUBMIT_FAILED"),
        (dict(is_tracked=True), "NO_DRIVER_ID"),
        (dict(is_tracked=True, returncode=1), "SUBMIT_FAILED"),
        (tracked, "SUCCESS"),
        (tracked, "DRIVER_KILLED"),
        (tracked, "POLL_GAVE_UP"),
        (tracked, "STILL_RUNNING"),
        (dict(exit_code=3), "SUCCESS"),
        (dict(returncode=None), "STILL_RUNNING"),
        (dict(returncode=None, is_k8s=True), "STILL_RUNNING"),
        (tracked, "POLL_MALFORMED"),
    ]
    stops = [(8, "FINISHED"), (9, "KILLED"), (10, "POLL_GAVE_UP"), (6, "FINISHED"), (7, "KILLED"),
             (0, "FAILED"), (15, "MALFORMED")]
    rows = classify(spark, *[r for r, _ in runs], stops=stops).collect()
    assert [r.outcome for r in rows] == [o for _, o in runs]
    assert [r.reason for r in rows] == [
        None, "return code", "no exit code", "exit code", None, "return code", "no driver id",
        "return code", None, "driver state", "failed polls", "no final poll", None,
        "no return code", "no return code", "malformed status",
    ]
    states = {8: "FINISHED", 9: "KILLED", 10: "POLL_GAVE_UP", 11: "STILL_RUNNING", 15: "MALFORMED"}
    assert {r.run_id: r.tracked_state for r in rows if r.tracked_state} == states
    assert {r.run_id for r in rows if r.misses is not None} == states.keys() - {11}


def test_log_fetch_plan(spark):
    rows = outcome.log_fetch_plan(classify(
        spark,
        dict(is_yarn=True, application_id="a"),
        dict(is_yarn=True),
        dict(is_k8s=True, driver_pod="p"),
        dict(is_k8s=True, is_yarn=True, returncode=1, application_id="a"),
        dict(is_k8s=True, is_yarn=True),
        dict(is_tracked=True),
        dict(is_tracked=True, driver_id="d"),
    )).orderBy("run_id").collect()
    assert [(r.fetch_log, r.fetch_yarn, r.fetch_pod) for r in rows] == [
        (True, True, False), (True, False, False), (True, False, True), (True, True, True),
        (True, False, False), (False, False, False), (False, False, False),
    ]


def test_a_page_that_is_never_ready_stops_the_pod_log(spark):
    ready = F.col("run_id") != 1
    both = dict(is_k8s=True, is_yarn=True, returncode=1, application_id="a")
    rows = outcome.log_fetch_plan(classify(spark, both, both, dict(is_k8s=True, exit_code=0)), ready).orderBy("run_id").collect()
    assert [(r.fetch_yarn, r.fetch_pod) for r in rows] == [(True, True), (True, False), (False, True)]


def test_a_huge_exit_code_is_an_exit_code(spark):
    runs = routed(spark, dict(is_k8s=True), dict(is_k8s=True)).withColumn(
        "exit_digits", F.when(F.col("run_id") == 0, "99999999999999999999999"))
    found = outcome.classify_runs(runs, spark.createDataFrame([], STOPS)).orderBy("run_id").collect()
    assert [(r.outcome, r.reason) for r in found] == [("SUBMIT_FAILED", "exit code"), ("SUBMIT_FAILED", "no exit code")]


def test_cleanup_actions(spark):
    frame = outcome.cleanup_actions(routed(
        spark,
        dict(is_tracked=True, driver_id="d", launcher_alive=False, application_id="a"),
        dict(is_tracked=True, driver_id="d", application_id="a", driver_pod="p", namespace="n"),
        dict(driver_id="d", driver_pod="p"),
        dict(is_tracked=True, launcher_alive=None),
        dict(cancelled=False, is_tracked=True, driver_id="d"),
    ))
    assert [tuple(r) for r in frame.orderBy("run_id", "seq").collect()] == [
        (0, 1, "driver", "/opt/bin/b --master m --kill d", None),
        (1, 1, "driver", "/opt/bin/b --master m --kill d", None),
        (1, 2, "launcher", "b", None),
        (1, 3, "application", "yarn application -kill a", None),
        (1, 4, "pod", "p", "n"),
        (2, 2, "launcher", "b", None),
        (2, 4, "pod", "p", None),
    ]


def test_error_texts(spark):
    tracked = dict(is_tracked=True, driver_id="driver-1")
    frame = classify(
        spark, dict(returncode=2), dict(is_tracked=True), tracked, tracked, dict(), tracked,
        stops=[(2, "POLL_GAVE_UP"), (3, "ERROR")],
    ).withColumn("masked_command", F.lit("s x"))
    assert [r.error_text for r in outcome.error_texts(frame).orderBy("run_id").collect()] == [
        "Cannot execute: s x. Error code is: 2.",
        "No driver id is known: something went wrong when executing the spark submit command",
        "Failed to poll for the driver status 10 times: returncode = 1",
        "ERROR : Driver driver-1 badly exited with status ERROR",
        None, None,
    ]


def test_every_outcome_occurs(spark):
    rows = catalogue.classify_runs(spark, SMALL.replace("0.001", "0.01")).select("outcome").collect()
    assert Counter(r.outcome for r in rows) == {
        "SUCCESS": 8952, "SUBMIT_FAILED": 4096, "STILL_RUNNING": 811, "NO_DRIVER_ID": 398,
        "DRIVER_FAILED": 312, "DRIVER_KILLED": 194, "POLL_GAVE_UP": 108, "POLL_MALFORMED": 65,
        "DRIVER_UNKNOWN": 64,
    }


def test_no_secret_leaves_a_query(spark):
    """The derived commands hide a value starting with pw and one starting with an s."""
    for name in ("mask_command", "tokenize_command", "error_text", "run_report"):
        frame = catalogue.QUERIES[name](spark, SMALL)
        texts = [c for c, kind in frame.dtypes if kind == "string"]
        found = " OR ".join(f"{c} LIKE '%=''pw%' OR {c} LIKE '%= ''s%'" for c in texts)
        assert frame.where(found).count() == 0
