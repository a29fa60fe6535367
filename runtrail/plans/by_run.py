"""Outcomes out of facts that are landed by run.

Facts are folded once, as they arrive, to a bounded number of rows per run and increment, and
appended to tables bucketed by ``run_id``. Every table has the same number of buckets, so merging
increments and joining the tables need no exchange: asking again and again costs one pass over the
folded rows, and no log or poll is shuffled another time. A run with a third of all lines is cut
down inside the tasks that read them, so no bucket holds more than a few rows of it per increment.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from runtrail.operators.fold import fold_parts, ids_of_parts, merge_parts, route_ids
from runtrail.operators.outcome import classify_runs
from runtrail.operators.polls import counted_polls, fold_polls, stop_polls
from runtrail.plans.runs import flagged_runs
from runtrail.sources.tables import append_by_run

FACTS = ("runs", "log_facts", "poll_facts")

#: Runs that a bucket holds. A bucket is one task's work: its facts meet there without an exchange.
RUNS_PER_BUCKET = 100_000


def buckets_for(runs: int, least: int = 8) -> int:
    """Buckets for tables of so many runs, so that no task grows with the tables."""
    return max(least, -(-runs // RUNS_PER_BUCKET))


@dataclass(frozen=True)
class RunTables:
    """Where facts are landed: tables named ``<name>_<kind>`` with their files under ``folder``."""

    spark: SparkSession
    name: str
    folder: str
    buckets: int

    def _append(self, kind: str, facts: DataFrame) -> None:
        append_by_run(facts, f"{self.name}_{kind}", f"{self.folder}/{kind}", self.buckets)

    def _read(self, kind: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{kind}")

    def append(
        self, runs: DataFrame | None = None, submit_log: DataFrame | None = None,
        status_polls: DataFrame | None = None,
    ) -> None:
        """Land an increment of any of the inputs.

        A run's row lands once. Its log lines may come in any number of increments; lines that come
        twice change nothing but ``pod_notices``, which counts them twice. All lines of a poll come
        in one increment; a poll that comes twice counts once.
        """
        if runs is not None:
            self._append("runs", runs)
        if submit_log is not None:
            self._append("log_facts", fold_parts(submit_log))
        if status_polls is not None:
            self._append("poll_facts", counted_polls(fold_polls(status_polls)).drop("counted"))

    def outcomes(self, connections: DataFrame) -> DataFrame:
        """What ``run_outcomes`` gives for all that has landed; every kind of fact must have."""
        ids = ids_of_parts(merge_parts(self._read("log_facts")))
        polls = self._read("poll_facts").dropDuplicates(["run_id", "poll_no"])
        routed = route_ids(flagged_runs(self._read("runs"), connections), ids)
        return classify_runs(routed, stop_polls(polls))

    def drop(self) -> None:
        """Forget the tables; their files stay."""
        for kind in FACTS:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{kind}")
