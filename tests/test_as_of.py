"""Settings as of a run's start, and questions about one month, against plain versions."""

import datetime
import random

from conftest import SMALL
from plan_checks import plan_text, rows_written_to_shuffle
from runtrail import schemas
from runtrail.operators.connections import last_versions, resolve_connections_as_of
from runtrail.plans import catalogue
from runtrail.plans import runs as plans
from runtrail.sources import tables
from runtrail.sources.derived import derived_table


def at(hours):
    return None if hours is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hours)


def plain(events, versions):
    out = []
    for n, key, time in events:
        own = [(t, v) for k, t, v in versions if k == key and t is not None and time is not None and t <= time]
        out.append((n, max(own)[1] if own and key is not None else None))
    return sorted(out)


def found_by(spark, events, versions, slice_of="date_trunc('day', moment)"):
    left = spark.createDataFrame([(n, k, at(t)) for n, k, t in events], "n int, k string, t timestamp")
    right = spark.createDataFrame([(k, at(t), v) for k, t, v in versions], "k string, since timestamp, v int")
    found = last_versions(left, right, "k", "t", "since", slice_of)
    return found, sorted((r.n, r.version and r.version.v) for r in found.collect())


def test_the_newest_version_at_or_before(spark):
    rng = random.Random(5)
    keys = ["a", "b", "c", None]
    versions = [(rng.choice(keys), rng.choice([None, *range(0, 400, 7)]), v) for v in range(1, 60)]
    events = [(n, rng.choice(["hot"] * 3 + keys), rng.choice([None, *range(0, 400)])) for n in range(600)]
    versions += [("hot", h, 1000 + h) for h in (0, 24, 24, 100)]  # versions that begin together, at a slice's start too
    for slice_of in ("date_trunc('day', moment)", "date_trunc('year', moment)", "moment"):
        assert found_by(spark, events, versions, slice_of)[1] == plain(events, versions)
    assert found_by(spark, events, [])[1] == [(n, None) for n, _, _ in events]
    assert found_by(spark, [], versions)[1] == []


def test_a_hot_key_is_split_by_time_slices(spark):
    events = [(n, "hot", n % 2400) for n in range(4800)]
    found, _ = found_by(spark, events, [("hot", 5, 1), ("hot", 700, 2)])
    text = plan_text(found)
    assert "Window" in text and "SortMergeJoin" not in text and "Broadcast" not in text
    # Events move once; what joins them is a row per slice.
    assert rows_written_to_shuffle(found) < 4800 + 6 * 105


def test_settings_as_of_the_start(spark):
    runs = [(1, "c", 0), (2, "c", 10), (3, "c", 20), (4, "c", 99), (5, "x", 50), (6, None, 50), (7, "c", None)]
    runs = spark.createDataFrame(
        [(n, c, None, None, "cmd", 0, None, False, False, at(t)) for n, c, t in runs], schemas.STARTED_RUNS)
    versions = spark.createDataFrame(
        [("c", "old", 1, '{"queue":"q1"}', at(10)), ("c", "new", None, '{"queue":"q2"}', at(20)), ("c", None, None, None, at(98))],
        schemas.CONNECTION_VERSIONS)
    found = resolve_connections_as_of(runs, versions).orderBy("run_id").collect()
    assert [(r.conn_found, r.master, r.queue, r.conn_since) for r in found] == [
        (False, "yarn", None, None), (True, "old:1", "q1", at(10)), (True, "new", "q2", at(20)), (True, None, None, at(98)),
        (False, "yarn", None, None), (False, "yarn", None, None), (False, "yarn", None, None),
    ]


def test_a_month_is_read_from_its_folders_only(spark, tmp_path):
    starts = derived_table(spark, SMALL, "started_runs").selectExpr("run_id", "trunc(started_at, 'month') AS run_date")
    for name in tables.BY_RUN:
        tables.write_facts(derived_table(spark, SMALL, name).join(starts, "run_id"), f"{tmp_path}/{name}")
    runs, log, polls = [tables.read_month(spark, n, f"{tmp_path}/{n}", catalogue.MONTH) for n in tables.BY_RUN]
    found = plans.run_outcomes(runs, derived_table(spark, SMALL, "connections"), log, polls)
    text = plan_text(found)
    scans = [line for line in text.splitlines() if "FileScan" in line and str(tmp_path) in line]
    assert len(scans) == 3
    for scan in scans:
        assert f"PartitionFilters: [isnotnull(run_date" in scan and catalogue.MONTH in scan
    assert 0 < found.count() < 100
