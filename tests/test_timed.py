"""Streams with event time: what closes, what is forgotten, what repeats change."""

import datetime
import random

import pytest

from conftest import SMALL
from runtrail import schemas
from runtrail.operators import fold, polls
from runtrail.sources.derived import derived_table
from runtrail.sources.tables import stream_table
from runtrail.streaming import timed

ONE_FILE = {"maxFilesPerTrigger": 1}


def at(minutes):
    return datetime.datetime(2024, 5, 1) + datetime.timedelta(minutes=minutes)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def land(spark, batch, schema, path):
    spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)


def fold_of(spark, batches, folder):
    """The queries' progress after each batch, a run of the stream each."""
    progress = []
    for batch in batches:
        land(spark, batch, schemas.TIMED_LOG, f"{folder}/in")
        lines = stream_table(spark, "timed_log", f"{folder}/in")
        query = timed.stream_fold_evicting(lines, f"{folder}/out", f"{folder}/state")
        query.awaitTermination()
        dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress)
        progress.append({**query.recentProgress[-1]["stateOperators"][0], "dropped": dropped})
    return progress


def line(run, number, minutes, text="INFO"):
    return (run, number, text, at(minutes))


def test_sessions_close_are_emitted_and_forgotten(spark, tmp_path):
    waves = [[line(100 * w + r, n, 200 * w + n, f"application_{w}_{n}") for r in range(30) for n in range(4)] for w in range(5)]
    progress = fold_of(spark, waves, tmp_path)
    # Each wave finds only the last one's runs in the state, however many came before.
    assert [p["numRowsTotal"] for p in progress] == [30] * 5
    closed = [x for wave in waves[:4] for x in wave]
    batch = spark.createDataFrame(closed, schemas.TIMED_LOG).drop("logged_at")
    assert rows(timed.read_closed(spark, f"{tmp_path}/out")) == rows(fold.fold_submit_log(batch))


def test_a_run_that_speaks_up_again_reads_as_one(spark, tmp_path):
    batches = [
        [line(1, 1, 0, "driver-1-1"), line(1, 2, 1, "application_1")], [line(2, 1, 300)],
        [line(1, 3, 301, "driver-2-2"), line(1, 4, 302, "application_2"), line(1, 5, 302, "pod name: a-b-driver")],
        [line(2, 2, 900)],
    ]
    fold_of(spark, batches, tmp_path)
    found = {r.run_id: r for r in timed.read_closed(spark, f"{tmp_path}/out").collect()}
    assert (found[1].driver_id, found[1].application_id, found[1].pod_notices) == ("driver-1-1", "application_2", 1)
    assert found[2].application_id is None


def test_lines_beyond_the_delay_are_left_out_and_counted(spark, tmp_path):
    batches = [[line(1, 1, 500, "application_1")], [line(2, 1, 501), line(3, 1, 10, "application_late")], [line(4, 1, 2000)]]
    progress = fold_of(spark, batches, tmp_path)
    assert [p["dropped"] for p in progress] == [0, 1, 0]
    assert {r.run_id for r in timed.read_closed(spark, f"{tmp_path}/out").collect()} == {1, 2}


def test_folding_merges_in_each_task_before_the_shuffle(spark, tmp_path):
    land(spark, [line(7, n, n / 60) for n in range(500)], schemas.TIMED_LOG, f"{tmp_path}/in")
    lines = stream_table(spark, "timed_log", f"{tmp_path}/in")
    query = timed.stream_fold_evicting(lines, f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination()
    assert "MergingSessions" in query._jsq.explainInternal(False).split("Exchange")[-1]
    assert spark.conf.get(timed.MERGE_FIRST) == "false"


def poll(run, number, line_no, minutes, text="{", code=0):
    return (run, number, line_no, text, code, at(minutes))


def said(state):
    return f'"driverState" : "{state}"'


def tracked(spark, batches, folder, **options):
    progress = []
    for batch in batches:
        land(spark, batch, schemas.TIMED_POLLS, f"{folder}/in")
        stream = stream_table(spark, "timed_polls", f"{folder}/in")
        query = timed.stream_track_timed(stream, f"{folder}/out", f"{folder}/state", **options)
        query.awaitTermination()
        progress.append(query.recentProgress[-1]["stateOperators"])
    return {tuple(r) for r in timed.read_reports(spark, f"{folder}/out").collect()}, progress


def test_runs_are_reported_once_silent(spark, tmp_path):
    batches = [
        [poll(1, 1, 1, 0, said("RUNNING")), poll(1, 2, 1, 1, said("RUNNING")), poll(2, 1, 1, 1, said("RUNNING"))],
        # The second poll's last line takes back its final state; lines come out of order.
        [poll(2, 2, 2, 3, said("RUNNING")), poll(2, 2, 1, 3, said("KILLED")), poll(2, 3, 1, 4, said("FAILED"))],
        [poll(3, n, 1, 5 + n, said("RUNNING"), 1) for n in range(1, 14)] + [poll(4, 1, 1, 6, "driverState")] + [poll(5, 1, 1, 6)],
        [poll(9, 1, 1, 3000, said("RUNNING"))],
    ]
    found, progress = tracked(spark, batches, tmp_path)
    assert found == {
        (1, "STILL_RUNNING", None, None, None, False, True), (2, "FAILED", "FAILED", 3, 0, False, False),
        (3, "POLL_GAVE_UP", "RUNNING", 11, 11, True, False), (4, "MALFORMED", "MALFORMED", 1, 0, False, False),
        (5, "UNKNOWN", "UNKNOWN", 1, 0, False, False),
    }
    # Only the last run, and its line, are still known.
    assert [p["numRowsTotal"] for p in progress[-1]] == [1, 1]


@pytest.mark.parametrize("files", [1, 3])
def test_replayed_polls_change_nothing(spark, tmp_path, files):
    table = derived_table(spark, SMALL, "timed_polls").where("run_id % 40 = 0")
    lines = [tuple(r) for r in table.collect()]
    lines = [(*x[:5], at(x[1])) for x in lines]  # all runs on one day
    random.Random(files).shuffle(lines)
    batches = [lines[i::files] for i in range(files)]
    batches += [batches[0], batches[-1][::-1], [poll(-1, 1, 1, 9000)]]
    found, _ = tracked(spark, batches, tmp_path)
    whole = polls.track_polls(table.drop("polled_at")).select("run_id", "tracked_state", "driver_state", "stop_poll", "misses", "gave_up")
    assert found == {(*r, r.stop_poll is None) for r in whole.collect()}


def test_a_long_run_keeps_few_polls():
    held = {}
    timed.merge_lines(held, ((n, 1, 0, n, "RUNNING", False) for n in range(5000)))
    assert set(timed.kept_polls(held, 4990, 10)) == set(range(4991, 5000))
    timed.merge_lines(held, ((n, 2, 1, n, None, False) for n in range(0, 5000, 7)))
    kept = timed.kept_polls(held, 4990, 10)
    assert len(kept) == 11 + 9 and timed.follow(kept, 10) == timed.follow(held, 10)


def test_runs_share_groups_and_keep_their_own_timers(spark, tmp_path):
    """Far fewer groups than runs; a null run and ids beyond a double's digits are told apart."""
    large = (1 << 60) + 1
    ids = [*range(1, 300), large, large + 1, None]
    batches = [
        [poll(run, 1, 1, 0, said("RUNNING")) for run in ids],
        [poll(run, 2, 1, 20, said("FAILED")) for run in ids if run is None or run % 2],
        [poll(-1, 1, 1, 100, said("RUNNING"))],   # the watermark passes the even runs' timers only
        [poll(-2, 1, 1, 115, said("RUNNING"))],
    ]
    counts, before = [], 0
    for batch in batches:
        found, progress = tracked(spark, [batch], tmp_path)
        counts.append(len(found) - before)
        before = len(found)
    failed = {(run, "FAILED", "FAILED", 2, 0, False, False) for run in ids if run is None or run % 2}
    assert found == failed | {(run, "STILL_RUNNING", None, None, None, False, True) for run in ids if run and not run % 2}
    assert counts == [0, 0, 150, 152]


def test_a_group_serves_many_runs(spark, tmp_path):
    land(spark, [poll(run, 1, 1, 0, said("RUNNING")) for run in range(500)], schemas.TIMED_POLLS, f"{tmp_path}/in")
    stream = stream_table(spark, "timed_polls", f"{tmp_path}/in")
    query = timed._append_batches(timed.timed_tracking(stream, groups=8), f"{tmp_path}/out", f"{tmp_path}/state", None)
    query.awaitTermination()
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 8


def test_the_lines_of_a_run_take_one_state_row(spark, tmp_path):
    """However many lines a run has in a batch, few rows of state tell them again."""
    lines = [poll(run, n, line_no, n, said("RUNNING")) for run in range(20) for n in range(1, 16) for line_no in (1, 2)]
    found, progress = tracked(spark, [lines, lines[::2], lines], tmp_path)
    assert not found and max(p["numRowsTotal"] for operators in progress for p in operators) <= 40


def test_lines_that_come_again_among_others_change_nothing(spark, tmp_path):
    first = [poll(1, n, 1, n, said("RUNNING")) for n in range(1, 4)] + [poll(2, 1, 1, 3, said("FAILED"))]
    batches = [
        first + [poll(9, 1, 1, 30)],
        # Lines come again with a newer time, beside a new one; that of the second run alone.
        [poll(1, 1, 1, 33, said("RUNNING")), poll(1, 4, 1, 20, said("RUNNING")), poll(2, 1, 1, 40, said("FAILED"))],
        [poll(9, 2, 1, 111)],   # at 51 minutes the first run's timer has passed, had its lines not been told
        [poll(2, 1, 1, 52, said("FAILED"))],  # the run is gone, its line still known
        [poll(8, 1, 1, 130)],
    ]
    states, seen = [], []
    for batch in batches:
        found, _ = tracked(spark, [batch], tmp_path)
        states.append(found)
        seen.append(timed.read_reports(spark, f"{tmp_path}/out").count())
    assert seen == [0, 0, 2, 2, 2]
    assert states[2] == {(1, "STILL_RUNNING", None, None, None, False, True), (2, "FAILED", "FAILED", 1, 0, False, False)}


def test_late_lines_among_newer_ones_are_left_out(spark, tmp_path):
    batches = [
        [poll(1, 1, 1, 500, said("RUNNING"))],
        [poll(1, 2, 1, 501, said("RUNNING")), poll(1, 3, 1, 440, said("KILLED")), poll(2, 1, 1, 10, said("FAILED")),
         poll(3, 1, 1, 10, said("FAILED")), poll(3, 2, 1, 502, said("RUNNING"))],
        [poll(9, 1, 1, 3000)],
    ]
    found, _ = tracked(spark, batches, tmp_path)
    assert found == {(run, "STILL_RUNNING", None, None, None, False, True) for run in (1, 3)}


def plain_follow(held, tolerated):
    misses = 0
    for number in sorted(held):
        _, state, code, malformed, _ = held[number]
        state = "MALFORMED" if malformed else state or "UNKNOWN"
        misses += bool(code)
        gave_up = bool(code) and not malformed and misses > tolerated
        if gave_up or malformed or state in timed.fixed.FINAL_STATES:
            return ("POLL_GAVE_UP" if gave_up else state, state, number, misses, gave_up, False)
    return ("STILL_RUNNING", None, None, None, False, True)


def test_runs_folded_by_column_end_as_line_by_line():
    draw = random.Random(5)
    for _ in range(300):
        bad = draw.choice([0.05, 0.6])
        lines = [
            (draw.randrange(1, 15), draw.randrange(1, 4), draw.choice([1, 28, timed.NO_CODE]) if draw.random() < bad else 0,
             draw.randrange(100), draw.choice(["RUNNING"] * 12 + ["FAILED", "", "ZÄH"]), draw.random() < 0.02)
            for _ in range(draw.randrange(1, 60))
        ]
        held, plain = {}, {}
        for part in (lines[::2], lines[1::2]):
            timed.merge_lines(held, iter(part))
        for n, line, code, time, state, malformed in lines:
            own = plain.setdefault(n, [None, None, None, False, time])
            if state and (own[0] is None or (line, state) > (own[0], own[1])):
                own[0], own[1] = line, state
            if code != timed.NO_CODE:
                own[2] = max(code, own[2] if own[2] is not None else code)
            own[3], own[4] = own[3] or malformed, max(own[4], time)
        assert held == plain
        assert timed.follow(held, 3) == plain_follow(plain, 3)
        counts = [n for n, p in sorted(plain.items()) if p[4] <= 50 and (p[2] or p[3] or (p[1] or "UNKNOWN") in timed.fixed.FINAL_STATES)]
        assert set(timed.kept_polls(held, 50, 3)) == {n for n, p in plain.items() if p[4] > 50} | set(counts[:4])


def test_a_long_run_comes_in_packs_of_bounded_length(monkeypatch):
    monkeypatch.setattr(timed, "PACKED_LINES", 3000)
    n = 8000
    columns = {
        "run_group": [5] * n, "run": [7] * n, "no_run": [False] * n, "poll_no": [*range(n)], "line_no": [1] * n,
        "returncode": [0] * n, "us": [*range(n)], "state": ["RUNNING", ""] * (n // 2), "malformed": [False] * n,
    }
    batch = timed.pa.RecordBatch.from_pydict(columns)
    packs = [p for b in timed.packed(batch.slice(k, 500) for k in range(0, n, 500)) for p in b.to_pylist()]
    assert max(len(p["us"]) for p in packs) == timed.PACK_LENGTH
    assert [x for p in packs for x in zip(p["poll_no"], p["us"], p["state"])] == [*zip(columns["poll_no"], columns["us"], columns["state"])]
    assert all(p["polled_at"].microsecond == max(p["us"]) for p in packs)
