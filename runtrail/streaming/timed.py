"""Streams with event time, whose state is forgotten once a run has gone silent.

``evicting_fold`` folds a run's lines in a session window: the session ends when no line has come
for ``gap``, its picks are emitted when the watermark passes its end, and its state goes. The picks
are the same mergeable parts that the other folds write, so a run that speaks up again after a
silence gives a second part and reads as one. ``timed_tracking`` drops repeated lines while the
watermark can still tell them, keeps of each run the few polls that may decide how its tracking
ends, and a timer reports the run once it is silent: with the stop of its tracking if it had one,
else as fallen silent.

Lines that come later than ``delay`` behind the newest one are left out, as in any stream with a
watermark, and counted in the query's progress, by ``timed_tracking`` as one for each run whose lines of
a micro-batch are all late; the folds of ``streaming.parts`` leave none out but keep their parts. Null
times count as never: such lines are left out. Both need state for the runs of the last ``gap`` and
``delay`` only; RocksDB as state store keeps it off the heap.
"""

from __future__ import annotations

import hashlib
import pickle
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from runtrail import fixed_values as fixed
from runtrail import schemas
from runtrail.functions.text import driver_state, names_state
from runtrail.operators.fold import ids_of_parts, merge_parts, picks_of_ids
from runtrail.streaming.parts import BATCH, read_parts

# Executors need not have the package: the function over a run's polls travels with the tasks.
for _module in (sys.modules[__name__], fixed):
    cloudpickle.register_pickle_by_value(_module)

#: Stands for a return code that is not known.
NO_CODE = -(1 << 40)
MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
TRACKED = (
    "run_id bigint, tracked_state string, driver_state string, stop_poll int, misses int, "
    "gave_up boolean, silent boolean"
)


def evicting_fold(lines: DataFrame, time_col: str = "logged_at", gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Mergeable picks of each closed session of a run, with its end ``closed_at``."""
    window = F.session_window(time_col, gap)
    picks = picks_of_ids(lines.withWatermark(time_col, delay), window.alias("session"), keep=(time_col,))
    return picks.withColumn("closed_at", F.col("session.end")).drop("session")


def _append_batches(frame: DataFrame, path: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    def write_batch(batch: DataFrame, number: int):
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return (
        frame.writeStream.outputMode("append").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def stream_fold_evicting(
    lines: DataFrame, path: str, checkpoint: str, time_col: str = "logged_at", gap: str = "30 minutes",
    delay: str = "1 hour", trigger: dict | None = None,
) -> StreamingQuery:
    """Writes the picks of the sessions that close, each micro-batch under its number.

    Tasks merge their own sessions ahead of the shuffle, so that a run with most lines sends a row
    from each task.
    """
    conf = lines.sparkSession.conf
    before = conf.get(MERGE_FIRST)
    conf.set(MERGE_FIRST, "true")
    try:
        return _append_batches(evicting_fold(lines, time_col, gap, delay), path, checkpoint, trigger)
    finally:
        conf.set(MERGE_FIRST, before)


def _closed_schema(spark: SparkSession):
    empty = spark.createDataFrame([], schemas.TIMED_LOG)
    picks = picks_of_ids(empty, F.col("logged_at").alias("closed_at"), keep=("logged_at",))
    return picks.schema


def read_closed(spark: SparkSession, path: str) -> DataFrame:
    """The ids of the runs whose sessions have closed, over all of these."""
    return ids_of_parts(merge_parts(read_parts(spark, path, _closed_schema(spark))))


def poll_lines(polls: DataFrame) -> DataFrame:
    """What each line of a poll says; texts go no further, and nothing is null on its way to Python."""
    line = F.col("line")
    state = driver_state(line)
    return polls.select(
        "run_id", F.col("poll_no").cast("long").alias("poll_no"), F.col("line_no").cast("long").alias("line_no"),
        F.coalesce(F.col("returncode").cast("long"), F.lit(NO_CODE)).alias("returncode"),
        F.unix_micros("polled_at").alias("us"), F.coalesce(state, F.lit("")).alias("state"),
        (names_state(line) & state.isNull()).alias("malformed"),
    )


# Lines, polls and runs are held by column, as arrays of equal length under their names. The state of a
# driver is its place in a sorted list of ``names``, so that places compare as texts do; 0 is no state.
RUN = ("no_run", "run")
POLL = (*RUN, "poll_no")
LINE = (*POLL, "line_no", "returncode", "state", "malformed")
KINDS = {
    "run": np.int64, "no_run": np.bool_, "poll_no": np.int64, "line_no": np.int64, "returncode": np.int64,
    "state": np.int64, "malformed": np.bool_, "us": np.int64, "expires": np.int64, "ms": np.int64,
    "last": np.int64, "timer": np.int64, "touched": np.bool_,
}
#: Before any time or line.
FIRST = np.iinfo(np.int64).min


def _empty(*columns: str) -> dict:
    return {c: np.empty(0, KINDS[c]) for c in columns}


def _rows(table: dict, where: np.ndarray) -> dict:
    return {c: values[where] for c, values in table.items()}


def _all(*tables: dict) -> dict:
    return {c: np.concatenate([t[c] for t in tables]) for c in tables[0]}


def _sorted(table: dict, *by: str) -> dict:
    return _rows(table, np.lexsort([table[c] for c in reversed(by)]))


def _firsts(table: dict, by: tuple) -> np.ndarray:
    """Which rows of a sorted table differ from those before them."""
    first = np.zeros(len(table["run"]), bool)
    first[:1] = True
    for c in by:
        first[1:] |= table[c][1:] != table[c][:-1]
    return first


def _running(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How many flags are set up to each row, counted anew from each first one."""
    counted = np.cumsum(flags)
    starts = np.flatnonzero(first)
    return counted - np.repeat(counted[starts] - flags[starts], np.diff([*starts, len(flags)]))


def _run_at(runs: dict, table: dict) -> np.ndarray:
    """Where the run of each row stands in the sorted runs, of which a null one is the last."""
    known = len(runs["run"]) - int(runs["no_run"].sum())
    return np.where(table["no_run"], known, np.searchsorted(runs["run"][:known], table["run"]))


def renamed(table: dict, names: list, into: list) -> dict:
    """The table with its states as places in another list, which has all their names."""
    place = {name: n for n, name in enumerate(into)}
    return table | {"state": np.array([place[name] for name in names], np.int64)[table["state"]]}


#: Lines that are sorted at once, and lines of a pack, so that a run with most lines needs no more memory.
PACKED_LINES = 1_000_000
PACK_LENGTH = 1024
#: Polls of a run that are packed in one task, as a power of two: the slices of a long run are dealt to many.
SLICE_BITS = 10
PACK = (
    "run_group bigint, run bigint, no_run boolean, digest string, polled_at timestamp, poll_no array<bigint>, "
    "line_no array<bigint>, returncode array<bigint>, us array<bigint>, state array<string>, malformed array<boolean>"
)


def _packs(batches: list) -> pa.RecordBatch:
    lines = pa.Table.from_batches(batches).combine_chunks()
    texts = lines["state"].combine_chunks().dictionary_encode()
    seen = texts.dictionary.to_pylist()
    names = sorted({"", *seen})
    table = {c: lines[c].to_numpy() for c in (*LINE, "us", "run_group") if c != "state"}
    table = _sorted(renamed(table | {"state": texts.indices.to_numpy()}, seen, names), *LINE, "us")
    table = _rows(table, _firsts(table, (*LINE, "us")))
    first = _firsts(table, RUN)
    starts = np.flatnonzero(first | (_running(np.ones(len(first), int), first) % PACK_LENGTH == 1))
    ends = [*starts[1:].tolist(), len(first)]
    states = np.array(names, object)[table["state"]].tolist()
    length = np.array([len(name) for name in names])[table["state"]]
    said = np.column_stack([*(table[c] for c in ("poll_no", "line_no", "returncode", "us", "malformed")), length])
    digests = [
        hashlib.blake2b(said[low:high].tobytes() + "".join(states[low:high]).encode(), digest_size=20).hexdigest()
        for low, high in zip(starts.tolist(), ends)
    ]
    text = lines.schema.field("state").type
    cuts = pa.array([*starts.tolist(), len(states)], pa.int32())
    of_run = {
        "run_group": pa.array(table["run_group"][starts]), "run": pa.array(table["run"][starts]),
        "no_run": pa.array(table["no_run"][starts]), "digest": pa.array(digests, text),
        "polled_at": pa.array(np.maximum.reduceat(table["us"], starts), pa.timestamp("us", "UTC")),
    }
    of_line = {c: pa.array(table[c]) for c in ("poll_no", "line_no", "returncode", "us")}
    of_line |= {"state": pa.array(states, text), "malformed": pa.array(table["malformed"])}
    packs = of_run | {c: pa.ListArray.from_arrays(cuts, values) for c, values in of_line.items()}
    return pa.RecordBatch.from_pydict(packs)


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each run its lines, each once, in their order, in one row or a few, with the newest one's time."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= PACKED_LINES:
            yield _packs(held)
            held, rows = [], 0
    if rows:
        yield _packs(held)


def unpacked(frames: Iterator[pd.DataFrame]) -> tuple[list, dict, int]:
    """The names of states, the lines of the packs, and of the packs' newest times the earliest."""
    tables, texts, newest = [], [], []
    for frame in frames:
        if not len(frame):
            continue
        lengths = frame["poll_no"].map(len).to_numpy()
        texts.append(np.concatenate(frame["state"].tolist()))
        table = {c: np.repeat(frame[c].to_numpy(), lengths) for c in RUN}
        for c in ("poll_no", "line_no", "returncode", "us", "malformed"):
            table[c] = np.concatenate(frame[c].tolist()).astype(KINDS[c], copy=False)
        newest.append(np.maximum.reduceat(table["us"], np.cumsum(lengths) - lengths).min())
        tables.append(table)
    if not tables:
        return [""], _empty(*LINE, "us"), FIRST
    places, seen = pd.factorize(np.concatenate(texts))
    names = sorted({"", *seen})
    return names, renamed(_all(*tables) | {"state": places}, list(seen), names), min(newest)


def new_lines(keys: dict, lines: dict, delay_us: int) -> tuple[dict, dict]:
    """The lines not among the keys, each once, by its earliest time; and the keys with those of these lines."""
    known = {c: keys[c] for c in LINE} | {"us": np.full(len(keys["run"]), FIRST), "expires": keys["expires"]}
    both = _sorted(_all(known, lines | {"expires": lines["us"] + delay_us}), *LINE, "us")
    both = _rows(both, _firsts(both, LINE))
    return _rows(both, both["us"] != FIRST), {c: both[c] for c in (*LINE, "expires")}


POLL_COLUMNS = (*LINE, "ms")


def as_polls(lines: dict) -> dict:
    """Each line as a poll of its own."""
    stated = np.where(lines["state"] > 0, lines["line_no"], FIRST)
    return {c: lines[c] for c in LINE} | {"line_no": stated, "ms": lines["us"] // 1000}


def folded(polls: dict) -> dict:
    """One row per poll: its last state, its largest return code, its latest time; whether any is malformed."""
    polls = _sorted(polls, *POLL, "line_no", "state")
    starts = np.flatnonzero(_firsts(polls, POLL))
    if not len(starts):
        return polls
    last = _rows(polls, np.append(starts[1:], len(polls["run"])) - 1)
    return last | {
        "returncode": np.maximum.reduceat(polls["returncode"], starts),
        "malformed": np.logical_or.reduceat(polls["malformed"], starts),
        "ms": np.maximum.reduceat(polls["ms"], starts),
    }


def _missed(polls: dict) -> np.ndarray:
    return (polls["returncode"] != NO_CODE) & (polls["returncode"] != 0)


def _final(polls: dict, names: list) -> np.ndarray:
    return np.array([(name or fixed.NO_STATE) in fixed.FINAL_STATES for name in names])[polls["state"]]


def still_needed(polls: dict, names: list, settled: int, tolerated: int) -> np.ndarray:
    """Which polls may still matter: of each run the first that count, as many as it takes to give up,
    and those not yet ``settled``, of which further lines may come.
    """
    open_ = polls["ms"] > settled
    counts = ~open_ & (_missed(polls) | polls["malformed"] | _final(polls, names))
    return open_ | counts & (_running(counts, _firsts(polls, RUN)) <= tolerated + 1)


def stops(polls: dict, names: list, tolerated: int) -> tuple[np.ndarray, ...]:
    """Where the tracking of each run that has a stop stops: the rows, and for each its state, misses and
    whether it gave up.
    """
    first, missed = _firsts(polls, RUN), _missed(polls)
    misses = _running(missed, first)
    gave_up = missed & ~polls["malformed"] & (misses > tolerated)
    ends = gave_up | polls["malformed"] | _final(polls, names)
    at = np.flatnonzero(ends & (_running(ends, first) == 1))
    texts = np.array([name or fixed.NO_STATE for name in names], object)[polls["state"][at]]
    return at, np.where(polls["malformed"][at], fixed.MALFORMED_STATE, texts), misses[at], gave_up[at]


def reports(runs: dict, polls: dict, names: list, tolerated: int) -> pd.DataFrame:
    """How the tracking of the runs stands."""
    n = len(runs["run"])
    at, state, misses, gave_up = stops(polls, names, tolerated)
    to = _run_at(runs, _rows(polls, at))
    found = {name: np.full(n, None, object) for name in TRACKED_NAMES}
    found["run_id"][:] = runs["run"].tolist()
    found["run_id"][runs["no_run"]] = None
    found["tracked_state"][:] = fixed.STILL_RUNNING
    found["tracked_state"][to] = np.where(gave_up, fixed.POLL_GAVE_UP, state)
    found["driver_state"][to] = state
    found["stop_poll"][to] = polls["poll_no"][at].tolist()
    found["misses"][to] = misses.tolist()
    found["gave_up"][:] = False
    found["gave_up"][to] = gave_up.tolist()
    found["silent"][:] = True
    found["silent"][to] = False
    return pd.DataFrame(found, columns=TRACKED_NAMES, dtype=object)


def touched_runs(runs: dict, lines: dict) -> dict:
    """The runs with those of the lines, sorted, the latter ``touched`` and with the time of their last line."""
    of_lines = {c: lines[c] for c in RUN} | {
        "last": lines["us"] // 1000, "timer": np.zeros(len(lines["run"]), np.int64),
        "touched": np.ones(len(lines["run"]), bool),
    }
    both = _sorted(_all(runs | {"touched": np.zeros(len(runs["run"]), bool)}, of_lines), *RUN)
    starts = np.flatnonzero(_firsts(both, RUN))
    if not len(starts):
        return both
    return {c: both[c][starts] for c in RUN} | {
        "last": np.maximum(np.maximum.reduceat(both["last"], starts), 0),
        "timer": np.maximum.reduceat(both["timer"], starts),
        "touched": np.logical_or.reduceat(both["touched"], starts),
    }


def _one_run(polls: dict[int, list], rows: list = ()) -> tuple[list, dict]:
    """Polls [line, state, returncode, malformed, time] by number, and lines, as polls of one run."""
    told = [
        *((n, FIRST if p[0] is None else p[0], NO_CODE if p[2] is None else p[2], p[1] or "", p[3], p[4]) for n, p in polls.items()),
        *((n, line if state else FIRST, code, state or "", bad, time) for n, line, code, time, state, bad in rows),
    ]
    names = sorted({"", *(x[3] for x in told)})
    columns = zip(("poll_no", "line_no", "returncode", "state", "malformed", "ms"), zip(*told) if told else [()] * 6)
    values = {c: [names.index(x) for x in v] if c == "state" else list(v) for c, v in columns}
    table = {c: np.array(v, KINDS[c]) for c, v in values.items()}
    return names, folded(table | {"run": np.zeros(len(told), np.int64), "no_run": np.zeros(len(told), bool)})


def follow(polls: dict[int, list], tolerated: int) -> tuple:
    """Where the tracking of one run stops over its polls [line, state, returncode, malformed, time] by number."""
    names, table = _one_run(polls)
    run = {"run": np.zeros(1, np.int64), "no_run": np.zeros(1, bool)}
    return tuple(reports(run, table, names, tolerated).iloc[0, 1:])


def kept_polls(polls: dict[int, list], settled: int, tolerated: int) -> dict[int, list]:
    """The polls of one run that are ``still_needed``."""
    names, table = _one_run(polls)
    return {n: polls[n] for n in table["poll_no"][still_needed(table, names, settled, tolerated)].tolist()}


def merge_lines(polls: dict[int, list], rows: Iterator[tuple]) -> None:
    """Adds lines to the polls of one run; lines that are there already change nothing."""
    names, table = _one_run(polls, list(rows))
    for n, line, code, state, bad, time in zip(*(table[c].tolist() for c in ("poll_no", "line_no", "returncode", "state", "malformed", "ms"))):
        polls[n] = [line if state else None, names[state] or None, None if code == NO_CODE else code, bad, time]


def _milliseconds(interval: str) -> int:
    return int(pd.Timedelta(interval).total_seconds() * 1000)


TRACKED_NAMES = [part.split()[0] for part in TRACKED.split(", ")]


def loaded(state: bytes) -> tuple:
    """The last watermark, the names of states, the keys of lines, the polls and the runs of a group."""
    return pickle.loads(zlib.decompress(state))


def dumped(*held) -> bytes:
    return zlib.compress(pickle.dumps(held, pickle.HIGHEST_PROTOCOL), 1)


def timed_tracking(
    polls: DataFrame, gap: str = "30 minutes", delay: str = "1 hour", tolerated: int = fixed.TOLERATED_MISSES,
    groups: int = 1024,
) -> DataFrame:
    """How the tracking of each run stands once it has been silent for ``gap``.

    A state row for each line, or a call into Python for each run, costs far more than what they hold.
    So of each micro-batch the lines of a run travel packed, and the runs share ``groups`` groups, by hash.
    A pack that comes again is dropped whole; a group drops the lines that come again in other packs and
    folds the rest by column. Each run keeps its own polls and timer within its group's state, and each line
    the time until which it is told; the group looks at them whenever the watermark has moved. A stream must
    keep the number it has started with.

    Spark leaves out a pack whose lines are all late, by the watermark of the batch before. A group knows that
    one by its last call, and leaves out single late lines. One without state takes the present watermark,
    unless a pack has come that is older.
    """
    gap_ms, delay_us = _milliseconds(gap), _milliseconds(delay) * 1000

    def track(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        before, names, keys, held, runs = loaded(state.get[0]) if state.exists else (
            None, [""], _empty(*LINE, "expires"), _empty(*POLL_COLUMNS), _empty(*RUN, "last", "timer")
        )
        watermark = state.getCurrentWatermarkMs()
        touched = np.zeros(len(runs["run"]), bool)
        if not state.hasTimedOut:
            seen, lines, newest = unpacked(frames)
            if before is not None:
                late = before * 1000
            else:
                late = watermark * 1000 if newest > watermark * 1000 else FIRST
            together = sorted({*names, *seen})
            keys, held = renamed(keys, names, together), renamed(held, names, together)
            lines, keys = new_lines(keys, renamed(_rows(lines, lines["us"] > late), seen, together), delay_us)
            names = together
            held = folded(_all(held, as_polls(lines)))
            runs = touched_runs(runs, lines)
            touched = runs.pop("touched")
            runs["timer"] = np.where(touched, np.maximum(runs["last"] + gap_ms, watermark + 1), runs["timer"])
            held = _rows(held, ~touched[_run_at(runs, held)] | still_needed(held, names, watermark, tolerated))
        silent = (runs["timer"] < watermark) & ~touched
        over = silent[_run_at(runs, held)]
        found = reports(_rows(runs, silent), _rows(held, over), names, tolerated) if silent.any() else None
        runs, held, keys = _rows(runs, ~silent), _rows(held, ~over), _rows(keys, keys["expires"] > watermark * 1000)
        if len(runs["run"]) or len(keys["run"]):
            used = sorted({0, *held["state"].tolist(), *keys["state"].tolist()})
            at = np.searchsorted(used, np.arange(len(names)))
            keys["state"], held["state"] = at[keys["state"]], at[held["state"]]
            state.update((dumped(watermark, [names[n] for n in used], keys, held, runs),))
            state.setTimeoutTimestamp(max(watermark, 1))
        else:
            state.remove()
        if found is not None:
            yield found

    lines = poll_lines(polls.where("polled_at IS NOT NULL"))
    grouped = lines.select(
        F.pmod(F.xxhash64("run_id", F.shiftright("poll_no", SLICE_BITS)), F.lit(groups)).alias("pack_group"),
        F.pmod(F.xxhash64("run_id"), F.lit(groups)).alias("run_group"), F.coalesce("run_id", F.lit(0)).alias("run"),
        F.col("run_id").isNull().alias("no_run"), "poll_no", "line_no", "returncode", "us", "state", "malformed",
    )
    packs = grouped.groupBy("pack_group").applyInArrow(packed, PACK).withWatermark("polled_at", delay)
    once = packs.dropDuplicatesWithinWatermark(["run_group", "run", "no_run", "digest"])
    return once.groupBy("run_group").applyInPandasWithState(track, TRACKED, "runs binary", "append", "EventTimeTimeout")


def stream_track_timed(
    polls: DataFrame, path: str, checkpoint: str, gap: str = "30 minutes", delay: str = "1 hour",
    tolerated: int = fixed.TOLERATED_MISSES, trigger: dict | None = None,
) -> StreamingQuery:
    """Writes each run's report when its timer fires, each micro-batch under its number."""
    return _append_batches(timed_tracking(polls, gap, delay, tolerated), path, checkpoint, trigger)


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """All reports; a run that polls anew after a silence has several."""
    return spark.read.schema(f"{TRACKED}, {BATCH} bigint").parquet(path).drop(BATCH)
