"""Streams written as mergeable parts.

Every micro-batch folds its own lines with the batch operators and writes the picks under
its batch number; reading merges the picks of all batches. Nothing is kept between
batches, so no state grows with the number of runs and no late line is lost. A batch that
is repeated after a failure overwrites its own folder, so it counts once.

A stream that runs for long leaves many folders. ``compact_fold`` and ``compact_track`` merge those
of the batches up to a number into one new folder; read with that folder, only newer batches are
read from the stream's own. The stream may go on meanwhile. A later compaction starts from the last
one and reads only the batches since, so that merging costs what is new plus one row per run. It
never writes into a folder that exists: a reader of an earlier one is not disturbed.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from runtrail import schemas
from runtrail.operators.fold import fold_parts, ids_of_parts, merge_parts
from runtrail.operators.polls import (
    counted_polls,
    follow_polls,
    merge_poll_parts,
    poll_parts,
    states_of_parts,
)

BATCH = "stream_batch"

#: Rows of polls that one task sorts.
ROWS_PER_TASK = 1_000_000


#: Polls of a run that lie together, as a power of two: the slices of a long run are dealt to many tasks.
SLICE_BITS = 10


def _more_tasks(rows: DataFrame) -> int | None:
    """As many tasks as the rows need, where the session's number is too few.

    A fold has as many tasks as the session says, however much comes in, so that what each sorts in
    memory grows with the input.
    """
    tasks = -(-rows.count() // ROWS_PER_TASK)
    return tasks if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def _by_poll(rows: DataFrame) -> DataFrame:
    tasks = _more_tasks(rows)
    return rows.repartition(tasks, "run_id", "poll_no") if tasks else rows


def _poll_parts(polls: DataFrame) -> DataFrame:
    return poll_parts(_by_poll(polls))


def _merge_poll_parts(parts: DataFrame) -> DataFrame:
    return merge_poll_parts(_by_poll(parts))


def write_parts(
    stream: DataFrame, to_parts: Callable, path: str, checkpoint: str, trigger: dict
) -> StreamingQuery:
    def write_batch(batch: DataFrame, number: int):
        to_parts(batch).write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _parts_schema(spark: SparkSession, to_parts: Callable, table: StructType) -> StructType:
    return to_parts(spark.createDataFrame([], table)).schema


def read_parts(
    spark: SparkSession, path: str, schema: StructType, compacted: tuple[str, int] | None = None
) -> DataFrame:
    """Parts of all batches; those up to a number from the folder they were compacted into."""
    batch = StructField(BATCH, LongType())
    parts = spark.read.schema(StructType([*schema.fields, batch])).parquet(path)
    if compacted is None:
        return parts.drop(BATCH)
    folder, upto = compacted
    newer = parts.where(F.col(BATCH) > upto).drop(BATCH)
    return spark.read.schema(schema).parquet(folder).unionByName(newer)


def _compact(
    spark, path, schema, merge: Callable, upto: int, folder: str, last: tuple[str, int] | None
) -> tuple[str, int]:
    batch = StructField(BATCH, LongType())
    parts = spark.read.schema(StructType([*schema.fields, batch])).parquet(path)
    # A condition on the batch number is one on folders: others are not opened.
    older = parts.where(F.col(BATCH) <= upto)
    if last is not None:
        older = older.where(F.col(BATCH) > last[1])
    older = older.drop(BATCH)
    if last is not None:
        older = spark.read.schema(schema).parquet(last[0]).unionByName(older)
    merge(older).select(*schema.names).write.mode("error").parquet(folder)
    return folder, upto


def compact_fold(
    spark: SparkSession, path: str, upto: int, folder: str, table: StructType = schemas.SUBMIT_LOG,
    last: tuple[str, int] | None = None,
) -> tuple[str, int]:
    """Merge the parts of the batches up to a number into a new folder; gives what ``read_fold``
    takes. ``last`` is what an earlier compaction gave, to go on from.
    """
    return _compact(spark, path, _parts_schema(spark, fold_parts, table), merge_parts, upto, folder, last)


def compact_track(
    spark: SparkSession, path: str, upto: int, folder: str, last: tuple[str, int] | None = None
) -> tuple[str, int]:
    schema = _parts_schema(spark, poll_parts, schemas.STATUS_POLLS)
    return _compact(spark, path, schema, _merge_poll_parts, upto, folder, last)


def stream_fold(
    lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Fold submit-log lines as they arrive."""
    return write_parts(lines, fold_parts, path, checkpoint, trigger or {"availableNow": True})


def read_fold(
    spark: SparkSession, path: str, compacted: tuple[str, int] | None = None,
    table: StructType = schemas.SUBMIT_LOG,
) -> DataFrame:
    """The ids of each run over all lines that have arrived; ``table`` is the lines' schema."""
    schema = _parts_schema(spark, fold_parts, table)
    return ids_of_parts(merge_parts(read_parts(spark, path, schema, compacted)))


def stream_track(
    polls: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Fold status polls as they arrive; the lines of one poll may come in several batches."""
    return write_parts(polls, _poll_parts, path, checkpoint, trigger or {"availableNow": True})


def read_track(
    spark: SparkSession, path: str, compacted: tuple[str, int] | None = None
) -> DataFrame:
    """How the tracking of each polled run stands over all polls that have arrived."""
    schema = _parts_schema(spark, poll_parts, schemas.STATUS_POLLS)
    parts = read_parts(spark, path, schema, compacted)
    tasks = _more_tasks(parts)
    if tasks is None:
        return follow_polls(states_of_parts(merge_poll_parts(parts)))
    # Folded and cut by slices, so that few polls of a long run meet in the task that follows it.
    dealt = parts.withColumn("slice", F.shiftright("poll_no", SLICE_BITS)).repartition(tasks, "run_id", "slice")
    states = states_of_parts(merge_poll_parts(dealt, "slice"), "slice")
    left = counted_polls(states, by=("slice",)).drop("slice", "counted")
    return follow_polls(left.repartition(tasks, "run_id"))


def stateful_fold(lines: DataFrame) -> DataFrame:
    """The fold as a streaming aggregation, for sinks in update or complete mode.

    It keeps one row of state per run for good. Replayed lines do not change the picks.
    """
    return ids_of_parts(fold_parts(lines))


def append_updates(
    updates: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write the rows an aggregation updates in each micro-batch."""
    def write_batch(batch: DataFrame, number: int):
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return (
        updates.writeStream.outputMode("update").foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_updates(
    spark: SparkSession, path: str, key: str = "run_id", table: StructType = schemas.SUBMIT_LOG
) -> DataFrame:
    """The newest row of each key among the written updates of ``stateful_fold`` over ``table``."""
    schema = stateful_fold(spark.createDataFrame([], table)).schema
    updates = spark.read.schema(StructType([*schema.fields, StructField(BATCH, LongType())])).parquet(path)
    values = [c for c in updates.columns if c not in (key, BATCH)]
    newest = F.max(F.struct(BATCH, *values)).alias("newest")
    return updates.groupBy(key).agg(newest).select(key, *[f"newest.{c}" for c in values])
