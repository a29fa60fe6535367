"""Schemas of the input tables. Every reader states its schema; none is inferred.

Spark keeps no row order, so each log table carries the number that orders it
(``line_no``, ``poll_no``, ``attempt``), unique within its run.
"""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(**columns):
    return StructType([StructField(name, kind) for name, kind in columns.items()])


CONNECTIONS = _table(
    conn_id=StringType(), host=StringType(), port=IntegerType(), extra=StringType()
)
RUNS = _table(
    run_id=LongType(), conn_id=StringType(), spark_binary=StringType(), conf=StringType(),
    cmd=StringType(), returncode=IntegerType(), env_vars=StringType(),
    cancelled=BooleanType(), launcher_alive=BooleanType(),
)
SUBMIT_LOG = _table(run_id=LongType(), line_no=IntegerType(), line=StringType())
STATUS_POLLS = _table(
    run_id=LongType(), poll_no=IntegerType(), line_no=IntegerType(), line=StringType(),
    returncode=IntegerType(),
)
APP_INFO = _table(run_id=LongType(), body=StringType())
HISTORY = _table(
    run_id=LongType(), attempt=IntegerType(), status_code=IntegerType(), body=StringType()
)
EXECUTORS = _table(run_id=LongType(), status_code=IntegerType(), body=StringType())
LOG_PAGES = _table(run_id=LongType(), attempt=IntegerType(), html=StringType())
POD_LOG = _table(run_id=LongType(), line_no=IntegerType(), line=StringType())
POD_LOG_BYTES = _table(run_id=LongType(), log=BinaryType())

# The same lines with the time at which they were written.
TIMED_LOG = StructType([*SUBMIT_LOG.fields, StructField("logged_at", TimestampType())])
TIMED_POLLS = StructType([*STATUS_POLLS.fields, StructField("polled_at", TimestampType())])
# Runs with their start, and the settings of connections from a time on.
STARTED_RUNS = StructType([*RUNS.fields, StructField("started_at", TimestampType())])
CONNECTION_VERSIONS = StructType([*CONNECTIONS.fields, StructField("valid_from", TimestampType())])

# Pod logs cut into chunks of any size, numbered from 0 within their run.
POD_LOG_CHUNKS = _table(run_id=LongType(), chunk_no=LongType(), bytes=BinaryType())

TABLES = {
    "connections": CONNECTIONS,
    "runs": RUNS,
    "submit_log": SUBMIT_LOG,
    "status_polls": STATUS_POLLS,
    "app_info": APP_INFO,
    "history": HISTORY,
    "executors": EXECUTORS,
    "log_pages": LOG_PAGES,
    "pod_log": POD_LOG,
    "timed_log": TIMED_LOG,
    "timed_polls": TIMED_POLLS,
}
