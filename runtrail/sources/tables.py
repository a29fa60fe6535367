"""Readers and writers of the input and result tables."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType, VariantType

from runtrail import schemas
from runtrail.sources.workdir import new_folder


def read_table(spark: SparkSession, name: str, path: str, fmt="parquet") -> DataFrame:
    """An input table by name, from parquet, JSON lines or any format Spark reads."""
    return spark.read.schema(schemas.TABLES[name]).format(fmt).load(path)


def stream_table(spark: SparkSession, name: str, path: str, fmt="parquet", **options) -> DataFrame:
    """The same as a stream over the files that arrive in a folder."""
    reader = spark.readStream.schema(schemas.TABLES[name]).format(fmt)
    return reader.options(**options).load(path)


def read_submit_log(spark, path, fmt="parquet"):
    return read_table(spark, "submit_log", path, fmt)


def read_status_polls(spark, path, fmt="parquet"):
    return read_table(spark, "status_polls", path, fmt)


def read_app_info(spark, path, fmt="parquet"):
    return read_table(spark, "app_info", path, fmt)


def read_history(spark, path, fmt="parquet"):
    return read_table(spark, "history", path, fmt)


def read_executors(spark, path, fmt="parquet"):
    return read_table(spark, "executors", path, fmt)


def read_log_pages(spark, path, fmt="parquet"):
    return read_table(spark, "log_pages", path, fmt)


def read_pod_log(spark, path, fmt="parquet"):
    return read_table(spark, "pod_log", path, fmt)


def read_pod_log_bytes(spark: SparkSession, path: str, fmt="parquet") -> DataFrame:
    """Pod logs given whole as bytes."""
    return spark.read.schema(schemas.POD_LOG_BYTES).format(fmt).load(path)


#: Splits of files whose line counts may be broadcast: some 40 MB at most.
BROADCAST_SPLITS = 1 << 18


def _places(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines of text with the split that each was read from, and a ``row`` that grows within it."""
    return lines.select(
        "run_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col(line).alias("line"),
    )


def _shifts(splits: DataFrame, first, purpose: str) -> DataFrame:
    """What to add to a line's number in its split: the lines in the run's earlier splits, less ``first``."""
    earlier = Window.partitionBy("run_id").orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - first
    spark = splits.sparkSession
    counted = f"{new_folder(spark, purpose)}/splits"
    splits.select("run_id", "file", "block", shift.alias("shift")).write.parquet(counted)
    return spark.read.schema("run_id bigint, file string, block bigint, shift bigint").parquet(counted)


def read_submit_log_text(spark: SparkSession, path: str, shared: bool = False) -> DataFrame:
    """Plain log files under ``run_id=<id>`` folders, split at \\n, \\r\\n and \\r, with their lines
    numbered from 1 within each run; ``shared`` files hold many runs, as ``write_shared_text`` writes them.

    Text has no line numbers. Spark reads a file in splits, each by one task from top to bottom, so
    a line's number is its place in its split after all lines of the run's earlier splits, by file
    name and offset. A first pass counts the lines of each split, which needs no text; running sums of
    these few numbers then meet the lines by a broadcast, and no text is shuffled. Beyond
    ``BROADCAST_SPLITS`` splits the numbers meet the lines by a shuffle join.

    In shared files the lines of a run may lie among those of others: they meet by run and split to
    be numbered, and only the runs in more than one split have earlier lines to add. A run with most
    lines is spread by its splits.
    """
    if shared:
        return _read_shared_text(spark, path)
    lines = _places(spark.read.schema("value string, run_id bigint").text(path))
    places = ["run_id", "file", "block"]
    splits = lines.groupBy(*places).agg(F.count("*").alias("n"), F.min("row").alias("first"))
    shifts = _shifts(splits, F.col("first") - 1, "line-counts")
    if shifts.count() <= BROADCAST_SPLITS:
        shifts = F.broadcast(shifts)
    same = [lines[c].eqNullSafe(shifts[c]) for c in places]
    return lines.join(shifts, same).select(
        lines["run_id"], (lines["row"] + shifts["shift"]).alias("line_no"), lines["line"]
    )


def _read_shared_text(spark: SparkSession, path: str) -> DataFrame:
    run, line = F.substring_index("value", "\t", 1), F.col("value").substr(F.instr("value", "\t") + 1, F.length("value"))
    lines = _places(spark.read.text(path).select(F.nullif(run, F.lit("")).cast("bigint").alias("run_id"), line.alias("line"), "_metadata"), "line")
    places = ["run_id", "file", "block"]
    splits = lines.groupBy(*places).agg(F.count("*").alias("n"))
    several = splits.withColumn("splits", F.count("*").over(Window.partitionBy("run_id"))).where("splits > 1")
    shifts = _shifts(several, F.lit(0), "line-counts")
    in_split = F.row_number().over(Window.partitionBy(*places).orderBy("row"))
    numbered = lines.withColumn("at", in_split)
    if shifts.count() <= BROADCAST_SPLITS:
        shifts = F.broadcast(shifts)
    same = [numbered[c].eqNullSafe(shifts[c]) for c in places]
    return numbered.join(shifts, same, "left").select(
        numbered["run_id"], (numbered["at"] + F.coalesce(shifts["shift"], F.lit(0))).alias("line_no"), numbered["line"]
    )


def write_shared_text(log: DataFrame, path: str) -> None:
    """Write log lines as text files of many runs, each line after its run's id and a tab.

    A file per run costs more to open than to read when there are many runs. Ranges of run and line
    number make the files, so that a run with most lines is spread; a line that holds line ends is
    written as several, a null one as an empty one, a null run as no id.
    """
    ordered = log.repartitionByRange("run_id", "line_no").sortWithinPartitions("run_id", "line_no")
    pieces = F.explode(F.split(F.coalesce("line", F.lit("")), "\r\n|\n|\r"))
    tagged = ordered.select("run_id", pieces.alias("line")).select(
        F.concat(F.coalesce(F.col("run_id").cast("string"), F.lit("")), F.lit("\t"), "line").alias("value")
    )
    tagged.write.text(path)


#: The tables that a run's outcome needs, each with a row's run: landed by the month the run started.
BY_RUN = ("runs", "submit_log", "status_polls")


def read_month(spark: SparkSession, name: str, path: str, month: str, fmt="parquet") -> DataFrame:
    """An input table landed by ``run_date`` (``write_facts``), one month of it.

    The condition is on folders: no file of another month is listed for reading. Log lines and polls
    lie under the month of their run's start, so that a question about a month's runs reads that month
    of every table.
    """
    schema = schemas.TABLES[name]
    rows = spark.read.schema(StructType([*schema.fields, StructField("run_date", DateType())])).format(fmt).load(path)
    return rows.where(F.col("run_date") == F.lit(month).cast("date")).drop("run_date")


def by_run_date(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows of runs with the date of their run. The runs grow with the data, so they are never broadcast,
    however small their file is.
    """
    return rows.join(starts.hint("merge"), "run_id")


def write_facts(facts: DataFrame, path: str, date: str = "run_date", mode="append") -> None:
    """Write results partitioned by a date column of the input.

    The rebalance hint lets Spark size the files and split a day that holds most rows.
    """
    facts.hint("rebalance", date).write.mode(mode).partitionBy(date).parquet(path)


def append_by_run(facts: DataFrame, table: str, path: str, buckets: int, key: str = "run_id") -> None:
    """Append facts to a table bucketed and sorted by run, one file per bucket.

    Tables with the same number of buckets meet on the key without an exchange. Facts hold few rows
    per run, so that no bucket is much larger than the others.
    """
    writer = facts.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.mode("append").format("parquet").option("path", path).saveAsTable(table)


def land_replies(replies: DataFrame, path: str, body: str = "body", mode="append") -> None:
    """Write service replies with their JSON text parsed once, as a variant column ``reply``.

    Text that is no JSON is written as NULL.
    """
    parsed = replies.withColumn("reply", F.try_parse_json(body)).drop(body)
    parsed.write.mode(mode).parquet(path)


def read_replies(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Replies that ``land_replies`` has written, of the kind of an input table."""
    kept = [f for f in schemas.TABLES[name].fields if f.name != "body"]
    return spark.read.schema(StructType([*kept, StructField("reply", VariantType())])).parquet(path)


def stream_facts(
    facts: DataFrame, path: str, checkpoint: str, date: str | None = None, trigger=None
) -> StreamingQuery:
    """Write facts of single lines as they arrive, each once, partitioned by date if given."""
    writer = facts.writeStream.outputMode("append").format("parquet")
    if date is not None:
        writer = writer.partitionBy(date)
    return (
        writer.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )
