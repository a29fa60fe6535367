"""What several operators share: narrow inputs, written tables, word separators."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters between words, for ``trim`` and as a pattern.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.

    Only a session on one machine without that setting gets a temporary folder, removed at exit.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="runtrail-llm-"))
        atexit.register(shutil.rmtree, _own_folder[0], True)
    return _own_folder[0]


_written: list[str] = []


@contextlib.contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what ``written`` has written within it; nothing may read it afterwards."""
    first = len(_written)
    try:
        yield
    finally:
        paths, _written[first:] = _written[first:], []
        for path in paths:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame, written as Parquet to the shared folder and read from there.

    Cuts the lineage: a lost executor costs no work done before, and nothing is computed twice.
    """
    path = f"{shared_folder(frame.sparkSession)}/{purpose}-{uuid.uuid4().hex}"
    _written.append(path)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def narrow(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` and ``text``, and the carried columns together in a struct ``rest``."""
    columns = [docs[id_col].alias("doc_id"), docs[text_col].alias("text")]
    if carry:
        columns.append(F.struct(*[docs[c] for c in carry]).alias("rest"))
    return docs.select(*columns)


def others(docs: DataFrame, id_col: str, text_col: str) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c not in (id_col, text_col))


def restored(frame: DataFrame, columns: list[str], id_col: str, text_col: str) -> list[Column]:
    """The columns of the original frame out of ``doc_id``, ``text`` and ``rest``."""
    own = {id_col: "doc_id", text_col: "text"}
    return [
        (frame[own[c]] if c in own else frame["rest"].getField(c)).alias(c) for c in columns
    ]


def words_of(text: Column) -> Column:
    """The words between blanks; null has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, UPPER, UPPER.lower())
