"""Folders that all executors of a session can reach."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the session's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        master = spark.conf.get("spark.master")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="runtrail-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
