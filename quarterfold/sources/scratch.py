"""Folders for tables written between the steps of a job.

The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
session without that setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="quarterfold-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody else writes to."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, on whatever file system the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder that this library wrote, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def shuffles_removed(*sessions: SparkSession) -> Iterator[None]:
    """Within it, what a query of these sessions has shuffled is removed when the query ends, rather than when the driver
    happens to collect its garbage. A query that runs once more shuffles once more."""
    before = [(s, s.conf.get(CLEANUP, "false")) for s in sessions]
    for session in sessions:
        session.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        for session, value in reversed(before):
            session.conf.set(CLEANUP, value)
