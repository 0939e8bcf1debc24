"""Session and shared-folder helpers. Nothing here holds or stops a session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(app_name: str = "tableferry") -> SparkSession:
    """Return the running session, or build one, with Arrow conversion on.

    Memory, cores and time-outs are left to spark-submit.
    """
    spark = SparkSession.builder.appName(app_name).getOrCreate()
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for staged data: ``spark.checkpoint.dir``, or the context's own.

    Only a local session may fall back to a folder of this machine, as other
    executors could not read it back.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{work_dir(spark)}/tableferry-{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str) -> tuple:
    """The file system that a path lies in, and the path as it takes it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it, if it is there."""
    system, target = file_system(spark, path)
    system.delete(target, True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that ``fresh_path`` named."""
    if "/tableferry-" not in path:
        raise ValueError(f"not a staged folder: {path}")
    delete_folder(spark, path)


_STAGED: list[str] = []


def note_staged(path: str) -> None:
    """Remember a staged folder, for ``removing_staged`` to delete."""
    _STAGED.append(path)


@contextmanager
def removing_staged(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what was noted inside; frames that read it must be written by then."""
    before = len(_STAGED)
    try:
        yield
    finally:
        while len(_STAGED) > before:
            remove_path(spark, _STAGED.pop())


def scratch_database(spark: SparkSession) -> str:
    """Create a database in the shared folder, for tables that need not last."""
    name = f"ferry_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_path(spark, 'db')}'")
    return name
