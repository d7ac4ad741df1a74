"""The shared folder for intermediate tables.

On a cluster it is the folder named by ``spark.checkpoint.dir``. Only a local
master, where driver and executors share one disk, gets a folder of its own.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder(application_id: str) -> tempfile.TemporaryDirectory:
    """Lives as long as the Python process."""
    return tempfile.TemporaryDirectory(
        prefix=f"basketseq-{application_id}-", ignore_cleanup_errors=True
    )


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        # One set on the context after the session began.
        chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = chosen.get() if chosen.isDefined() else None
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(spark.sparkContext.applicationId).name


def new_folder(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more, wherever it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def dropping_shuffles(spark: SparkSession):
    """Shuffle files of the writes within go once their table is written.

    Otherwise they stay until the driver collects garbage, which it rarely needs to do:
    jobs that follow each other then hold the shuffles of all of them on disk.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The rows are then fixed: a lost executor rereads the files, nothing above
    is computed again, and Catalyst knows the real size.
    """
    path = new_folder(df.sparkSession, label)
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
