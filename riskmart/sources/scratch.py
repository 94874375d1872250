"""Intermediate results on the folder every executor can reach.

Lineage is cut only by a reliable checkpoint or a written table, so a lost
executor never loses an intermediate result.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from riskmart.settings import METHOD_LIMIT

FOLDER_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder named by the session; a session that is one process and names none gets a fresh one."""
    context = spark.sparkContext
    folder = spark.conf.get(FOLDER_SETTING, None) or context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError(f"{FOLDER_SETTING} must name a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="riskmart-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Stages too large for the JVM to compile are split up in the jobs run inside; a limit that the session has below that stays."""
    name, limit = METHOD_LIMIT
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(int(before), int(limit))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """The same rows, computed once and kept on the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def settled(df: DataFrame) -> DataFrame:
    """A table of statistics computed once and written.

    What joins it knows its size on disk, and broadcasts it only if that is small.
    """
    return Staging(df.sparkSession).table(df, "table")


class Staging:
    """Written intermediate tables under one new folder.

    The folder goes at the end of a ``with`` block, or else with the application, as results that are not
    computed yet may still read it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/riskmart-{uuid.uuid4().hex}"
        system, location = hadoop_path(spark, self.root)
        system.mkdirs(location)
        system.deleteOnExit(location)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        """``df`` written as Parquet and read back, so later passes prune columns and partitions.

        With ``partition_by`` the rows are rebalanced on it first: adaptive execution splits
        a partition value that holds most rows over many tasks and files.
        """
        if partition_by:
            writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by)
        else:
            writer = df.write
        with compiled(self.spark):
            writer.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(df.columns)

    def remove(self) -> None:
        delete_path(self.spark, self.root)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        self.remove()


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of ``path`` on whichever Hadoop file system holds it."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def delete_path(spark: SparkSession, path: str) -> None:
    system, location = hadoop_path(spark, path)
    system.delete(location, True)
