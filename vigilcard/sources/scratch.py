"""Intermediate tables in the cluster's shared checkpoint folder.

A table written there cuts lineage and survives the loss of executors, and later steps read
back only the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="vigilcard-"))
    return context._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the scratch folder."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of an action go when it ends, not when the driver happens to
    collect its garbage; so a job of many actions needs the disk of its largest one.

    For actions whose input is stored: a table that shuffles would do so again for each action.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


class Scratch:
    """Tables staged for one job, removed together by :meth:`release`."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._paths: list[str] = []

    def stage(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Writes a DataFrame to the scratch folder and returns the stored table.

        With ``by``, a column of few values, readers that filter on it open only their part.
        """
        path = scratch_path(self.spark, name)
        self._paths.append(path)
        (df.write if by is None else df.write.partitionBy(by)).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Deletes the staged tables; results that read them must not be used afterwards."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self._paths:
            location = hadoop.Path(path)
            location.getFileSystem(conf).delete(location, True)
        self._paths.clear()
