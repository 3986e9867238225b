"""Derived tables in the shared scratch folder.

A stage that several later steps read is written once as Parquet and read back. That
cuts the lineage and, unlike a cached frame, outlives the executors that computed it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folder: str | None = None


def scratch_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode without one."""
    global _own_folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own_folder is None:
        _own_folder = tempfile.mkdtemp(prefix="tillroll-")
    return _own_folder


def hadoop_path(spark: SparkSession, path: str):
    """A path of any file system Spark knows, and that file system."""
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark._jsc.hadoopConfiguration())


def write_scratch(frame: DataFrame, name: str, partition_by: str | None = None) -> str:
    spark = frame.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{scratch_folder(spark)}/tillroll/{app}/{name}-{uuid.uuid4().hex}"
    writer = frame.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return path


def materialize(frame: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``frame`` and return the stored table."""
    path = write_scratch(frame, name, partition_by)
    return frame.sparkSession.read.schema(frame.schema).parquet(path).select(*frame.columns)


@contextmanager
def scratch_table(
    frame: DataFrame, name: str, partition_by: str | None = None
) -> Iterator[DataFrame]:
    """As ``materialize``, but the table is deleted when the block ends."""
    path = write_scratch(frame, name, partition_by)
    try:
        yield frame.sparkSession.read.schema(frame.schema).parquet(path).select(*frame.columns)
    finally:
        located, fs = hadoop_path(frame.sparkSession, path)
        fs.delete(located, True)


class Stages:
    """Named derived tables of one input directory.

    A table is built on first use and read back afterwards, for as long as the input
    files are unchanged (name, size, time) and the stored table is still there.
    """

    _stored: dict[tuple, str] = {}

    def __init__(self, spark: SparkSession, directory: str, inputs: tuple[str, ...]):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._inputs = inputs

    def _fingerprint(self) -> tuple:
        marks = []
        for name in self._inputs:
            path, fs = hadoop_path(self.spark, f"{self.directory}/{name}.parquet")
            size = fs.getContentSummary(path)
            marks.append(
                (
                    name,
                    size.getLength(),
                    size.getFileCount(),
                    fs.getFileStatus(path).getModificationTime(),
                )
            )
        return (self.spark.sparkContext.applicationId, self.directory, *marks)

    def table(
        self, name: str, build: Callable[[], DataFrame], partition_by: str | None = None
    ) -> DataFrame:
        key = (name, *self._fingerprint())
        path, schema = self._stored.get(key, (None, None))
        if path is None or not self._complete(path):
            frame = build()
            path, schema = write_scratch(frame, name, partition_by), frame.schema
            self._stored[key] = path, schema
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)

    def value(self, name: str, compute: Callable[[], object]) -> object:
        """A small driver-side result that belongs to the same inputs."""
        key = (name, *self._fingerprint())
        if key not in self._stored:
            self._stored[key] = compute()
        return self._stored[key]

    def _complete(self, path: str) -> bool:
        marker, fs = hadoop_path(self.spark, f"{path}/_SUCCESS")
        return fs.exists(marker)

    @classmethod
    def forget(cls) -> None:
        """Build every table anew on its next use."""
        cls._stored = {}

    @classmethod
    def release(cls, spark: SparkSession) -> None:
        """Delete every stage table this application wrote."""
        app = spark.sparkContext.applicationId
        path, fs = hadoop_path(spark, f"{scratch_folder(spark)}/tillroll/{app}")
        fs.delete(path, True)
        cls._stored = {key: kept for key, kept in cls._stored.items() if app not in key}
