"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # fused code over very many columns outgrows what the JVM compiles and is then interpreted, row by row
    "spark.sql.codegen.maxFields": "30",
    # merge a user's sessions before the shuffle, so a hot user ships few rows
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# the shuffles of a write leave the disk with the write, not with the next large clean-up of the driver's heap
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on; sizes stay the cluster's own."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    A machine-local folder serves only a local master; a cluster must name its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set: {master} needs a folder that all executors share")
    return tempfile.mkdtemp(prefix="run-")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back; survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the plans that are run inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def lean_writer(df: DataFrame) -> DataFrameWriter:
    """A writer for large frames that take part in a longer job: compressed more."""
    return df.write.option("compression", "zstd")


def cut_lean(df: DataFrame, name: str = "stage") -> DataFrame:
    """:func:`cut_lineage` for large frames: less of them on disk, and nothing of their shuffles once they are written."""
    return Scratch(df.sparkSession).cut(df, name)


def file_system(spark: SparkSession, path: str):
    """The file system of ``path``, and ``path`` as it takes it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


class Scratch:
    """Frames stored on the way to another one; they are deleted when the block ends without a fault.

    By then all that is made of them must be stored: a frame that still reads them fails.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def cut(self, df: DataFrame, name: str = "stage") -> DataFrame:
        path = fresh_path(self.spark, name)
        self.paths.append(path)
        with settings(self.spark, FREE_SHUFFLES):
            lean_writer(df).mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, fault, *_) -> None:
        if fault is None:
            for path in self.paths:
                fs, at = file_system(self.spark, path)
                fs.delete(at, True)
            self.paths.clear()
