"""Staging of a shared intermediate result in reliable storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def configured_folder(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir`` of the session, or the folder given to ``setCheckpointDir``."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor and the driver can reach; every session must name one."""
    folder = configured_folder(spark)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    return folder


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


_run: ContextVar[str | None] = ContextVar("staging_run", default=None)


@contextmanager
def staging_run(spark: SparkSession) -> Iterator[str]:
    """Stage into one folder of its own, which is removed when the work inside has succeeded.

    After a failure it stays, as whatever read from it may have to be looked at.
    """
    folder = fresh_folder(spark, "run")
    outer = _run.set(folder)
    try:
        yield folder
    finally:
        _run.reset(outer)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, partition_by: str | None = None, outlives: bool = False) -> DataFrame:
    """Compute ``df`` once into a table in the shared folder and read it from there.

    This cuts the lineage: whatever executors are lost later, the facts are not read again. Readers
    of the table fetch only the columns, and with ``partition_by`` the part, that they use. A table that
    ``outlives`` its :func:`staging_run`, as the result of the work inside, is not removed with it.
    """
    spark = df.sparkSession
    within = None if outlives else _run.get()
    folder = f"{within}/stage-{uuid.uuid4().hex}" if within else fresh_folder(spark, "stage")
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder).select(*df.columns)
