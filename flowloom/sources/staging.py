"""Tables written once in the shared folder and read back.

A staged table cuts the lineage: what was expensive to compute (a scan of all events, a global
order) is not computed again by the next step or after an executor is lost, and the rows
with their positions can no longer change between two uses.
"""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="flowloom-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses."""
    path = f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.paths.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the table and read it back. The folder is deleted with the scope it was made in, or by `drop_staged`."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class staged_scope:
    """`with staged_scope(spark):` deletes at its end what was staged inside, when a job's result has been written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> staged_scope:
        _scopes.append(self)
        return self

    def __exit__(self, *_) -> None:
        _scopes.remove(self)
        for path in self.paths:
            _delete(self.spark, path)


def staged_result(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """Stage what `build` returns and delete what it staged on the way."""
    path = fresh_path(spark, name)
    with staged_scope(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Scopes that are open; steps of one job may run in several threads.
_scopes: list[staged_scope] = []


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete all this application has staged, when no result that reads it is needed any more."""
    _delete(spark, _application_folder(spark))
