"""Shared checkpoint folder of a session, and tables written there to cut lineages."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables written in the innermost scratch() of this thread.
_scope: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one is set only in local mode where none is set."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def written(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back; ``by`` are columns that get a folder for each value.

    This cuts the lineage: a lost executor costs a re-read and no recomputation.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    if (scope := _scope.get()) is not None:
        scope.append(path)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside go when it ends; write what is to stay after it: ``with scratch(spark): small = kept(...)``."""
    own: list[str] = []
    token = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in own:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def kept(df: DataFrame) -> DataFrame:
    """written() for a result that outlives the scratch() around it."""
    token = _scope.set(None)
    try:
        return written(df)
    finally:
        _scope.reset(token)
