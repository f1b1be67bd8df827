"""Catalogue tables in a database, read in parallel by ranges of a key."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
#: Parts of the names of faults that may pass: connections that broke or could not be made.
PASSING = ("Transient", "Connection", "Communications", "Recoverable", "Timeout")


def retried(call: Callable[[], T], tries: int = 3, wait: float = 1.0) -> T:
    """The result of a call, which is made again after ``wait``, twice that, and so on while its fault is one of the connection. Other faults, and the last,
    are raised. This is for what the driver asks a database; a task that loses its connection is run again by Spark."""
    for n in range(tries):
        try:
            return call()
        except Exception as fault:  # noqa: BLE001
            said = f"{type(fault).__name__} {fault}"
            if n + 1 == tries or not any(part in said for part in PASSING) or isinstance(fault, PySparkException) and "Connection" not in said:
                raise
            time.sleep(wait * 2**n)
    raise ValueError("tries must be 1 or more")


def catalogue_table(spark: SparkSession, url: str, table: str, key: str | None = None, partitions: int = 16, fetch: int = 10_000, tries: int = 3, **options: str) -> DataFrame:
    """A table of a database. With ``key``, a number, date or time, it is read in ``partitions`` ranges of the key between its smallest and largest value,
    which are asked for first (rows with a null key are in the first range); without, by one task.

    Filters and columns of what is made of it go into the database's own query, and values travel as literals that Spark writes, never as pieces of
    text put together here. ``options`` are those of the reader, such as driver, user and password.
    """
    reader = spark.read.format("jdbc").options(**options, url=url, dbtable=table, fetchsize=str(fetch))
    plain = retried(reader.load, tries)
    if key is None:
        return plain
    low, high = retried(lambda: plain.agg(F.min(key), F.max(key)).first(), tries)
    if low is None or low == high:
        return plain
    ranged = reader.options(partitionColumn=key, lowerBound=str(low), upperBound=str(high), numPartitions=str(partitions))
    return retried(ranged.load, tries)


def asked(spark: SparkSession, sql: str, tables: dict[str, DataFrame], **values: object) -> DataFrame:
    """Any query on tables ({name}), with its values (:name) bound as parameters."""
    return spark.sql(sql, args=values, **tables)
