"""Helpers shared by the document operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fringeline.storage import kept as kept
from fringeline.storage import scratch as scratch
from fringeline.storage import written as written

#: White space of the contracts: ASCII only, which is also what bytes.split() cuts at.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"

#: Maps every ASCII byte that is neither a digit nor a lower-case letter to a space; apply after bytes.lower().
_WORD_TABLE = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def ascii_words(text: bytes) -> list[bytes]:
    """Lower-case A-Z and return the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text."""
    return text.lower().translate(_WORD_TABLE).split()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def joined_hash(items: Column) -> Column:
    """Lower-case hex SHA-256 of an array of strings, comma-joined."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def give_back() -> None:
    """Hands freed memory of this Python worker back to the system. Workers outlive their tasks, and what one step has freed would stand beside
    what the next one takes."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def giving_back(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``f`` of mapInArrow or mapInPandas, with give_back() behind its last batch."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from f(batches)
        finally:
            give_back()

    return wrapped
