"""Exact deduplication against an immutable snapshot, screened by static binary-fuse filters.

* Texts are equal if they are identical after every run of ASCII white space became one space. Their digest is the
  SHA-256 of that in UTF-8; 60 bits of it are the filter key.
* A snapshot never changes, so its distinct keys get static filters, one for each key range of about ``FILTER_KEYS``.
  The filters are a table, joined by range and never broadcast.
* Distinct incoming keys are screened. What a filter rejects is surely new and meets only its own batch.
* What passes goes to the snapshot's exact bucket (the key). The normalised texts of these keys are read again on both sides, grouped by
  their bytes, and joined by key and bytes; a digest that two different texts share there is an error.
* Duplicates within the new batch are grouped separately, by digest, before anything is joined.

Of a group the row with the smallest doc_id stays; rows without an id come last; of repeated rows with that id, the first read
stays. So exactly one row of each group is kept. Rows are pre-aggregated by digest everywhere, so a text that holds a third of all rows is
one row in each join but the last, an equi-join of narrow rows with a written table, which adaptive execution splits. Null texts are empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringeline.llm.common import written

FILTER_KEYS = 40_000
#: Rows whose hashed id falls in this fold of ``FOLDS`` are the incoming batch of the query; the others are the snapshot.
FOLDS = 4
#: Keys up to which they are broadcast: 48 MB at the 96 bytes that one takes in memory.
BROADCAST_KEYS = 500_000
#: White space that isn't already one space: replacing only that gives the same text with far fewer replacements.
_ODD_SPACE = r"\x20[\x20\x09-\x0D]+|[\x09-\x0D][\x20\x09-\x0D]*"
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def normalised(text: str = "text"):
    return F.regexp_replace(F.coalesce(text, F.lit("")), _ODD_SPACE, " ")


def _key(digest: str = "digest"):
    return F.conv(F.substring(digest, 2, 15), 16, 10).cast("long")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, length, key) of every row."""
    rows = docs.select("doc_id", normalised().alias("flat")).select("doc_id", F.sha2(F.col("flat").cast("binary"), 256).alias("digest"), F.octet_length("flat").alias("length"))
    return rows.withColumn("key", _key())


def groups(rows: DataFrame) -> DataFrame:
    """(digest, length, key, least, n) of equal texts; counted before the shuffle. ``least`` is the row that stays."""
    return rows.groupBy("digest", "length", "key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "number")).alias("least"), F.count("*").alias("n"))


def texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, digest, flat): the distinct normalised texts, byte by byte, of the wanted keys."""
    rows = docs.select(normalised().alias("flat")).withColumn("digest", F.sha2(F.col("flat").cast("binary"), 256)).withColumn("key", _key())
    return rows.join(keys, "key", "left_semi").groupBy("key", "digest", "flat").agg(F.lit(True).alias("there")).drop("there")


class BinaryFuse:
    """A static three-wise binary-fuse filter of 8-bit fingerprints over distinct keys."""

    def __init__(self, seed: int, segment: int, segments: int, table: np.ndarray):
        self.seed, self.segment, self.segments, self.table = seed, segment, segments, table

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Three slots in successive segments, and the fingerprint, of each key."""
        with np.errstate(over="ignore"):
            h = keys.astype(np.uint64) + np.uint64((self.seed * _MIX[0]) & (2**64 - 1))
            h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX[1])
            h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX[2])
            h ^= h >> np.uint64(31)
        mask = np.uint64(self.segment - 1)
        # window start from the high half, place in each of its segments from separate bits
        start = ((h >> np.uint64(32)) * np.uint64(self.segments)) >> np.uint64(32)
        slots = [(start + np.uint64(i)) * np.uint64(self.segment) + ((h >> np.uint64(18 * i)) & mask if i else (h * np.uint64(_MIX[0]) >> np.uint64(40)) & mask) for i in range(3)]
        return np.stack(slots).astype(np.int64), (h ^ (h >> np.uint64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> "BinaryFuse":
        keys = np.unique(keys)
        n = max(len(keys), 2)
        segment = min(1 << 18, 1 << int(np.log(n) / np.log(3.33) + 2.25))
        room = int(n * max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(n))) + 64
        segments = max(1, -(-room // segment))
        for seed in range(1, 100):
            made = cls(seed, segment, segments, np.zeros((segments + 2) * segment, np.uint8))
            if made._fill(keys):
                return made
        raise RuntimeError("no seed peels these keys")

    def _fill(self, keys: np.ndarray) -> bool:
        """Peel slots with one key, all at once in each round; assign in reverse."""
        if not len(keys):
            return True
        slots, prints = self._places(keys)
        size, ids = len(self.table), np.arange(len(keys))
        count = np.bincount(slots.ravel(), minlength=size)
        total = np.bincount(slots.ravel(), weights=np.tile(ids, 3).astype(np.float64), minlength=size).astype(np.int64)
        rounds, left = [], len(keys)
        at = np.flatnonzero(count == 1)
        while len(at):
            who, first = np.unique(total[at], return_index=True)
            at = at[first]
            rounds.append((who, at))
            left -= len(who)
            touched = slots[:, who].ravel()
            np.subtract.at(count, touched, 1)
            np.subtract.at(total, touched, np.tile(who, 3))
            touched = np.unique(touched)
            at = touched[count[touched] == 1]
        if left:
            return False
        for who, at in reversed(rounds):
            a, b, c = (self.table[s] for s in slots[:, who])
            self.table[at] = prints[who] ^ a ^ b ^ c ^ self.table[at]
        return True

    def contains(self, keys: np.ndarray) -> np.ndarray:
        slots, prints = self._places(keys)
        return (self.table[slots[0]] ^ self.table[slots[1]] ^ self.table[slots[2]]) == prints


def _build(group: pd.DataFrame) -> pd.DataFrame:
    f = BinaryFuse.build(group["key"].to_numpy(np.int64))
    return pd.DataFrame({"range": group["range"].iloc[:1], "seed": [f.seed], "segment": [f.segment], "segments": [f.segments], "table": [f.table.tobytes()]})


def _screen(_, incoming: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    maybe = np.zeros(len(incoming), bool)
    for f in filters.itertuples():
        maybe |= BinaryFuse(f.seed, f.segment, f.segments, np.frombuffer(f.table, np.uint8)).contains(incoming["key"].to_numpy(np.int64))
    return incoming[["key"]].assign(maybe=maybe)


def build_filters(snapshot: DataFrame, ranges: int) -> DataFrame:
    """snapshot (key, ...) -> (range, seed, segment, segments, table)"""
    keys = snapshot.select("key").distinct().withColumn("range", F.pmod(F.xxhash64("key"), F.lit(ranges)).cast("int"))
    return keys.groupBy("range").applyInPandas(_build, "range int, seed int, segment int, segments int, table binary")


def screen(incoming: DataFrame, filters: DataFrame, ranges: int) -> DataFrame:
    """(key, maybe) of the distinct incoming keys; those that aren't ``maybe`` are surely not in the snapshot."""
    keys = incoming.select("key").distinct().withColumn("range", F.pmod(F.xxhash64("key"), F.lit(ranges)).cast("int"))
    return keys.groupBy("range").cogroup(filters.groupBy("range")).applyInPandas(_screen, "key long, maybe boolean")


def combine(snapshot: DataFrame, incoming: DataFrame, old_docs: DataFrame, new_docs: DataFrame) -> DataFrame:
    """groups() of a snapshot and of a new batch, and their documents -> (digest, length, least, n) of all groups."""
    ranges = max(1, -(-max(snapshot.count(), incoming.count()) // FILTER_KEYS))
    filters = written(build_filters(snapshot, ranges))
    screened = written(incoming.join(screen(incoming, filters, ranges), "key"))
    maybe = screened.filter("maybe")
    # exact buckets: the texts of the keys that passed, on both sides
    passed = maybe.select("key").distinct()
    passed = F.broadcast(passed) if passed.count() <= BROADCAST_KEYS else passed
    new, old = written(texts_of(new_docs, passed)), written(texts_of(old_docs, passed).withColumnsRenamed({"digest": "d", "flat": "f"}))
    met = new.join(old, "key").filter((F.col("digest") == F.col("d")) | (F.col("flat") == F.col("f")))
    sound = F.when(F.col("flat") == F.col("f"), F.lit(True)).otherwise(F.raise_error(F.lit("different texts share a digest")))
    same = written(met.filter(sound).select("digest").distinct())
    once = screened.join(same, "digest", "left_anti").select("digest", "length", "least", "n")
    alone = snapshot.join(same, "digest", "left_anti").select("digest", "length", "least", "n")
    both = maybe.select("digest", "length", "least", "n").unionByName(snapshot.select("digest", "length", "least", "n")).join(same, "digest", "left_semi")
    both = both.groupBy("digest", "length").agg(F.min("least").alias("least"), F.sum("n").alias("n"))
    return once.unionByName(alone).unionByName(both)


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    docs = docs.select("doc_id", "text")
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    rows = written(digests(docs).withColumn("number", F.monotonically_increasing_id()))
    found = written(combine(written(groups(rows.filter(~batch))), written(groups(rows.filter(batch))), docs.filter(~batch), docs.filter(batch)))
    found = found.withColumnsRenamed({"digest": "d", "length": "l"})
    return rows.join(found, (F.col("digest") == F.col("d")) & (F.col("length") == F.col("l"))).select(
        "doc_id", F.col("least.doc_id").alias("keep_id"), F.col("n").cast("long").alias("group_size"), (F.col("number") == F.col("least.number")).alias("kept"), F.col("digest").alias("text_sha256")
    )
