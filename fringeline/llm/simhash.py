"""SimHash near-duplicate detection by deletion-variant signatures.

A 64-bit fingerprint is cut into three segments. Two fingerprints at four or fewer differing bits then
agree in one segment up to a single bit, so they share one of that segment's one-wildcard variants (the
segment with one bit masked out). Every distinct fingerprint is indexed under its 64 variants, equal
variants meet in one bucket, and the whole fingerprints are verified there.

* Copies never meet each other: rows are grouped by fingerprint first, and only distinct fingerprints
  (8 bytes each) are indexed.
* Buckets don't emit all pairs. A small bucket emits its verified links, each from one bucket only; a
  larger one is searched with removal and emits one edge per member to the smallest of its component.
* A bucket above ``BUCKET_ROWS`` fingerprints is cut into tiles of salted chunks, so that no task holds more
  than two chunks, and all pairs of chunks are still compared.
* Links are joined to components by alternating large and small stars; every round is written to the shared folder.

The pipeline's stage (``keep_one``) has a wider rule, a Jaccard similarity of 0.8 of five-word shingles, which lies about ten bits
apart. It takes the same steps on fingerprints of these shingles, with up to ``STAGE_BITS`` bits in a bucket, and every link is then verified
on the two sets of shingles. What shares no variant, as pairs near 0.8 often don't, is brought together by bands of MinHash values besides.

Null texts count as empty. A text without words has fingerprint 0, linked like any other. Rows with the
same ``doc_id`` each get a result row; a null ``doc_id`` takes part in links and never names a component
that has another id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fringeline.llm.common import give_back, kept, scratch, written

SHINGLE_WORDS = 4
HASH_SEED = 42
MAX_BITS = 4
#: (first bit, bits) of the segments; MAX_BITS // 3 = 1 bit differs in one of them at most.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: A bucket of more distinct fingerprints is cut into tiles.
BUCKET_ROWS = 100_000
#: Buckets up to this size compare neighbours at every distance, all buckets of a batch at once.
SMALL_BUCKET = 48
_CHUNK = 1 << 16

#: The pipeline's stage has a rule of its own: near copies share SIMILARITY of their sets of STAGE_WORDS-word shingles.
STAGE_WORDS = 5
SIMILARITY = 0.8
#: Fingerprints of a bucket up to this distance are compared by their sets; of strangers that share a variant, once in 27,000 pairs.
STAGE_BITS = 8
#: Minima of BANDS * BAND_ROWS hash functions; at a similarity of 0.8 a pair shares no band's key once in 2,800 times.
BANDS, BAND_ROWS = 20, 5
#: Sets that are compared in one task, in number and in shingles; more are cut into chunks, all pairs of which are compared.
TILE_ROWS = 2_000
TILE_SHINGLES = 2_000_000
#: Rows of two numbers up to which they are broadcast: 64 MB at the 128 bytes that one takes in memory.
BROADCAST_ROWS = 500_000
_FACTORS, _OFFSETS = np.random.default_rng(HASH_SEED).integers(0, 1 << 64, (2, BANDS * BAND_ROWS), np.uint64)
_FACTORS |= np.uint64(1)

_SEGMENT_OF = [next(i for i, (a, n) in enumerate(SEGMENTS) if a <= b < a + n) for b in range(64)]
_SEGMENT_MASK = [((1 << n) - 1) << a for a, n in SEGMENTS]
_MASKS = [_SEGMENT_MASK[_SEGMENT_OF[b]] & ~(1 << b) for b in range(64)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: bytes) -> int:
    """SimHash of one UTF-8 text; long texts are hashed in chunks of shingles."""
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(0, len(words) - SHINGLE_WORDS)
    starts, ends = starts[: last + 1].tolist(), ends[min(SHINGLE_WORDS, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return _majority((np.array([digest(flat[a:b], HASH_SEED) for a, b in zip(starts[i : i + _CHUNK], ends[i : i + _CHUNK])], dtype="<u8") for i in range(0, len(starts), _CHUNK)), len(starts))


def _majority(hashes: Iterable[np.ndarray], n: int) -> int:
    """The bits that are set in over half of ``n`` hashes."""
    counts = np.zeros(64, np.int64)
    for h in hashes:
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


@F.pandas_udf(T.LongType())
def fingerprint_udf(text: pd.Series) -> pd.Series:
    return pd.Series([_signed(fingerprint((t or "").encode())) for t in text], dtype="int64")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _first_shared(x: np.ndarray) -> np.ndarray:
    """The lowest wildcard under which two fingerprints with xor ``x`` share a bucket, 64 if none."""
    out = np.full(len(x), 64, np.int64)
    for (a, _), mask in reversed(list(zip(SEGMENTS, _SEGMENT_MASK))):
        part = x & np.uint64(mask)
        n = np.bitwise_count(part)
        out[n == 0] = a
        one = n == 1
        out[one] = np.log2(part[one].astype(np.float64)).astype(np.int64)
    return out


def _small_links(w: np.ndarray, fp: np.ndarray, run: np.ndarray, bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``run``, each only in the first bucket that its two ends share."""
    left, right = [], []
    for d in range(1, SMALL_BUCKET):
        if d >= len(run):
            break
        same = np.flatnonzero(run[d:] == run[:-d])
        if not len(same):
            break
        x = fp[same] ^ fp[same + d]
        near = np.bitwise_count(x) <= bits
        same, x = same[near], x[near]
        own = _first_shared(x) == w[same]
        left.append(fp[same[own]])
        right.append(fp[same[own] + d])
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _search(fp: np.ndarray, bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Components of one bucket: an edge from every linked member to the smallest of its component.

    What has been reached leaves the set that is compared, so dense groups cost about one pass.
    """
    rest, left, right = np.unique(fp), [], []
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        queue = [root]
        while queue and len(rest):
            near = np.bitwise_count(rest ^ queue.pop()) <= bits
            if near.any():
                found, rest = rest[near], rest[~near]
                left.append(found)
                right.append(np.full(len(found), root, np.uint64))
                queue.extend(found)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _bucket_links(batches: Iterator[pa.RecordBatch], bits: int = MAX_BITS) -> Iterator[pa.RecordBatch]:
    """Rows (w, key, tile, fp) sorted by bucket; only the bucket at a batch's end is held over."""
    held: list[tuple[np.ndarray, ...]] = []

    def links(w, key, tile, fp):
        if len(w) < 2:
            return
        start = np.flatnonzero(np.concatenate(([True], (w[1:] != w[:-1]) | (key[1:] != key[:-1]) | (tile[1:] != tile[:-1]))))
        length = np.diff(np.concatenate((start, [len(w)])))
        run = np.repeat(np.arange(len(start)), length)
        small = np.repeat((length > 1) & (length <= SMALL_BUCKET), length)
        found = [_small_links(w[small], fp[small], run[small], bits)]
        found += [_search(fp[a : a + n], bits) for a, n in zip(start[length > SMALL_BUCKET], length[length > SMALL_BUCKET])]
        a, b = (np.concatenate(x) for x in zip(*found))
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b).view(np.int64)), pa.array(np.minimum(a, b).view(np.int64))], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)))
        w, key, tile, _ = held[-1]
        own = (w != w[-1]) | (key != key[-1]) | (tile != tile[-1])
        if own.any():  # a bucket has ended
            cut = int(np.flatnonzero(own)[-1]) + 1
            done = [tuple(c[:cut] for c in held[-1])]
            before = [tuple(c) for c in held[:-1]]
            rest = tuple(c[cut:] for c in held[-1])
            w, key, tile, fp = (np.concatenate(c) for c in zip(*before, *done))
            yield from links(w, key, tile, fp.view(np.uint64))
            held = [rest]
    if held:
        w, key, tile, fp = (np.concatenate(c) for c in zip(*held))
        yield from links(w, key, tile, fp.view(np.uint64))


def _tiles(heavy: DataFrame, bucket_rows: int) -> DataFrame:
    """Buckets (w, key) above ``bucket_rows`` fingerprints with their number of chunks."""
    bit = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("bits") - 1)).alias("w")
    return (
        heavy.select(bit, "value", "n")
        .select("w", F.col("value").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("w")))).alias("key"), "n")
        .groupBy("w", "key")
        .agg(F.ceil(F.sum("n") / bucket_rows).cast("int").alias("chunks"))
    )


def links(fingerprints: DataFrame, bucket_rows: int = BUCKET_ROWS, bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect all those within MAX_BITS, and of those within ``bits``, if more, all that share a variant."""
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in _MASKS])
    variants = fingerprints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("w")).select(
        F.col("w").cast("short").alias("w"), F.col("fp").bitwiseAND(F.get(masks, F.col("w"))).alias("key"), "fp"
    )
    # A bucket is two values of a segment, so counts by value (three rows for each fingerprint) find all large ones.
    values = fingerprints.select(
        F.inline(F.array(*[F.struct(F.lit(a).alias("first"), F.lit(n).alias("bits"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("value")) for (a, n), m in zip(SEGMENTS, _SEGMENT_MASK)]))
    )
    heavy = written(values.groupBy("first", "bits", "value").agg(F.count("*").alias("n")).filter(F.col("n") * 2 > bucket_rows))
    if heavy.limit(1).count():
        c, j, n = F.col("c"), F.col("j"), F.col("chunks")
        variants = (
            variants.join(_tiles(heavy, bucket_rows).withColumn("w", F.col("w").cast("short")), ["w", "key"], "left")
            .withColumn("chunks", F.coalesce(n, F.lit(1)))
            .withColumn("c", F.pmod(F.xxhash64("fp"), n).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), n - 1)))
            .select("w", "key", (F.least(c, j) * n + F.greatest(c, j)).cast("int").alias("tile"), "fp")
        )
    else:
        variants = variants.select("w", "key", F.lit(0).alias("tile"), "fp")
    found = variants.repartition("w", "key", "tile").sortWithinPartitions("w", "key", "tile")
    return found.mapInArrow(lambda batches: _bucket_links(batches, bits), "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: (node, root) with the smallest node as root, for nodes that have an edge.

    Alternating large and small stars; hubs are reduced before they are shuffled, and their minima are written before
    they are joined back, so that both sides of the join are plain exchanges, which adaptive execution can split.
    """
    edges = written(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("b", "a"))
        low = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        large = written(large)
        low = written(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = written(small.filter("a != b").distinct())
        # wide sums, as these are hashes
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
    raise RuntimeError("components did not settle")


def _named(rows: DataFrame, edges: DataFrame, order: list[Column]) -> DataFrame:
    """Rows (..., fp) with links between values of fp -> with least, the smallest struct of ``order`` in the component. Written minima."""
    prints = written(rows.groupBy("fp").agg(F.min(F.struct(*order)).alias("own")))
    roots = written(components(edges).withColumnRenamed("node", "fp"))
    named = prints.join(roots, "fp", "left").select("fp", "own", F.coalesce("root", "fp").alias("root"))
    # Only fingerprints with a link (or at the root of some) need their component's smallest row looked up.
    hubs = roots.select("root").distinct()
    part = written(named.join(hubs, "root", "left_semi"))
    least = written(part.groupBy("root").agg(F.min("own").alias("least")))
    found = written(part.join(least, "root").select("fp", "least"))
    labels = written(prints.join(found, "fp", "left").select("fp", F.coalesce("least", "own").alias("least")))
    return rows.join(labels, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp, component_id) for every row: the component's smallest id, by links of MAX_BITS or fewer bits."""
    rows = written(docs.select(F.col(id_col).alias("doc_id"), fingerprint_udf(F.col(text_col)).alias("fp")))
    # ids before none
    named = _named(rows, links(rows.select("fp").distinct()), [F.col("doc_id").isNull().alias("none"), F.col("doc_id")])
    return named.select("doc_id", "fp", F.col("least.doc_id").alias("component_id"))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the STAGE_WORDS-word shingles of one UTF-8 text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: max(1, len(words) - STAGE_WORDS + 1)].tolist()
    ends, digest = ends[min(STAGE_WORDS, len(words)) - 1 :].tolist(), xxhash.xxh64_intdigest
    return np.unique(np.array([digest(flat[a:b], HASH_SEED) for a, b in zip(starts, ends)], np.uint64))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A key for each band of BAND_ROWS minima; two sets share one with probability 1 - (1 - J ** BAND_ROWS) ** BANDS."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    low = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 1024):
        np.minimum(low, (shingles[i : i + 1024, None] * _FACTORS + _OFFSETS).min(axis=0), out=low)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), i) for i, b in enumerate(low.reshape(BANDS, BAND_ROWS))], np.uint64).view(np.int64)


def set_fingerprint(shingles: np.ndarray) -> int:
    """SimHash of a set of shingles' hashes; 0 for an empty one."""
    return _majority((shingles[i : i + _CHUNK] for i in range(0, len(shingles), _CHUNK)), len(shingles))


def _set_key(s: np.ndarray) -> int:
    return _signed(xxhash.xxh64_intdigest(s.tobytes(), HASH_SEED))


@F.pandas_udf(T.StructType([T.StructField("fp", T.LongType()), T.StructField("simhash", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("n_shingles", T.LongType())]))
def banded_udf(text: pd.Series) -> pd.DataFrame:
    found = [(_set_key(s), _signed(set_fingerprint(s)), band_keys(s), len(s)) for s in map(shingle_set, ((t or "").encode() for t in text))]
    give_back()
    return pd.DataFrame(found, columns=["fp", "simhash", "bands", "n_shingles"])


@F.pandas_udf(T.StructType([T.StructField("fp", T.LongType()), T.StructField("shingles", T.BinaryType())]))
def shingled_udf(text: pd.Series) -> pd.DataFrame:
    found = [(_set_key(s), s.tobytes()) for s in map(shingle_set, ((t or "").encode() for t in text))]
    give_back()
    return pd.DataFrame(found, columns=["fp", "shingles"])


def _search_sets(fp: np.ndarray, sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """As _search, by similarity of sets: an edge from every linked member to the smallest of its component.

    Sizes of all intersections come from products of 0-1 matrices over the hashes that two sets or more hold.
    """
    order = np.argsort(fp, kind="stable")
    fp, sets = fp[order], [sets[i] for i in order]
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, col, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    own = seen[col] > 1
    col, owner = (np.cumsum(seen > 1) - 1)[col[own]], owner[own]
    by = np.argsort(col, kind="stable")
    col, owner = col[by], owner[by]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(col[-1]) + 1 if len(col) else 0, 1024):
        lo, hi = np.searchsorted(col, (start, start + 1024))
        x = np.zeros((len(sets), 1024), np.float32)
        x[owner[lo:hi], col[lo:hi] - start] = 1
        for i in range(0, len(sets), 512):
            both[i : i + 512] += x[i : i + 512] @ x.T
    rest, left, right = np.arange(len(sets)), [], []
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        queue = [root]
        while queue and len(rest):
            i = queue.pop()
            n = both[i, rest].astype(np.float64)
            near = n / (size[i] + size[rest] - n) >= SIMILARITY
            if near.any():
                found, rest = rest[near], rest[~near]
                left.extend(fp[found].tolist())
                right.extend([int(fp[root])] * len(found))
                queue.extend(found)
    return left, right


def _set_links(group: pd.DataFrame) -> pd.DataFrame:
    a, b = _search_sets(group["fp"].to_numpy(), [np.frombuffer(s, np.uint64) for s in group["shingles"]])
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


def similar_links(rows: DataFrame, sets_of: Callable[[DataFrame], DataFrame], tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (a, b) that connect the sets ``fp`` of a similarity of SIMILARITY or more, among those that share a key. Written.

    rows: (fp, simhash, bands, n_shingles). Keys are a set's fingerprint, the fingerprints that deletion variants link it to, and its bands' keys.
    sets_of: gives (fp, shingles) for a table of wanted fp. Sets that keys connect are a cluster, which is searched with removal, each set
    being read once. A cluster above ``tile_rows`` sets or TILE_SHINGLES shingles is searched key by key instead, in tiles of chunks of that
    size, all pairs of which are compared.
    """
    bands = written(rows.groupBy("fp").agg(*[F.first(c).alias(c) for c in ("simhash", "bands", "n_shingles")]))
    near = written(links(bands.select(F.col("simhash").alias("fp")).distinct(), bits=STAGE_BITS))
    linked = bands.select("fp", F.col("simhash").alias("a")).join(near, "a").select("fp", F.col("b").alias("key"))
    index = bands.select("fp", F.explode(F.concat("bands", F.array("simhash"))).alias("key")).unionByName(linked)
    sizes = written(index.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("least")).filter("n > 1"))
    shared = written(index.join(sizes, "key").select("key", "fp", "least"))
    clusters = components(shared.select(F.col("fp").alias("a"), F.col("least").alias("b")))
    clusters = written(clusters.unionByName(clusters.select(F.col("root").alias("node"), "root")).distinct().withColumnRenamed("node", "fp"))
    sets = written(sets_of(clusters.select("fp")))
    weight = (F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    many = (F.col("n") > tile_rows) | (F.col("shingles") > TILE_SHINGLES)
    placed = clusters.join(bands.select("fp", "n_shingles"), "fp")
    large = written(placed.groupBy("root").agg(*weight).filter(many).select("root"))
    if not large.limit(1).count():
        return written(clusters.join(sets, "fp").groupBy("root").applyInPandas(_set_links, "a long, b long").distinct())
    found = clusters.join(_small(large), "root", "left_anti").join(sets, "fp").groupBy("root").applyInPandas(_set_links, "a long, b long")
    dense = clusters.join(_small(large), "root", "left_semi").select("fp").join(bands.select("fp", "n_shingles"), "fp")
    dense = written(shared.select("key", "fp").join(written(dense), "fp"))
    parts = written(dense.groupBy("key").agg(*weight).select("key", F.ceil(F.greatest(F.col("n") / tile_rows, F.col("shingles") / TILE_SHINGLES)).cast("int").alias("chunks")))
    c, j, n = F.col("c"), F.col("j"), F.col("chunks")
    tiles = (
        dense.join(parts, "key")
        .withColumn("c", F.pmod(F.xxhash64("fp"), n).cast("int"))
        .withColumn("j", F.explode(F.sequence(F.lit(0), n - 1)))
        .select("key", (F.least(c, j) * n + F.greatest(c, j)).cast("int").alias("tile"), "fp")
    )
    return written(found.union(tiles.join(sets, "fp").groupBy("key", "tile").applyInPandas(_set_links, "a long, b long")).distinct())


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near copies: the one with the smallest id (rows without an id come last), then with
    the smallest hash of its text. Of repeated rows (same id and text) any one stays.

    Near copies are linked by a similarity of SIMILARITY or more of their sets of STAGE_WORDS-word shingles. Rows are told apart by
    id and text, so different texts under one id don't share their fate. Only ids and hashes of rows that go are kept; the
    tables made on the way are removed.
    """
    # a struct of all columns, so that none of the caller's names can clash
    text = F.col("row")[text_col]
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).select("row", F.col("row")[id_col].alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("print"))

    def keys(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("doc_id").alias("d"), F.col("print").alias("p"))

    def same(keys: DataFrame) -> Column:
        return packed["doc_id"].eqNullSafe(keys["d"]) & (packed["print"] == keys["p"])

    with scratch(docs.sparkSession):
        rows = written(packed.select("doc_id", "print", banded_udf(text).alias("s")).select("doc_id", "print", "s.*"))
        counts = written(rows.groupBy("fp", "doc_id", "print").agg(F.count("*").alias("n")))
        order = [F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("print")]

        def sets_of(wanted: DataFrame) -> DataFrame:
            """One row of each wanted set is read again."""
            one = written(counts.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.min(F.struct(*order)).alias("r")).select(F.col("r.doc_id").alias("d"), F.col("r.print").alias("p")))
            found = packed.join(_small(one), same(one), "left_semi").select(shingled_udf(text).alias("s")).select("s.*")
            return found.groupBy("fp").agg(F.first("shingles").alias("shingles"))

        named = written(_named(counts, similar_links(rows, sets_of), order))
        stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("print") == F.col("least.print"))
        own, repeated = kept(keys(named.filter(~stays))), kept(keys(named.filter(stays & (F.col("n") > 1))))
    left = packed.join(_small(own), same(own), "left_anti")
    if repeated.limit(1).count():
        once = left.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "print"])
        left = left.join(repeated, same(repeated), "left_anti").unionByName(once)
    return left.select("row.*")
