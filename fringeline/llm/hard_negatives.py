"""Hard negatives: for an anchor and each of its best rows of the same label, the best rows of other labels that score nearly as high.

Vectors are whole numbers, floor(256 x) of each component; a score is their inner product, exact. Beside each vector stand the mean and
the deviation of its segments, 4 and then 16 of them, as sqrt(n) mean and sqrt(n) deviation of a segment of n components: the products
of the means plus or minus those of the deviations bound the inner product (Cauchy-Schwarz on what is left when the means are taken away).

All rows are cut into blocks, the anchors too, and each pair of blocks is one task's work: anchors are the query set. A task goes through
tiles of ANCHOR_TILE x ROW_TILE pairs. In a tile the coarse bounds rule out pairs that can't reach the anchor's worst kept score, rows and anchors
without any pair left are dropped, the finer bounds do the same with the rest, and what is left is scored exactly: pair by pair where few are
left, as one product of matrices otherwise. (Vectors without structure leave nearly all pairs: bounds then cost a part and save nothing.)
Each task hands on its best few of each anchor, and those meet by anchor.

1. Positives: the first ``positives`` + 1 rows of the anchor's label, so that it can be taken out itself.
2. Negatives: with the positives' scores known, the first ``negatives`` rows of other labels in each one's range [floor percent, 100 percent].

Copies: of rows equal in label and vector only those with the ``positives`` + 1 smallest ids can be in any result, so the others are dropped
before they meet; anchors equal in label and vector are one search, and the result is given to each.

Rows with a null id, a null label, a null vector, or a component that is null or not finite take no part, nor do those with a component whose size is 2**20
or more, whose scores may not fit a long (dimensions up to 2**7 or so). Shorter vectors are continued with zeros. Rows equal in id, label and vector count
once; an anchor's own row is every row with its id. A label without further rows, or a range without rows, gives no row; a positive below zero
has an empty range. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fringeline.llm.common import kept, scratch, written

LEVELS = (4, 16)
LARGEST = 1 << 28
ROW_BLOCK = 16_384
ANCHOR_BLOCK = 16_384
ANCHOR_TILE = 256
ROW_TILE = 4_096
#: Share of a tile's pairs from which they are scored as a whole.
DENSE = 0.1
#: Bounds are kept in single precision; they are widened by this share of the largest product of norms.
SLACK = 1e-5


def summaries(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(n) mean and sqrt(n) deviation of each segment, for rows of ``x``."""
    parts = x.reshape(len(x), segments, -1).astype(np.float64)
    n = parts.shape[2] ** 0.5
    return (parts.mean(axis=2) * n).astype(np.float32), (parts.std(axis=2) * n).astype(np.float32)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, label, v): whole numbers of the rows that take part, as int32 bytes."""
    for batch in batches:
        out = []
        for vec_id, label, xs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            values = xs.values
            if values.null_count:
                continue
            x = values.to_numpy(zero_copy_only=False).astype(np.float64) * 256
            if not np.isfinite(x).all() or (len(x) and np.abs(x).max() >= LARGEST):
                continue
            out.append((vec_id, label, np.floor(x).astype("<i4").tobytes().rstrip(b"\0")))
        ids, labels, vectors = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(vectors, pa.binary())], ["vec_id", "label", "v"])


def _stack(v: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(x).ljust(4 * width, b"\0") for x in v), "<i4").reshape(len(v), width)


def _summarised(width: int):
    def summarised(v: pd.Series) -> pd.Series:
        x = _stack(v, width)
        parts = np.concatenate([f for s in LEVELS for f in summaries(x, s)], axis=1) if len(x) else np.zeros((0, 0), np.float32)
        return pd.Series([p.tobytes() for p in parts], dtype=object)

    return F.pandas_udf(summarised, "binary")


class _Block:
    """Rows with their summaries, read from a task's table."""

    def __init__(self, p: pd.DataFrame, width: int):
        self.x = _stack(p["v"], width)
        self.label = p["label"].to_numpy(np.int64)
        flat = np.frombuffer(b"".join(map(bytes, p["s"])), np.float32).reshape(len(p), 2 * sum(LEVELS)) if len(p) else np.zeros((0, 2 * sum(LEVELS)), np.float32)
        ends = np.cumsum(np.repeat(LEVELS, 2))[:-1]
        parts = np.split(flat, ends, axis=1)
        self.levels = list(zip(parts[::2], parts[1::2]))
        self.norm = np.sqrt((self.x.astype(np.float64) ** 2).sum(axis=1))
        # sums below 2**53 are exact in double precision
        self.largest = float(np.abs(self.x).max(initial=0))


def _scored(anchors: _Block, rows: _Block, a: slice, r: slice, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the wanted pairs of a tile that may score low..high of their anchor."""
    at, to = np.arange(a.start, a.stop), np.arange(r.start, r.stop)
    slack = SLACK * float(anchors.norm[a].max() * rows.norm[r].max()) + 1
    floor, ceiling = low - slack, high + slack
    for (mean, dev), (mean2, dev2) in zip(anchors.levels, rows.levels):
        middle, spread = mean[at] @ mean2[to].T, dev[at] @ dev2[to].T
        wanted = wanted & (middle + spread >= floor[at - a.start, None]) & (middle - spread <= ceiling[at - a.start, None])
        some, every = wanted.any(axis=1), wanted.any(axis=0)
        at, to, wanted = at[some], to[every], wanted[some][:, every]
        if not len(at):
            break
    if not wanted.any():
        return (np.zeros(0, np.int64),) * 3
    if wanted.mean() < DENSE:
        i, j = np.nonzero(wanted)
        score = np.einsum("ij,ij->i", anchors.x[at[i]].astype(np.int64), rows.x[to[j]].astype(np.int64))
    else:
        kind = np.float64 if anchors.largest * rows.largest * anchors.x.shape[1] < 1 << 53 else np.int64
        whole = anchors.x[at].astype(kind) @ rows.x[to].astype(kind).T
        i, j = np.nonzero(wanted & (whole >= low[at - a.start, None]) & (whole <= high[at - a.start, None]))
        score = whole[i, j].astype(np.int64)
    return at[i], to[j], score


def _best(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, many: int) -> np.ndarray:
    """Places of the first ``many`` of each anchor, in order."""
    order = np.lexsort((ids, -score, anchor))
    own = anchor[order]
    first = np.flatnonzero(np.diff(own, prepend=own[0] - 1)) if len(own) else np.zeros(0, np.int64)
    rank = np.arange(len(own)) - np.repeat(first, np.diff(np.append(first, len(own))))
    return order[rank < many]


class _Kept:
    """The best of each anchor so far, and the worst score that still can enter."""

    def __init__(self, size: int, many: int, low: np.ndarray):
        self.many, self.low = many, low.astype(np.float64)
        self.anchor, self.score, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(anchor):
            return
        anchor, score, ids = np.append(self.anchor, anchor), np.append(self.score, score), np.append(self.ids, ids)
        best = _best(anchor, score, ids, self.many)
        self.anchor, self.score, self.ids = anchor[best], score[best], ids[best]
        full = np.flatnonzero(np.bincount(self.anchor, minlength=len(self.low)) == self.many)
        ends = np.searchsorted(self.anchor, full, "right") - 1
        self.low[full] = self.score[ends]


def _tiles(n: int, size: int) -> list[slice]:
    return [slice(i, min(n, i + size)) for i in range(0, n, size)]


def _positives(width: int, many: int):
    def found(_, a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        anchors, rows, ids = _Block(a, width), _Block(r, width), r["vec_id"].to_numpy(np.int64)
        best = _Kept(len(a), many, np.full(len(a), -np.inf))
        for s in _tiles(len(a), ANCHOR_TILE):
            for t in _tiles(len(r), ROW_TILE):
                same = anchors.label[s, None] == rows.label[None, t]
                i, j, score = _scored(anchors, rows, s, t, same, best.low[s], np.full(s.stop - s.start, np.inf))
                best.add(i, score, ids[j])
        return pd.DataFrame({"search": a["search"].to_numpy()[best.anchor], "vec_id": best.ids, "score": best.score})

    return found


def _negatives(width: int, many: int, percent: int):
    def found(_, a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        anchors, rows, ids = _Block(a, width), _Block(r, width), r["vec_id"].to_numpy(np.int64)
        # the distinct scores of each anchor's positives; where it has fewer, a range that holds nothing
        scores = [sorted({s for s in x if s >= 0}, reverse=True) for x in a["scores"]]
        deep = max(map(len, scores), default=0)
        out = []
        high = np.array([[s[k] if k < len(s) else -1 for k in range(deep)] for s in scores], np.float64).reshape(len(a), deep)
        low = np.array([[-(-percent * s[k] // 100) if k < len(s) else np.inf for k in range(deep)] for s in scores], np.float64).reshape(len(a), deep)
        best = [_Kept(len(a), many, low[:, k]) for k in range(deep)]
        for s in _tiles(len(a), ANCHOR_TILE) if deep else ():
            for t in _tiles(len(r), ROW_TILE):
                other = anchors.label[s, None] != rows.label[None, t]
                i, j, score = _scored(anchors, rows, s, t, other, np.min([b.low[s] for b in best], axis=0), high[s].max(axis=1))
                for k, b in enumerate(best):
                    fits = (score <= high[i, k]) & (score >= b.low[i])
                    b.add(i[fits], score[fits], ids[j[fits]])
        for k, b in enumerate(best):
            out.append(pd.DataFrame({"search": a["search"].to_numpy()[b.anchor], "positive_score": high[b.anchor, k].astype(np.int64), "vec_id": b.ids, "score": b.score}))
        return pd.concat(out) if out else pd.DataFrame({"search": [], "positive_score": [], "vec_id": [], "score": []})

    return found


def _first(df: DataFrame, by: list[str], many: int, name: str) -> DataFrame:
    """The best ``many`` of each group as an array of (vec_id, score) in order."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    best = df.withColumn("rank", rank).filter(F.col("rank") <= many)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))), lambda s: F.struct(s["vec_id"].alias("vec_id"), s["score"].alias("score")))
    return best.groupBy(*by).agg(listed.alias(name))


def mine(vectors: DataFrame, anchors_of: int = 100, positives: int = 5, negatives: int = 5, percent: int = 80, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """vectors (vec_id, embedding, label) -> (anchor_id, positive_id, rank, negative_id, positive_score, negative_score). Anchors are the rows whose id is
    divisible by ``anchors_of``. Written."""
    with scratch(vectors.sparkSession):
        sound = vectors.filter("vec_id is not null and label is not null and embedding is not null").select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
        rows = sound.mapInArrow(_vectors, "vec_id long, label long, v binary")
        told = Window.partitionBy("label", "v").orderBy("vec_id")
        asked = written(rows.filter(F.col("vec_id") % anchors_of == 0).distinct())
        # of copies only the first can be in a result
        rows = written(rows.distinct().withColumn("copy", F.row_number().over(told)).filter(F.col("copy") <= max(positives + 1, negatives)).drop("copy"))
        longest, many = rows.agg(F.coalesce(F.max(F.octet_length("v")), F.lit(0)), F.count("*")).first()
        width = max(LEVELS) * max(1, -(-longest // 4 // max(LEVELS)))
        rows = written(rows.withColumn("s", _summarised(width)("v")))
        searches = written(asked.select("label", "v").distinct().withColumn("s", _summarised(width)("v")).withColumn("search", F.monotonically_increasing_id()))
        named = written(asked.join(searches.select("label", "v", "search").hint("merge"), ["label", "v"]).select(F.col("vec_id").alias("anchor_id"), "search"))
        row_blocks, anchor_blocks = -(-max(1, many) // row_block), -(-max(1, searches.count()) // anchor_block)
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        dealt = rows.withColumn("rb", F.pmod(F.xxhash64("vec_id", "v"), F.lit(row_blocks)).cast("int")).withColumn("ab", every(anchor_blocks))

        def against(queries: DataFrame, how, schema: str) -> DataFrame:
            q = queries.withColumn("ab", F.pmod(F.xxhash64("search"), F.lit(anchor_blocks)).cast("int")).withColumn("rb", every(row_blocks))
            return q.groupBy("ab", "rb").cogroup(dealt.groupBy("ab", "rb")).applyInPandas(how, schema)

        near = against(searches, _positives(width, positives + 1), "search long, vec_id long, score long")
        near = written(_first(near, ["search"], positives + 1, "positives"))
        scored = searches.join(near.select("search", F.transform("positives", lambda p: p["score"]).alias("scores")), "search")
        hard = against(scored, _negatives(width, negatives, percent), "search long, positive_score long, vec_id long, score long")
        hard = written(_first(hard, ["search", "positive_score"], negatives, "negatives"))
        lists = near.select("search", F.posexplode("positives").alias("at", "p")).select("search", "at", F.col("p.vec_id").alias("positive_id"), F.col("p.score").alias("positive_score"))
        lists = lists.join(hard, ["search", "positive_score"], "left").groupBy("search").agg(F.array_sort(F.collect_list(F.struct("at", "positive_id", "positive_score", "negatives"))).alias("all"))
        lists = written(lists)
        own = named.join(lists.hint("merge"), "search").select("anchor_id", F.explode(F.slice(F.filter("all", lambda p: p["positive_id"] != F.col("anchor_id")), 1, positives)).alias("p"))
        out = own.select("anchor_id", "p.positive_id", "p.positive_score", F.posexplode("p.negatives").alias("rank", "n"))
        return kept(out.select("anchor_id", "positive_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("n.vec_id").alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score")))
