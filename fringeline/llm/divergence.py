"""Source divergence audit: how far the sources of a language lie from one another and from the language as a whole.

Terms are runs of ASCII letters (lower-cased) and of characters beyond ASCII. A language keeps the terms that ``MIN_DOCS`` of its documents
have. A group is a (language, source); its smoothed share of a term is the integer p = 1 + floor(SCALE (count + PRIOR) / (N + PRIOR V)).

1. Counts come from one pass with sums in the task; one shuffle by (language, term) gives counts and documents.
2. Term ids are dealt to blocks by hash, so that a block has ``CELLS`` counts of all its groups or about that many; a language with a third
   of all terms is so many more blocks.
3. A block orders its terms by count and builds a segment tree over them for each group, bottom up: nodes with equal children are one
   node (hash-consing), across all groups. Two groups' trees are then traversed at once, level by level: equal pairs of nodes meet in one
   pair with a multiplicity, and each pair of leaves is priced once, |p - q|. Sums are exact integers.
4. Blocks' sums are added by pair of groups. The same traversal of a group's tree with that of its language prices the terms the group has
   above the language's share; a block's ``top`` terms go on.

Null text, lang and source are ''. Groups without any term take part. A language that keeps no term has pairs of value 0 and no terms. Rows count
as they come, repeated or not. An empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fringeline.llm.common import kept, scratch, written

MIN_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
PRIOR = 5
#: Counts of a block's terms and groups.
CELLS = 1 << 16
#: Terms a task holds before it hands its counts on.
KEPT_TERMS = 400_000
_TERM_TABLE = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_TERM_TABLE).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    found: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in found.items():
            k = len(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * k), pa.array([source] * k), pa.array(n.keys(), pa.binary()).cast(pa.string()), pa.array(n.values(), pa.int64()), pa.array(map(docs.__getitem__, n), pa.int64())], names)
        found.clear()

    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist()):
            words = terms_of(text)
            if words:
                n, docs = found.setdefault((lang, source), (Counter(), Counter()))
                n.update(words)
                docs.update(set(words))
        if sum(len(n) for n, _ in found.values()) > KEPT_TERMS:
            yield from flush()
    yield from flush()


def group_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, source, n) of kept terms, for the sources that have them."""
    counted = docs.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    sums = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    total = F.sum("docs").over(Window.partitionBy("lang", "term"))
    return sums.withColumn("docs", total).filter(F.col("docs") >= min_docs).select("lang", "term", "source", "n")


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """p of every count in a group of ``total`` words and a language of ``terms`` terms; -1, which stands for no term, has 0."""
    if total * SCALE < 1 << 62:
        p = 1 + SCALE * (counts + PRIOR) // (total + PRIOR * terms)
    else:
        p = np.array([1 + SCALE * (int(c) + PRIOR) // (total + PRIOR * terms) for c in counts], np.int64)
    return np.where(counts < 0, 0, p)


class Trees:
    """Segment trees over the same terms, one for each row of ``counts``; equal subtrees of any rows are one node."""

    def __init__(self, counts: np.ndarray):
        rows, width = counts.shape
        size = 1 << max(0, width - 1).bit_length()
        full = np.full((rows, size), -1, np.int64)
        full[:, :width] = counts
        self.leaves, ids = np.unique(full, return_inverse=True)
        ids = ids.reshape(rows, size)
        self.leaf_ids = ids[:, :width]
        #: for every level from the leaves up, the two children of each node
        self.children: list[np.ndarray] = []
        while ids.shape[1] > 1:
            pairs = ids[:, ::2] * (ids.max() + 1) + ids[:, 1::2]
            nodes, at = np.unique(pairs, return_inverse=True)
            self.children.append(np.stack(np.divmod(nodes, ids.max() + 1), axis=1))
            ids = at.reshape(rows, -1)
        self.roots = ids[:, 0]

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Simultaneous traversal of the trees of rows ``left`` and ``right``: (place in left, leaf, leaf, multiplicity), each once."""
        which, a, b, many = np.arange(len(left)), self.roots[left], self.roots[right], np.ones(len(left), np.int64)
        for children in reversed(self.children):
            base = int(children.max()) + 1
            key = np.concatenate([(which * base + children[a, side]) * base + children[b, side] for side in (0, 1)])
            key, at = np.unique(key, return_inverse=True)
            sums = np.zeros(len(key), np.int64)
            np.add.at(sums, at, np.concatenate((many, many)))
            many = sums
            key, b = np.divmod(key, base)
            which, a = np.divmod(key, base)
        return which, a, b, many


def _priced(top: int):
    def priced(key: tuple, cells: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        groups = groups.sort_values("source")
        sources, totals = groups["source"].to_numpy(object), [int(n) for n in groups["total"]]
        terms, vocabulary = cells["term"].to_numpy(object), int(groups["terms"].iloc[0])
        names, at = np.unique(terms, return_inverse=True)
        lang = np.bincount(at, cells["n"].to_numpy(float), len(names))  # only to order by
        order = np.argsort(-lang, kind="stable")
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        names = names[order]
        counts = np.zeros((len(sources) + 1, len(names)), np.int64)
        row = {s: i for i, s in enumerate(sources)}
        counts[[row[s] for s in cells["source"]], place[at]] = cells["n"].to_numpy(np.int64)
        counts[-1] = counts[:-1].sum(axis=0)
        trees = Trees(counts)
        totals = [*totals, sum(totals)]
        p = np.stack([shares(trees.leaves, n, vocabulary) for n in totals])
        out = []
        left, right = (x.astype(np.int64) for x in np.triu_indices(len(sources), 1))
        step = max(1, (1 << 20) // len(names))
        for i in range(0, len(left), step):
            one, two = left[i : i + step], right[i : i + step]
            which, a, b, many = trees.pairs(one, two)
            value = np.zeros(len(one), np.int64)
            np.add.at(value, which, np.abs(p[one[which], a] - p[two[which], b]) * many)
            out.append(pd.DataFrame({"source": sources[one], "part": "pair", "item": sources[two], "value": value}))
        whole = len(sources)
        for i in range(0, whole, step):
            own = np.arange(i, min(whole, i + step))
            which, a, b, _ = trees.pairs(own, np.full(len(own), whole))
            above = np.where(trees.leaves[a] > 0, p[own[which], a] - p[whole, b], 0)
            base = len(trees.leaves)
            known = (which * base + a) * base + b
            for k, g in enumerate(own.tolist()):
                value = above[np.searchsorted(known, (k * base + trees.leaf_ids[g]) * base + trees.leaf_ids[whole])]
                good = np.flatnonzero(value > 0)
                if len(good) > top:
                    good = good[value[good] >= np.partition(value[good], len(good) - top)[len(good) - top]]
                good = sorted(good.tolist(), key=lambda j: (-value[j], names[j].encode()))[:top]
                out.append(pd.DataFrame({"source": sources[g], "part": "term", "item": names[good], "value": value[good]}))
        found = pd.concat(out)
        return found.assign(lang=key[0])[["lang", "source", "part", "item", "value"]]

    return priced


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, cells: int = CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group: ``pair`` has every other source of the language with the sum of |p - q| over all kept
    terms; ``term`` the ``top`` terms by p - q over the language's share q. Written."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    with scratch(docs.sparkSession):
        counts = written(group_counts(rows, min_docs))
        totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        terms = counts.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("terms"))
        groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left")
        groups = written(groups.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms")))
        size = groups.groupBy("lang").agg((F.count("*") + 1).alias("many"), F.max("terms").alias("terms"))
        size = written(size.select("lang", F.ceil(F.col("terms") * F.col("many") / F.lit(cells)).cast("int").alias("blocks")).filter("blocks > 0"))
        dealt = counts.join(size, "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "term", "source", "n")
        every = groups.join(size, "lang").select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", "total", "terms")
        # a block that got no term has nothing to add
        every = every.join(dealt.select("lang", "block").distinct(), ["lang", "block"], "left_semi")
        parts = dealt.groupBy("lang", "block").cogroup(every.groupBy("lang", "block")).applyInPandas(_priced(top), "lang string, source string, part string, item string, value long")
        parts = written(parts)
        sums = parts.filter("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        bare = groups.filter("terms = 0").select("lang", "source")
        none = bare.join(bare.withColumnRenamed("source", "item"), "lang").filter("source < item").withColumn("value", F.lit(0).cast("long"))
        pairs = sums.unionByName(none)
        pairs = pairs.unionByName(pairs.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
        ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank"))
        best = ranked(parts.filter("part = 'term'"), "term").filter(F.col("rank") <= top)
        return kept(ranked(pairs, "pair").unionByName(best))
