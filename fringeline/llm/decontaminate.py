"""Benchmark decontamination with a distributed positional inverted index.

1. ``build_index`` reads the documents once and stores the postings of every token. Documents are laid end to end in blocks of about
   ``BLOCK_BYTES`` of text, with ``GAP`` empty places between them; a row of the index is a word in a block, with its
   places in ascending order (four bytes each). A block's rows also give its documents and where they begin. The index knows nothing of
   any benchmark, and serves any.
2. The benchmark is the query set, a table like others: its words are joined with the index's counts, and each window of an
   item gets its ``ANCHORS`` rarest words. Windows of an item with the same anchors are one search.
3. The anchors' postings, and only those, are joined with the searches and meet in their block, where the lists less the anchors' positions
   are intersected from the rarest word on. What is in all of them is a candidate; anchors that stand
   within ``SLOP`` words of their places make a proximity match.
4. The other words' postings are read for blocks with candidates, and the intersection goes on through all words of the
   window: what is left is the exact phrase.

A window is WINDOW consecutive words; an item of fewer words is one window; one without words has none. Null texts have no
words. A row's hits are its own: rows are told apart by their place in the index, whatever their doc_id is.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fringeline.llm.common import ascii_words, give_back, giving_back, joined_hash, kept, scratch, written

WINDOW = 10
ANCHORS = 3
#: Words by which anchors of a proximity match may be off their places.
SLOP = 8
BLOCK_BYTES = 8_000_000
#: Places between two documents of a block; more than a window's words and SLOP together.
GAP = 64
#: Rows of a table of the benchmark up to which it is broadcast: 32 MB at the 320 bytes that one takes at most, words of 32 bytes.
BROADCAST_ROWS = 100_000
#: Words of an item whose windows are verified together.
PART_WORDS = 1_024
#: Diagonals of a block that are verified together, of which each takes four bytes a word.
PART_DIAGONALS = 4_096
#: The index row under this word has the places where a block's documents begin.
STARTS = b""


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _block(number: int, texts: list[bytes]) -> tuple[list, list[int]]:
    """((block, word, n, postings) of every word), words of every text."""
    ids: defaultdict[bytes, int] = defaultdict(count().__next__)
    tokens = [np.fromiter(map(ids.__getitem__, words), np.int32, len(words)) for words in map(ascii_words, texts)]
    lengths = np.array([len(t) for t in tokens], np.int64)
    starts = np.cumsum(lengths + GAP) - lengths - GAP
    flat = np.concatenate(tokens)
    del tokens
    at = np.arange(len(flat), dtype="<u4") + np.repeat((starts - np.cumsum(lengths) + lengths).astype("<u4"), lengths)
    at, ends = at[np.argsort(flat, kind="stable")], np.cumsum(np.bincount(flat, minlength=len(ids))).tolist()
    rows = [(number, STARTS, len(texts), starts.astype("<u4").tobytes())]
    rows += [(number, w, b - a, at[a:b].tobytes()) for w, a, b in zip(ids, [0, *ends], ends)]
    return rows, lengths.tolist()


def _indexer(block_bytes: int, kind: pa.DataType):
    names = ["block", "word", "n", "postings", "ord", "doc_id", "print", "n_words"]
    types = [pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int32(), kind, pa.int64(), pa.int64()]

    def batch_of(cols: dict) -> pa.RecordBatch:
        n = len(next(iter(cols.values())))
        return pa.RecordBatch.from_arrays([cols[c].cast(t) if c in cols else pa.nulls(n, t) for c, t in zip(names, types)], names)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = count(TaskContext.get().partitionId() << 32)
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
            cuts = np.flatnonzero(np.diff(sizes // block_bytes, prepend=0)).tolist()
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a < b:
                    part, number = batch.slice(a, b - a), next(numbers)
                    rows, lengths = _block(number, part.column("text").cast(pa.binary()).to_pylist())
                    yield batch_of({c: pa.array(v) for c, v in zip(names, zip(*rows))})
                    ones = pa.array(np.full(b - a, number))
                    yield batch_of({"block": ones, "ord": pa.array(range(b - a)), "doc_id": part.column("doc_id"), "print": part.column("print"), "n_words": pa.array(lengths)})

    return indexed


def build_index(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The postings (block, word, n, postings) and the documents (block, ord, doc_id, print, n_words), in one table. Written."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("print"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = f"block long, word binary, n int, postings binary, ord int, doc_id {kind.simpleString()}, print long, n_words long"
    from pyspark.sql.pandas.types import to_arrow_type

    return written(rows.mapInArrow(giving_back(_indexer(block_bytes, to_arrow_type(kind))), schema))


def documents_of(index: DataFrame) -> DataFrame:
    return index.filter("word is null").select("block", "ord", "doc_id", "print", "n_words")


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [ascii_words(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("item"), pa.array(words, pa.list_(pa.binary()))], ["item_id", "item", "words"])


def _searches(window: int):
    """Distinct sets of anchors of each item, with the windows that have them. Of windows with the same words only the first is searched: the
    others are found in the same places of documents, and hit the same words there."""

    def searched(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for item_id, item, words, counts in part.itertuples(index=False):
                length = min(window, len(words))
                found: dict[tuple, list[int]] = defaultdict(list)
                seen: set[tuple] = set()
                for s in range(len(words) - length + 1):
                    said = tuple(words[s : s + length])
                    # a word that no document has rules its windows out
                    if min(counts[s : s + length]) > 0 and said not in seen:
                        seen.add(said)
                        found[tuple(sorted(range(s, s + length), key=lambda i: (counts[i], i))[:ANCHORS])].append(s)
                out += [(item_id, item, list(at), [words[a] for a in at], starts, length) for at, starts in found.items()]
            yield pd.DataFrame(out, columns=["item_id", "item", "anchors", "anchor_words", "starts", "length"])

    return searched


def searches(benchmark: DataFrame, index: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Items (item_id, item, words), and searches (search, item_id, item, anchors, anchor_words, starts, length). Written."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), text.alias("text")).distinct()
    items = named.select("item_id", F.xxhash64("item_id", "text").alias("item"), "text")
    items = written(items.mapInArrow(_item_words, "item_id string, item long, words array<binary>").filter(F.size("words") > 0))
    places = items.select("item_id", "item", F.posexplode("words").alias("pos", "word"))
    wanted = written(places.select("word").distinct())
    counts = written(index.filter("word is not null").select("word", "n").join(_small(wanted), "word").groupBy("word").agg(F.sum("n").alias("n")))
    counted = places.join(counts, "word", "left").groupBy("item_id", "item").agg(F.array_sort(F.collect_list(F.struct("pos", "word", F.coalesce("n", F.lit(0)).cast("long").alias("n")))).alias("w"))
    counted = counted.select("item_id", "item", F.transform("w", lambda w: w["word"]).alias("words"), F.transform("w", lambda w: w["n"]).alias("counts"))
    found = counted.mapInPandas(_searches(window), "item_id string, item long, anchors array<int>, anchor_words array<binary>, starts array<int>, length int")
    return items, written(found.withColumn("search", F.monotonically_increasing_id()))


def _has(sorted_list: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_list, values)
    at[at == len(sorted_list)] = 0
    return sorted_list[at] == values if len(sorted_list) else np.zeros(len(values), bool)


def _within(sorted_list: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether a member is within SLOP of each value."""
    return np.searchsorted(sorted_list, values - SLOP) < np.searchsorted(sorted_list, values + SLOP, "right")


def _intersected(block: pd.DataFrame) -> pd.DataFrame:
    """One block's anchor postings (word, postings, search, role, pos) -> (block, search, ord, at, delta, exact)."""
    lists: dict[int, dict[int, tuple[int, np.ndarray]]] = defaultdict(dict)
    starts, out = None, []
    for word, postings, found, roles, pos in zip(block["word"], block["postings"], block["search"], block["role"], block["pos"]):
        places = np.frombuffer(postings, "<u4").astype(np.int64)
        if word == STARTS:
            starts = places
        else:
            for s, r, p in zip(found.tolist(), roles.tolist(), pos.tolist()):
                lists[s][r >> 8] = (p, places, r & 255)
    for search, own in lists.items():
        if len(own) < next(iter(own.values()))[2]:
            continue  # an anchor is missing in this block
        pos, places, _ = own[0]
        rest = [own[r] for r in range(1, len(own))]
        near = places - pos
        for p, other, _ in rest:
            near = near[_within(other, near + p)]
            if not len(near):
                break
        if not len(near):
            continue
        exact = np.ones(len(near), bool)
        for p, other, _ in rest:
            exact &= _has(other, near + p)
        owner = np.searchsorted(starts, near + pos, "right") - 1
        # of places that aren't exact only a document's first is told
        told = exact.copy()
        told[np.unique(owner, return_index=True)[1]] = True
        near, owner, exact = near[told], owner[told], exact[told]
        out.append(pd.DataFrame({"search": search, "ord": owner, "at": near - starts[owner], "delta": near, "exact": exact}))
    found = pd.concat(out) if out else pd.DataFrame({"search": [], "ord": [], "at": [], "delta": [], "exact": []})
    return found.assign(block=block["block"].iloc[0])[["block", "search", "ord", "at", "delta", "exact"]]


def _verified(_, postings: pd.DataFrame, windows: pd.DataFrame) -> pd.DataFrame:
    """Goes on with the intersection through all words of each candidate window. postings: (word, postings, item, pos)."""
    lists: dict[int, dict[int, np.ndarray]] = defaultdict(dict)
    for found, items, pos in zip(postings["postings"], postings["item"], postings["pos"]):
        places = np.frombuffer(found, "<u4").astype(np.int64)
        for i, p in zip(items.tolist(), pos.tolist()):
            lists[i][p] = places
    item, delta, first, length = (windows[c].to_numpy(np.int64) for c in ("item", "delta", "win_start", "length"))
    ok, part = np.zeros(len(windows), bool), first // PART_WORDS
    order = np.lexsort((part, item))
    for own in np.split(order, np.flatnonzero((np.diff(item[order]) != 0) | (np.diff(part[order]) != 0)) + 1) if len(order) else ():
        base = int(part[own[0]]) * PART_WORDS
        have = {p - base: places for p, places in lists[int(item[own[0]])].items()}
        own = own[np.argsort(delta[own], kind="stable")]
        deltas, column = np.unique(delta[own], return_inverse=True)
        for low in range(0, len(deltas), PART_DIAGONALS):
            some, (a, b) = deltas[low : low + PART_DIAGONALS], np.searchsorted(column, (low, low + PART_DIAGONALS))
            these, at = own[a:b], column[a:b] - low
            begin = first[these] - base
            end = begin + length[these]
            # the words of this part of the item that stand on each diagonal, summed from its beginning
            there = np.zeros((int(end.max()) + 1, len(some)), np.int32)
            for p in range(len(there) - 1):
                if p in have:
                    there[p + 1] = _has(have[p], some + base + p)
            np.cumsum(there, axis=0, out=there)
            ok[these] = there[end, at] - there[begin, at] == length[these]
    give_back()
    return windows.loc[ok, ["block", "ord", "item_id", "item", "win_start", "start", "length"]]


def hits(index: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(block, ord, item_id, start, length, exact): windows of the benchmark found in the indexed documents. Written.

    ``start`` is a word position. Rows that aren't exact are proximity matches: all anchors of the window stand within
    SLOP words of their places, yet the document doesn't hold the phrase.
    """
    items, asked = searches(benchmark, index, window)
    # what a word's postings are wanted for; the role also says how many anchors the search has
    tag = F.posexplode(F.arrays_zip("anchors", "anchor_words")).alias("r", "a")
    tags = asked.select("search", F.size("anchors").alias("k"), tag).select(F.col("a.anchor_words").alias("word"), "search", (F.col("r") * 256 + F.col("k")).alias("role"), F.col("a.anchors").alias("pos"))
    tags = written(tags.groupBy("word").agg(F.collect_list("search").alias("search"), F.collect_list("role").alias("role"), F.collect_list("pos").alias("pos")))
    postings = index.filter("word is not null").select("block", "word", "postings")
    none = [F.array().cast(f"array<{t}>").alias(c) for c, t in (("search", "long"), ("role", "int"), ("pos", "int"))]
    starts = postings.filter(F.octet_length("word") == 0).select("block", "word", "postings", *none)
    wanted = postings.join(_small(tags), "word").select("block", "word", "postings", "search", "role", "pos").unionByName(starts)
    found = wanted.groupBy("block").applyInPandas(_intersected, "block long, search long, ord int, at int, delta long, exact boolean")
    found = written(found)
    windows = asked.select("search", "item_id", "item", F.explode("starts").alias("win_start"), "length")
    placed = found.join(_small(windows), "search").withColumn("start", F.col("at") + F.col("win_start"))
    candidates = written(placed.filter("exact").select("block", "ord", "item_id", "item", "win_start", "start", "length", "delta"))
    pos = F.explode(F.sequence("win_start", F.col("win_start") + F.col("length") - 1)).alias("pos")
    needed = candidates.select("block", "item", "win_start", "length").distinct().select("block", "item", pos).distinct()
    words = items.select("item", F.posexplode("words").alias("pos", "word"))
    needed = needed.join(_small(words), ["item", "pos"]).groupBy("block", "word").agg(F.collect_list("item").alias("item"), F.collect_list("pos").alias("pos"))
    needed = written(needed)
    # words that no block needs are dropped before the shuffle: their number is bounded by the benchmark, that of blocks and words is not
    lists = postings.join(_small(needed.select("word").distinct()), "word", "left_semi").join(needed.hint("merge"), ["block", "word"])
    schema = "block long, ord int, item_id string, item long, win_start int, start int, length int"
    exact = written(lists.groupBy("block").cogroup(candidates.groupBy("block")).applyInPandas(_verified, schema))
    key = ["block", "ord", "item", "win_start"]
    near = placed.groupBy(*key, "item_id", "length").agg(F.min("start").alias("start")).join(exact.select(*key).distinct(), key, "left_anti")
    both = exact.select("block", "ord", "item_id", "start", "length", F.lit(True).alias("exact")).unionByName(near.select("block", "ord", "item_id", "start", "length", F.lit(False).alias("exact")))
    return written(both)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, start, length, exact), as hits() has them. Written; the index goes."""
    with scratch(docs.sparkSession):
        index = build_index(docs, block_bytes)
        found = hits(index, benchmark, window).join(documents_of(index), ["block", "ord"])
        return kept(found.select("doc_id", "item_id", "start", "length", "exact"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near. Written; the index goes."""
    with scratch(docs.sparkSession):
        index = build_index(docs, block_bytes)
        return kept(judged(index, hits(index, benchmark, window)))


def judged(index: DataFrame, found: DataFrame) -> DataFrame:
    """report() of the documents of an index, from their hits."""
    key = ["block", "ord"]
    by_start = found.filter("exact").groupBy(*key, "start").agg(F.max(F.col("start") + F.col("length")).alias("end"))
    before = F.max("end").over(Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    covered = by_start.withColumn("before", F.coalesce(before, F.col("start"))).groupBy(*key).agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before"))).alias("n_hit"))
    items = found.groupBy(*key).agg(
        F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("item_id")))).alias("items"),
        F.count_distinct(F.when(~F.col("exact"), F.col("item_id"))).alias("n_near"),
    )
    none = F.array().cast("array<string>")
    return (
        documents_of(index)
        .join(covered, key, "left")
        .join(items, key, "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
            joined_hash(F.coalesce("items", none)).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows in which a whole window occurs; proximity matches stay. Rows are told apart by id and text. Only ids and
    hashes of rows that go are kept; the index goes."""
    with scratch(docs.sparkSession):
        index = build_index(docs, block_bytes)
        bad = hits(index, benchmark, window).filter("exact").select("block", "ord").distinct()
        bad = kept(documents_of(index).join(bad, ["block", "ord"]).select(F.col("doc_id").alias("d"), F.col("print").alias("p")).distinct())
    # a struct of all columns, so that none of the caller's names can clash
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row")).withColumn("print", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    return rows.join(_small(bad), F.col("row.doc_id").eqNullSafe(F.col("d")) & (F.col("print") == F.col("p")), "left_anti").select("row.*")
