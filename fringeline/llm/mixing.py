"""Mixing sources to target weights by subset-sum budget fitting.

1. Documents are counted by (source, exact length in words). Sources in code-point order, null last, take the
   weights in turn and share the budget; a target stops at ``MAX_REPEATS`` times its source, the excess is shared again.
2. A source's whole repeats come first. The remaining budget is fitted on the histogram: every length class gives its
   even share, the rest is given out from the longest class down until a bounded budget is left, and a
   bounded-knapsack dynamic program over that budget picks how many documents of each length are added.
3. Of each class exactly that many documents are selected, by seeded hash of id and text. The hash at which a class is cut is
   found by ranking distinct hashes within hash ranges of about ``RANGE_ROWS`` rows, so one class may hold any share of the
   rows. Rows of the same id and text share a hash; where a class is cut among them, ``report`` ranks them by row number in the same
   way, and ``mixed`` lets one of them stand for all, as often as they are taken together.

Null texts have no words and are taken zero words. No document is taken more than ``MAX_REPEATS`` times. Null and repeated ids are
documents like others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringeline.llm.common import NOT_SPACE, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 20240501
RANGE_ROWS = 5_000
#: Words that the dynamic program fits; the even shares leave about half of it.
KNAPSACK_WORDS = 1 << 17
#: Words by which the program may look beyond the budget for a nearer sum.
OVER_WORDS = 4_096
#: Rows of the class table up to which it is broadcast: 64 MB at the 256 bytes that a row of it takes in memory.
BROADCAST_ROWS = 250_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def _order_hash(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id.cast("string"), text, F.lit(SEED))


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(source, source_size) -> with target. The place in the order comes from a range sort and the row counts of its
    partitions; the water level is found by aggregates, a few at most."""
    ranged = written(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    counts = {r.part: r.n for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one row for each partition
    offset, before = {}, 0
    for part in sorted(counts):
        offset[part] = before
        before += counts[part]
    start = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in offset.items() for x in kv]), F.col("part")), F.lit(0)) if offset else F.lit(0)
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + start
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))))
    table = written(ranged.select("source", "source_size", weight.alias("weight")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    cap, level = F.col("source_size") * float(MAX_REPEATS), 0.0
    full = F.lit(False)
    while total:  # each round fills at least one more source, or is the last
        free = table.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not free[1]:
            break
        new = (share * total - free[0]) / free[1]
        if new <= level:
            break
        level = new
        full = F.col("weight") * level > cap
    return table.select("source", "source_size", F.when(full, cap).otherwise(F.col("weight") * level).alias("target") if total else F.lit(0.0).alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come as near to ``budget`` as found."""
    total = int((lengths * counts).sum())
    even = max(0.0, min(1.0, (budget - KNAPSACK_WORDS / 2) / total)) if total else 0.0
    take = np.minimum((counts * even).astype(np.int64), counts)
    left = budget - int((lengths * take).sum())
    for i in np.argsort(-lengths):
        if left <= KNAPSACK_WORDS or not lengths[i]:
            break
        more = min(int(counts[i] - take[i]), (left - KNAPSACK_WORDS // 2) // int(lengths[i]))
        take[i] += max(0, more)
        left -= max(0, more) * int(lengths[i])
    if left > 0:
        take += _knapsack(lengths, counts - take, left)
    # one document more may come nearer, though it is longer than what is left
    left = budget - int((lengths * take).sum())
    spare = np.flatnonzero((counts > take) & (lengths > 0))
    if left > 0 and len(spare):
        best = spare[np.argmin(np.abs(lengths[spare] - left))]
        take[best] += abs(int(lengths[best]) - left) < left
    return take


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack: how many of each length to take for the sum nearest to ``budget``.

    A budget above KNAPSACK_WORDS, where only documents of such lengths are left, is fitted on lengths scaled down to the table.
    """
    scale = -(-budget // KNAPSACK_WORDS)
    lengths, budget = np.where(lengths > 0, np.maximum(1, np.rint(lengths / scale).astype(np.int64)), 0), budget // scale
    take, end = np.zeros_like(counts), budget + OVER_WORDS
    # chunks of 1, 2, 4, ... documents of a length; the first chunk that reached each sum
    chunks, reach, by = [], np.zeros(end + 1, bool), np.full(end + 1, -1, np.int64)
    reach[0] = True
    for i in np.flatnonzero((lengths > 0) & (lengths <= end) & (counts > 0)):
        spare, size = min(int(counts[i]), end // int(lengths[i])), 1
        while spare and not reach[budget]:
            size = min(size, spare)
            step = size * int(lengths[i])
            if step <= end:
                new = np.zeros(end + 1, bool)
                new[step:] = reach[: end + 1 - step]
                new &= ~reach
                by[new] = len(chunks)
                reach |= new
                chunks.append((i, size, step))
            spare -= size
            size *= 2
        if reach[budget]:
            break
    sums = np.flatnonzero(reach)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    while at:
        i, size, step = chunks[by[at]]
        take[i] += size
        at -= step
    return take


def _fit_source(group: pd.DataFrame) -> pd.DataFrame:
    """One source's histogram: a row for each distinct length, never its documents."""
    group = group.sort_values("size")
    budget, source_size = float(group["target"].iloc[0]), int(group["source_size"].iloc[0])
    whole = min(MAX_REPEATS, int(budget // source_size)) if source_size else 0
    rest = round(budget - whole * source_size) if whole < MAX_REPEATS else 0
    take = fit(group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64), max(0, rest))
    return group.assign(whole=np.int32(whole), take=take)


def _nth(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """rows (*keys, x) with a weight each, wanted (*keys, nth, n) -> (*keys, cut, more, tied): the x at which the weights, in order of
    x, sum to ``nth``; of the ``tied`` weight at that x ``more`` is wanted. x is a hash; ranges of it are counted, and rows are
    ranked within the one that holds the place."""
    w = wanted.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], "nth", F.ceil(F.col("n") / RANGE_ROWS).cast("long").alias("ranges"))
    on = [F.col(k).eqNullSafe(F.col(f"k{i}")) for i, k in enumerate(keys)]
    piece = F.floor((F.col("x") / float(1 << 63) + 1.0) / 2.0 * F.col("ranges")).cast("long")
    ranged = rows.join(_small(w), on).groupBy(*keys, "x", "nth", piece.alias("piece")).agg(F.sum("weight").alias("weight"))
    upto = F.sum("rows").over(Window.partitionBy(*keys).orderBy("piece"))
    ranges = ranged.groupBy(*keys, "piece", "nth").agg(F.sum("weight").alias("rows")).withColumn("upto", upto)
    holds = written(
        ranges.filter((F.col("upto") >= F.col("nth")) & (F.col("upto") - F.col("rows") < F.col("nth")))
        .select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col("piece").alias("p"), (F.col("nth") - F.col("upto") + F.col("rows")).alias("rest"))
    )
    within = F.sum("weight").over(Window.partitionBy(*keys, "piece").orderBy("x"))
    found = ranged.join(_small(holds), [*on, F.col("piece") == F.col("p")]).select(*keys, "x", "weight", "rest", within.alias("within"))
    found = found.filter((F.col("within") >= F.col("rest")) & (F.col("within") - F.col("weight") < F.col("rest")))
    return found.select(*keys, F.col("x").alias("cut"), (F.col("rest") - F.col("within") + F.col("weight")).alias("more"), F.col("weight").alias("tied"))


def class_table(rows: DataFrame) -> DataFrame:
    """rows (source, size, h) -> (source, source_size, target, size, whole, cut, more, tied), one row for each class. Written.

    Each document of a class is taken ``whole`` times, and once more if its hash is below ``cut``; so are ``more`` of the ``tied``
    documents whose hash is ``cut``.
    """
    classes = written(rows.groupBy("source", "size").agg(F.count("*").alias("n")))
    targets = source_targets(classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))).withColumnRenamed("source", "s")
    fitted = written(
        classes.join(targets, F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .groupBy("source")
        .applyInPandas(_fit_source, "source string, size long, n long, source_size long, target double, whole int, take long")
    )
    some = fitted.filter((F.col("take") > 0) & (F.col("take") < F.col("n"))).select("source", "size", F.col("take").alias("nth"), "n")
    cuts = _nth(rows.select("source", "size", F.col("h").alias("x"), F.lit(1).cast("long").alias("weight")), some, ["source", "size"]).withColumnsRenamed({"source": "s", "size": "z"})
    joined = fitted.join(cuts, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left")
    none, every = F.lit(-(1 << 63)), F.lit((1 << 63) - 1)
    cut = F.when(F.col("take") <= 0, none).when(F.col("take") >= F.col("n"), every).otherwise(F.col("cut"))
    # at the ends of the range all rows of the hash share its fate
    more, tied = (F.when(F.col("take") <= 0, zero).when(F.col("take") >= F.col("n"), 1).otherwise(F.col(c)).cast("long") for c, zero in (("more", 0), ("tied", 1)))
    return written(joined.select("source", "source_size", "target", "size", "whole", cut.alias("cut"), more.alias("more"), tied.alias("tied")))


def _classed(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows (source, size, h, ...) with the columns of their class."""
    t = table.withColumnsRenamed({"source": "s", "size": "z"})
    return rows.join(_small(t), F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")


def _repeats(at_cut: Column) -> Column:
    """How often a row is taken; ``at_cut`` says whether one whose hash is the cut is among those taken once more."""
    once = (F.col("h") < F.col("cut")) | ((F.col("h") == F.col("cut")) & at_cut)
    return F.col("whole") + once.cast("int") * (F.col("whole") < MAX_REPEATS).cast("int")


def _measured(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.col("text")
    return docs.select(*more, F.col("source").cast("string").alias("source"), word_count(text).alias("size"), _order_hash(F.col("doc_id"), text).alias("h"))


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken (words, repeats counted)."""
    rows = written(_measured(docs, F.col("doc_id"), F.monotonically_increasing_id().alias("number")))
    table = class_table(rows)
    found = _classed(rows, table)
    # classes that are cut among rows of the same id and text: those are ranked by a hash of their row's number
    parted = table.filter((F.col("more") > 0) & (F.col("more") < F.col("tied")))
    if not parted.limit(1).count():
        taken = _repeats(F.col("more") > 0)
    else:
        keys, x = ["source", "size", "h"], F.xxhash64("number", F.lit(SEED))
        wanted = parted.select("source", "size", F.col("cut").alias("h"), F.col("more").alias("nth"), F.col("tied").alias("n"))
        last = written(_nth(rows.select(*keys, x.alias("x"), F.lit(1).cast("long").alias("weight")), wanted, keys).select("source", "size", F.col("cut").alias("last")))
        last = last.withColumnsRenamed({"source": "s", "size": "z"})
        found = found.join(_small(last), F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left")
        taken = _repeats((F.col("more") > 0) & (F.col("last").isNull() | (x <= F.col("last"))))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * taken).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: rows repeated or left out; rows without words carry no weight and stay once.

    The class table has a row for each source and length; up to BROADCAST_ROWS rows it is broadcast and no text is
    shuffled, beyond that it is joined by a shuffle.
    """
    # a struct of all columns, so that none of the caller's names can clash
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    sized = packed.select("row", F.col("row.source").alias("source"), F.col("row.text").alias("text"), F.col("row.doc_id").alias("doc_id"))
    table = class_table(written(_measured(sized)))
    found = _classed(_measured(sized, F.col("row")), table)
    parted = (F.col("h") == F.col("cut")) & (F.col("more") > 0) & (F.col("more") < F.col("tied"))
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(_repeats(F.col("more") > 0))
    out = found.filter(~parted).select("row", times.cast("long").alias("times"))
    if table.filter((F.col("more") > 0) & (F.col("more") < F.col("tied"))).limit(1).count():
        one = found.filter(parted & (F.col("size") > 0)).groupBy("source", "size", "h", "whole", "more").agg(F.first("row").alias("row"), F.count("*").alias("n"))
        out = out.unionByName(one.select("row", (F.col("n") * F.col("whole") + F.when(F.col("whole") < MAX_REPEATS, F.col("more")).otherwise(0)).alias("times")))
        out = out.unionByName(found.filter(parted & (F.col("size") == 0)).select("row", F.lit(1).cast("long").alias("times")))
    return out.filter("times > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")
