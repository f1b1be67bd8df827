"""Sharding by a hypergeometric communication matrix, in DataFrame and SQL functions only.

1. Rows fall into 2^depth blocks by a seeded hash; blocks are counted.
2. The matrix of how many rows of each block go to each shard is drawn exactly: a node of a binary tree over the
   blocks splits its shards' places between its halves by multivariate hypergeometric draws, from the root down.
3. Each block is permuted (ranked by hash) and dealt to the shards by its row of the matrix.
4. After the exchange each shard is permuted again, by a second hash, in ranges of bounded size; the ranges' counts
   give the offsets of the slots.

The law is ``rows``: shard counts differ by one at most. Given the hashes, reruns agree at any partitioning of the input.
Groups of equal texts are not kept together. Null texts count 8 bytes and have the checksum of an empty text.
Repeated rows each get a place of their own: they are counted, the count is written out as numbers, and a row is dealt by its
hash and number, so that copies spread over blocks however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringeline.llm.common import written

SHARDS = 24
SEED = 7
#: Rows of a block, and of a range within a shard, about.
BLOCK_ROWS = 4_096
#: Copies of a row that are numbered by a window; of more, one row stands for all.
COPIES = 1_000
_DEVIATIONS = 12


def _unit(*keys: Column) -> Column:
    """Uniform in (0, 1) from a hash of the keys."""
    return (F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double") + 0.5) / float(1 << 53)


def hypergeometric(u: Column, total: Column, good: Column, drawn: Column) -> Column:
    """Inverse of the hypergeometric distribution: good ones among ``drawn`` of ``total``, at the quantile ``u``.

    Weights follow from one another by their ratios, over all values within 12 deviations of the mean (what lies
    beyond has a mass under 1e-30) and within the support.
    """
    one = F.lit(1.0)
    n, k, m = (c.cast("double") for c in (total, good, drawn))
    mean = F.when(n > 0, m * k / n).otherwise(F.lit(0.0))
    spread = F.ceil(F.sqrt(F.when(n > 1, mean * (one - k / n) * (n - m) / (n - one)).otherwise(F.lit(0.0))) * _DEVIATIONS) + 12
    low = F.greatest(F.lit(0).cast("long"), (drawn + good - total), (F.floor(mean) - spread)).cast("long")
    high = F.least(drawn, good, (F.ceil(mean) + spread)).cast("long")

    def following(w: Column, x: Column) -> Column:  # weight of x + 1 from that of x
        x = x.cast("double")
        return w * (k - x) * (m - x) / ((x + one) * (n - k - m + x + one))

    start = F.struct(one.alias("w"), F.lit(0.0).alias("sum"))
    values = F.sequence(low, high)
    mass = F.aggregate(values, start, lambda acc, x: F.struct(following(acc["w"], x).alias("w"), (acc["sum"] + acc["w"]).alias("sum")))["sum"]
    first = F.struct(one.alias("w"), F.lit(0.0).alias("sum"), low.alias("at"))

    def place(wanted: Column) -> Column:
        """The last value whose weights before it sum to ``wanted`` at most."""
        return F.aggregate(
            values,
            first,
            lambda acc, x: F.struct(
                following(acc["w"], x).alias("w"),
                (acc["sum"] + acc["w"]).alias("sum"),
                F.when(acc["sum"] <= wanted, x).otherwise(acc["at"]).alias("at"),
            ),
        )["at"]

    # a one-row transform, so that the mass is summed once and not again for each value
    found = F.get(F.transform(F.array(u * mass), place), F.lit(0))
    return F.when(low >= high, low).otherwise(found)


def _deal(seed: int, level: int):
    """A step of the multivariate draw: the rows of a node's left half that go to shard ``j``."""

    def step(acc: Column, j: Column) -> Column:
        good = F.get(F.col("places"), j)
        got = hypergeometric(_unit(F.lit(seed), F.lit(level), F.col("node"), j), acc["total"], good, acc["rows"])
        # a one-row transform, so that the draw is made once and used twice
        drawn = F.transform(F.array(got), lambda g: F.struct(F.concat(acc["out"], F.array(g)).alias("out"), (acc["total"] - good).alias("total"), (acc["rows"] - g).alias("rows")))
        return F.get(drawn, F.lit(0))

    return step


def communication_matrix(blocks: DataFrame, depth: int, sizes: list[int], seed: int = SEED) -> DataFrame:
    """blocks (block, n) of 2^depth blocks -> (block, places): places[j] rows of the block go to shard j."""
    spark = blocks.sparkSession
    places = F.array(*[F.lit(s).cast("long") for s in sizes])
    nodes = spark.range(1).select(F.col("id").alias("node"), places.alias("places"))
    for level in range(1, depth + 1):
        half = F.shiftright("block", depth - level)
        left = blocks.filter(half.bitwiseAND(F.lit(1)) == 0).groupBy(F.shiftright(half, 1).alias("node")).agg(F.sum("n").alias("n_left"))
        # shard by shard: of the places left in the node and its left half's rows left
        state = F.struct(F.array().cast("array<long>").alias("out"), F.aggregate("places", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), F.coalesce("n_left", F.lit(0)).cast("long").alias("rows"))

        dealt = F.aggregate(F.sequence(F.lit(0), F.lit(len(sizes) - 1)), state, _deal(seed, level))["out"]
        nodes = nodes.join(left, "node", "left").select("node", "places", dealt.alias("left"))
        right = F.zip_with("places", "left", lambda a, b: a - b)
        nodes = nodes.select(F.explode(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("places")), F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("places")))).alias("c")).select("c.*")
        nodes = written(nodes)
    return nodes.withColumnRenamed("node", "block")


def assign(rows: DataFrame, key: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` with shard and slot. ``key`` names the columns that order rows; equal keys are placed one after another."""
    n = rows.count()
    depth = max(0, (n // BLOCK_ROWS).bit_length())
    h1, h2 = (F.xxhash64(*[F.col(c) for c in key], F.lit(seed + i)) for i in (1, 2))
    block = F.shiftrightunsigned(h1, 64 - depth).cast("long") if depth else F.lit(0).cast("long")
    hashed = rows.withColumns({"__h1": h1, "__h2": h2, "__block": block})
    blocks = written(hashed.groupBy("__block").agg(F.count("*").alias("n")).withColumnRenamed("__block", "block"))
    sizes = [n // shards + (j < n % shards) for j in range(shards)]
    matrix = communication_matrix(blocks, depth, sizes, seed)
    place = F.row_number().over(Window.partitionBy("__block").orderBy("__h1", *key))
    # the first shard whose places, summed from the left, reach this row's rank
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda j: F.aggregate(F.slice("places", F.lit(1), j), F.lit(0).cast("long"), lambda a, x: a + x))
    ends = matrix.select(F.col("block").alias("__block"), ends.alias("__ends"))
    ranges = max(1, n // shards // BLOCK_ROWS)
    piece = F.floor((F.col("__h2") / float(1 << 63) + 1.0) / 2.0 * ranges).cast("int")
    dealt = written(
        hashed.withColumn("__place", place)
        .join(ends, "__block")
        .withColumn("shard", F.size(F.filter("__ends", lambda e: e < F.col("__place"))).cast("int"))
        .withColumn("__piece", F.least(piece, F.lit(ranges - 1)))
        .drop("__block", "__ends", "__place", "__h1")
    )
    counts = dealt.groupBy("shard", "__piece").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("shard").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(F.col("shard").alias("__s"), F.col("__piece").alias("__p"), before.alias("__before"))
    rank = F.row_number().over(Window.partitionBy("shard", "__piece").orderBy("__h2", *key))
    return (
        dealt.withColumn("__rank", rank)
        .join(offsets, (F.col("shard") == F.col("__s")) & (F.col("__piece") == F.col("__p")))
        .withColumn("slot", (F.col("__before") + F.col("__rank") - 1).cast("long"))
        .drop("__h2", "__piece", "__rank", "__s", "__p", "__before")
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Every row of a narrow table with its number among its copies, 0, 1, ...; rows are counted first, then written out again."""
    counts = written(rows.groupBy(*rows.columns).agg(F.count("*").alias("__n")))
    few = counts.filter(F.col("__n") <= COPIES).withColumn("__from", F.lit(0).cast("long"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.lit(COPIES).cast("long")))
    many = counts.filter(F.col("__n") > COPIES).withColumn("__from", chunk)
    if many.limit(1).count():  # chunks of a large count go to different tasks
        few = few.unionByName(many.repartition("__from", *rows.columns))
    last = F.least(F.col("__from") + COPIES, F.col("__n")) - 1
    return few.withColumn("copy", F.explode(F.sequence(F.col("__from"), last))).drop("__n", "__from")


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32)"""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))


def report(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    placed = assign(written(numbered(measured(docs))), ["doc_id", "text_crc32", "size", "copy"], shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _row_hashes(docs: DataFrame) -> list[Column]:
    """Two hashes of all columns, 96 bits together; maps, which have no hash, are hashed as JSON."""
    cols = [F.to_json(F.struct(docs[c])) if "map<" in kind or kind == "variant" else docs[c] for c, kind in docs.dtypes]
    return [F.xxhash64(F.lit(SEED), *cols), F.hash(F.lit(SEED), *cols)]


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with shard and slot (shard_new and slot_new if it has such columns).

    Places are drawn on hashes of rows alone; then one shuffle carries the texts to them. Copies of a row (equal in all columns) share a
    hash, which holds all their places; they take them in turn. Where there are more than COPIES of a row, it is carried once.
    """
    used = {c.lower() for c in docs.columns}
    shard, slot = (n if n not in used else f"{n}_new" for n in ("shard", "slot"))
    a, b = _row_hashes(docs)
    # a struct of all columns, so that none of the caller's names can clash
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), a.alias("a"), b.alias("b"))
    placed = written(assign(written(numbered(docs.select(a.alias("a"), b.alias("b")))), ["a", "b", "copy"], shards))
    sizes = placed.groupBy("a", "b").agg(F.max("copy").alias("last"))
    hot = written(sizes.filter(F.col("last") >= COPIES).select("a", "b"))
    any_hot = bool(hot.limit(1).count())
    few = placed.join(hot, ["a", "b"], "left_anti") if any_hot else placed
    places = few.groupBy("a", "b").agg(F.array_sort(F.collect_list(F.struct("shard", "slot"))).alias("places"))
    nth = F.row_number().over(Window.partitionBy("a", "b").orderBy(F.lit(0)))
    usual = packed.join(hot, ["a", "b"], "left_anti") if any_hot else packed
    out = usual.withColumn("nth", nth).join(places, ["a", "b"]).select("row", F.get("places", F.col("nth") - 1).alias("place"))
    if any_hot:
        one = written(packed.join(hot, ["a", "b"], "left_semi").groupBy("a", "b").agg(F.first("row").alias("row")))
        out = out.unionByName(placed.join(one, ["a", "b"]).select("row", F.struct("shard", "slot").alias("place")))
    return out.select("row.*", F.col("place.shard").alias(shard), F.col("place.slot").alias(slot))
