"""Exact medians of groups of any size, by distributed selection.

``F.median`` brings all distinct values of a group into one task. Here a sketch names a narrow range about the middle, partial sums count what lies
at and between its ends exactly, and what lies between them alone goes on, until it is ``MOST`` values or fewer. An end that is the value sought
ends the search, so that many equal values don't matter. The sketch can't make the result wrong: the counts decide, and a range that misses a rank
is opened to that side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fringeline.storage import written

#: Values of a group that one task may hold.
MOST = 100_000
#: Rank error of the sketch is 1 / ACCURACY of a group's values.
ACCURACY = 2_000
#: Rows of a table of groups up to which it is broadcast, at a few keys and five numbers a row; beyond that rows are salted.
BROADCAST_GROUPS = 100_000
SALTS = 64


def with_groups(rows: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` joined with one row for each group, without bringing a group together: broadcast where counted small, else on salted keys."""
    if not by:
        return rows.crossJoin(F.broadcast(groups))  # one row
    if groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(groups), by)
    salted = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = rows.withColumn("__salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return own.join(salted, [*by, "__salt"]).drop("__salt")


#: Ranks of the two middle values among what is left, and the values where they are known.
TWO = ["__k1", "__k2", "__v1", "__v2"]
#: Shares at which the sketch is asked for marks.
MARKS = [i / 256 for i in range(257)]


def _counted(live: DataFrame, state: DataFrame, by: list[str]) -> DataFrame:
    """(by, TWO, __lo, __hi): ranks among what lies between the two marks, both left out; a mark is null where the range is open to that side."""
    step = 4 / ACCURACY
    # a rank whose value is known asks for nothing
    first, last = F.when(F.col("__v1").isNull(), F.col("__k1")).otherwise(F.col("__k2")), F.when(F.col("__v2").isNull(), F.col("__k2")).otherwise(F.col("__k1"))
    sketch = with_groups(live, state, by).groupBy(*by, "__n", *TWO).agg(F.percentile_approx("__v", F.array(*map(F.lit, [*MARKS, 0.5 - step, 0.5 + step])), ACCURACY).alias("__m"))
    centred = (F.abs(first / F.col("__n") - 0.5) < step / 4) & (F.abs(last / F.col("__n") - 0.5) < step / 4)
    place = lambda k, d, f: F.least(F.greatest(f((k / F.col("__n") + d) * 256), F.lit(0)), F.lit(256)).cast("int")
    low = F.get("__m", F.when(centred, F.lit(257)).otherwise(place(first, -step, F.floor)))
    high = F.get("__m", F.when(centred, F.lit(258)).otherwise(place(last, step, F.ceil)))
    marks = written(sketch.select(*by, "__n", *TWO, low.alias("__lo"), high.alias("__hi")))
    v, lo, hi = F.col("__v"), F.col("__lo"), F.col("__hi")
    sums = with_groups(live, marks, by).groupBy(*by, "__n", *TWO, "__lo", "__hi").agg(
        F.count_if(v < lo).alias("__b"), F.count_if(v <= lo).alias("__bl"), F.count_if(v < hi).alias("__bh"), F.count_if(v <= hi).alias("__h")
    )
    # both marks are values themselves: a rank that falls on one is known, whatever number of values are equal to it
    value = lambda k: F.when(F.col(k).between(F.col("__b"), F.col("__bl") - 1), lo).when(F.col(k).between(F.col("__bh"), F.col("__h") - 1), hi)
    known = sums.withColumns({"__v1": F.coalesce("__v1", value("__k1")), "__v2": F.coalesce("__v2", value("__k2"))})
    missed = lambda test: (F.col("__v1").isNull() & test(F.col("__k1"))) | (F.col("__v2").isNull() & test(F.col("__k2")))
    under, over = missed(lambda k: k < F.col("__b")), missed(lambda k: k >= F.col("__h"))
    left = F.when(under, F.lit(0)).otherwise(F.col("__bl"))
    return known.select(*by, (F.col("__k1") - left).alias("__k1"), (F.col("__k2") - left).alias("__k2"), "__v1", "__v2", F.when(~under, lo).alias("__lo"), F.when(~over, hi).alias("__hi"))


def medians(rows: DataFrame, by: list[str], value: Column, most: int = MOST) -> DataFrame:
    """(by, median) of the values that are not null; groups without any are left out (without ``by``: one row, null).

    Sizes are counted first, which runs a job; where no group is larger than ``most`` this is a plain aggregate. Otherwise values are written, and a
    round is two aggregates over what is left.
    """
    live = rows.select(*by, value.cast("double").alias("__v")).filter("__v is not null")
    largest = live.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if largest <= most:
        return live.groupBy(*by).agg(F.median("__v").alias("median"))
    live = written(live)
    state = live.groupBy(*by).agg(F.count("*").alias("__n"))
    ranks = {"__k1": F.floor((F.col("__n") - 1) / 2), "__k2": F.floor(F.col("__n") / 2)}
    state = written(state.withColumns({**ranks, "__v1": F.lit(None).cast("double"), "__v2": F.lit(None).cast("double")}))
    done = []
    while True:
        # groups that fit are finished: what is left of them is sorted in one task
        small = state.filter(F.col("__n") <= most).drop("__n")
        near = with_groups(live, small, by).groupBy(*by, *TWO).agg(F.array_sort(F.collect_list("__v")).alias("__all"))
        at = lambda i: F.coalesce(f"__v{i}", F.get("__all", F.col(f"__k{i}").cast("int")))
        done.append(written(near.select(*by, ((at(1) + at(2)) / 2).alias("median"))))
        large = state.filter(F.col("__n") > most)
        if not large.limit(1).count():
            break
        counted = written(_counted(live, large, by))
        done.append(written(counted.filter("__v1 is not null and __v2 is not null").select(*by, ((F.col("__v1") + F.col("__v2")) / 2).alias("median"))))
        open_ = counted.filter("__v1 is null or __v2 is null")
        inside = (F.col("__lo").isNull() | (F.col("__v") > F.col("__lo"))) & (F.col("__hi").isNull() | (F.col("__v") < F.col("__hi")))
        live = written(with_groups(live, open_.select(*by, "__lo", "__hi"), by).filter(inside).select(*by, "__v"))
        sizes = live.groupBy(*by).agg(F.count("*").alias("__n"))
        state = written(with_groups(sizes, open_.select(*by, *TWO), by))
    return reduce(DataFrame.unionByName, done)
