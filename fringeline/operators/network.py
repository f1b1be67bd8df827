"""Epochs, pairs and time: networks, gaps, corrections in time, event pairs.

epochs: (frame, epoch[, acq_ts]). pairs: (frame, epoch1, epoch2). All frames run at once; windows are per frame, which is bounded by
a frame's epochs.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

def by_frame() -> WindowSpec:
    return Window.partitionBy("frame").orderBy("epoch")


def nearest_later(epochs: DataFrame, k: int) -> DataFrame:
    """Each epoch paired with the next ``k`` of its frame."""
    later = F.filter(F.array(*[F.lead("epoch", i).over(by_frame()) for i in range(1, k + 1)]), lambda x: x.isNotNull())
    return epochs.select("frame", F.col("epoch").alias("epoch1"), later.alias("l")).select("frame", "epoch1", F.explode("l").alias("epoch2"))


def single_reference(epochs: DataFrame, references: DataFrame) -> DataFrame:
    """references (frame, reference): every other epoch paired with it, in order of time."""
    j = epochs.join(references, "frame").filter("epoch != reference")
    return j.select("frame", F.least("epoch", "reference").alias("epoch1"), F.greatest("epoch", "reference").alias("epoch2"))


def network_gaps(epochs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(frame, start, stop): consecutive epochs that no pair spans. Pairs are laid out as +1/-1 on the frame's epochs."""
    steps = pairs.select("frame", F.col("epoch1").alias("epoch"), F.lit(1).alias("d")).unionByName(pairs.select("frame", F.col("epoch2").alias("epoch"), F.lit(-1).alias("d")))
    steps = steps.groupBy("frame", "epoch").agg(F.sum("d").alias("d"))
    rows = epochs.select("frame", "epoch").distinct().join(steps, ["frame", "epoch"], "left")
    rows = rows.withColumns({"open": F.sum(F.coalesce("d", F.lit(0))).over(by_frame()), "stop": F.lead("epoch").over(by_frame())})
    return rows.filter("stop is not null and open = 0").select("frame", F.col("epoch").alias("start"), "stop")


def merge_intervals(rows: DataFrame, margin_days: int) -> DataFrame:
    """(frame, start, stop) -> (frame, start, stop, days): intervals that come within twice the margin are one."""
    w = Window.partitionBy("frame").orderBy("start", "stop")
    before = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.datediff("start", before) > 2 * margin_days), 1).otherwise(0)
    island = rows.withColumn("new", new).withColumn("island", F.sum("new").over(w))
    merged = island.groupBy("frame", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return merged.select("frame", "start", "stop", F.datediff("stop", "start").alias("days"))


def cluster_epochs(epochs: DataFrame, days: int) -> DataFrame:
    """Runs of epochs that follow each other within ``days``: (frame, start, stop, n). The last run is given too."""
    gap = F.datediff("epoch", F.lag("epoch").over(by_frame()))
    runs = epochs.withColumn("run", F.sum(F.when(gap.isNull() | (gap > days), 1).otherwise(0)).over(by_frame()))
    return runs.groupBy("frame", "run").agg(F.min("epoch").alias("start"), F.max("epoch").alias("stop"), F.count("*").alias("n")).drop("run")


def outside_intervals(epochs: DataFrame, intervals: DataFrame) -> DataFrame:
    """Epochs in none of their frame's intervals: starts and ends are laid out as +1 and -1 on the frame's days and summed up to each epoch."""
    steps = intervals.select("frame", F.col("start").alias("epoch"), F.lit(1).alias("d")).unionByName(intervals.select("frame", F.date_add("stop", 1).alias("epoch"), F.lit(-1).alias("d")))
    days = steps.withColumn("own", F.lit(False)).unionByName(epochs.select("frame", "epoch", F.lit(0).alias("d"), F.lit(True).alias("own")))
    inside = days.withColumn("open", F.sum("d").over(by_frame())).filter("own and open > 0").select("frame", "epoch").distinct()
    return epochs.join(inside, ["frame", "epoch"], "left_anti")


def voted_epochs(flagged: DataFrame, more_than: int) -> DataFrame:
    """Epochs that more than so many flagged pairs share."""
    return flagged.select("frame", F.explode(F.array("epoch1", "epoch2")).alias("epoch")).groupBy("frame", "epoch").agg(F.count("*").alias("flags")).filter(F.col("flags") > more_than)


def repaired_baselines(rows: DataFrame, alternative: DataFrame, reset: float = 800.0, resource: float = 400.0) -> DataFrame:
    """rows (frame, epoch, bperp, seq): first of each epoch; beyond ``reset`` 0; beyond ``resource`` or null the mean of the alternative."""
    first = rows.groupBy("frame", "epoch").agg(F.min_by("bperp", "seq").alias("bperp"))
    alt = alternative.groupBy("frame").agg(F.avg("bperp").alias("alt"))
    b = F.abs("bperp")
    fixed = F.when(b > reset, F.lit(0.0)).when(F.col("bperp").isNull() | (b > resource), F.coalesce("alt", "bperp")).otherwise(F.col("bperp"))
    return first.join(alt, "frame", "left").select("frame", "epoch", fixed.alias("bperp"))


def last_epochs(epochs: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("frame").orderBy(F.col("epoch").desc())
    return epochs.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def start_dates(frames: DataFrame, epochs: DataFrame, n: int, today: Column) -> DataFrame:
    """The day before the n-th last epoch, else 90 days before today."""
    w = Window.partitionBy("frame").orderBy(F.col("epoch").desc())
    nth = epochs.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") == n).select("frame", F.date_sub("epoch", 1).alias("start"))
    return frames.join(nth, "frame", "left").select("frame", F.coalesce("start", F.date_sub(today, 90)).alias("start"))


def pair_baselines(pairs: DataFrame, baselines: DataFrame) -> DataFrame:
    """Baseline of the second minus that of the first; absent ones are 0."""
    out = pairs
    for i in (1, 2):
        out = out.join(baselines.select("frame", F.col("epoch").alias(f"epoch{i}"), F.col("bperp").alias(f"b{i}")), ["frame", f"epoch{i}"], "left")
    return out.withColumn("bperp", F.coalesce("b2", F.lit(0.0)) - F.coalesce("b1", F.lit(0.0))).drop("b1", "b2")


def classify_pairs(pairs: DataFrame, events: DataFrame, within_days: int) -> DataFrame:
    """pairs with acquisition times ts1, ts2, joined with events (frame, id, ts): pre, co or post; co spans the event.

    A pair before the event ends within ``within_days`` of it, one after it begins within them. The equi key is frame and stretch of
    time; a pair is listed under the stretches that it and its margins touch, an event under its own.
    """
    size, margin = 86_400 * max(1, within_days), 86_400 * within_days
    seconds = lambda c: F.col(c).cast("timestamp").cast("double")
    e = events.select("frame", "id", F.col("ts").alias("event_ts")).withColumn("__t", F.floor(seconds("event_ts") / size))
    p = pairs.withColumn("__t", F.explode(F.sequence(F.floor((seconds("ts1") - margin) / size), F.floor((seconds("ts2") + margin) / size))))
    near = (seconds("event_ts") <= seconds("ts2") + margin) & (seconds("event_ts") >= seconds("ts1") - margin)
    j = p.join(e, ["frame", "__t"]).filter(near).drop("__t")
    kind = F.when(F.col("ts2") <= F.col("event_ts"), "pre").when(F.col("ts1") > F.col("event_ts"), "post").otherwise("co")
    return j.withColumn("kind", kind)


def shortest_coseismic(classified: DataFrame) -> DataFrame:
    days = F.datediff("epoch2", "epoch1")
    return classified.filter("kind = 'co'").groupBy("frame", "id").agg(F.min_by(F.struct("epoch1", "epoch2"), F.struct(days, "epoch1")).alias("p")).select("frame", "id", "p.epoch1", "p.epoch2")


def covering_files(scenes: DataFrame, files: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """scenes (scene, sat, start, stop), files (file, sat, valid_from, valid_to): the file with the latest start that covers a scene (the largest in a
    tie). Scenes end when they start, or later.

    The keys are satellite and a short stretch of time. A scene is in the stretch in which it starts, a file in those in which it starts and ends. Of the
    files that go on beyond a whole stretch and its scenes only the latest goes to it. A stretch is then gone through in order of time, so
    no pair is made.
    """
    stretch = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / bucket_seconds)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    s = scenes.select("scene", F.col("sat").alias("__sat"), micros("start").alias("__a"), micros("stop").alias("__z"), stretch("start").alias("__t"), stretch("stop").alias("__last"))
    # one row: stretches that a scene goes on for
    further = s.agg(F.greatest(F.max(F.col("__last") - F.col("__t")), F.lit(0)).alias("__k"))
    f = files.filter("valid_from <= valid_to").select("file", F.col("sat").alias("__sat"), micros("valid_from").alias("__from"), micros("valid_to").alias("__to"), stretch("valid_from").alias("__b"), stretch("valid_to").alias("__e"))
    f = f.crossJoin(F.broadcast(further))
    ends = F.sequence(F.greatest(F.col("__b") + 1, F.col("__e") - F.col("__k")), F.col("__e"))
    listed = f.withColumn("__t", F.explode(F.array_union(F.array("__b"), F.when(F.col("__e") > F.col("__b"), ends).otherwise(F.array().cast("array<bigint>")))))
    beyond = f.groupBy("__sat", "__b", (F.col("__e") - F.col("__k")).alias("__e")).agg(F.max(F.struct("__from", "file", "__to")).alias("best")).filter("__e > __b + 1")
    beyond = beyond.withColumn("__t", F.explode(F.sequence(F.col("__b") + 1, F.col("__e") - 1))).groupBy("__sat", "__t").agg(F.max("best").alias("best"))
    listed = listed.select("__sat", "__t", "file", "__from", "__to").unionByName(beyond.select("__sat", "__t", "best.*"))

    def latest(s: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        f, s = f.sort_values(["__from", "file"]), s.sort_values("__a")
        begins, ends = f["__from"].tolist(), f["__to"].tolist()
        # files so far that no later one outlasts, with their ends below zero, which rise
        stack: list[int] = []
        below: list[int] = []
        hits, n = [], 0
        for a, z in zip(s["__a"].tolist(), s["__z"].tolist()):
            while n < len(begins) and begins[n] <= a:
                while below and below[-1] >= -ends[n]:
                    stack.pop(), below.pop()
                stack.append(n), below.append(-ends[n])
                n += 1
            at = bisect_right(below, -z) - 1
            hits.append(stack[at] if at >= 0 else -1)
        found = np.array(hits, dtype=np.int64)
        own = found >= 0
        at = found[own]
        return pd.DataFrame({"scene": s["scene"].to_numpy()[own], "file": f["file"].to_numpy()[at], "__from": f["__from"].to_numpy()[at]})

    kinds = f"scene {scenes.schema['scene'].dataType.simpleString()}, file {files.schema['file'].dataType.simpleString()}, __from long"
    near = s.filter("__a is not null and __z is not null").groupBy("__sat", "__t").cogroup(listed.groupBy("__sat", "__t")).applyInPandas(latest, kinds)
    best = near.groupBy("scene").agg(F.max_by("file", F.struct("__from", "file")).alias("file"))
    return scenes.join(best, "scene", "left")


def nearest_in_time(calendar: DataFrame, series: DataFrame, tolerance_days: int) -> DataFrame:
    """(frame, epoch, value) on the calendar's days: the value nearest in time within the tolerance, the earlier one in a tie."""
    cand = series.select("frame", F.col("epoch").alias("own"), "value", F.explode(F.sequence(F.date_sub("epoch", tolerance_days), F.date_add("epoch", tolerance_days))).alias("epoch"))
    hit = calendar.join(cand, ["frame", "epoch"])
    best = hit.groupBy("frame", "epoch").agg(F.min_by("value", F.struct(F.abs(F.datediff("own", "epoch")), "own")).alias("value"))
    return calendar.join(best, ["frame", "epoch"], "left")


def linear_in_time(calendar: DataFrame, series: DataFrame) -> DataFrame:
    """The same by linear interpolation between the values before and after; null outside them."""
    every = calendar.select("frame", "epoch").unionByName(series.select("frame", "epoch")).distinct().join(series, ["frame", "epoch"], "left")
    point = F.when(F.col("value").isNotNull(), F.struct("epoch", "value"))
    back = F.last(point, ignorenulls=True).over(by_frame().rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(point, ignorenulls=True).over(by_frame().rowsBetween(0, Window.unboundedFollowing))
    rows = every.withColumns({"a": back, "b": ahead})
    share = F.datediff("epoch", "a.epoch") / F.datediff("b.epoch", "a.epoch")
    value = F.when(F.col("a.epoch") == F.col("b.epoch"), F.col("a.value")).otherwise(F.col("a.value") + share * (F.col("b.value") - F.col("a.value")))
    return rows.withColumn("value", value).drop("a", "b").join(calendar, ["frame", "epoch"], "left_semi")


def monthly(series: DataFrame) -> DataFrame:
    """Monthly mean and sample deviation (0 for one value) on each frame's full calendar of months."""
    m = series.groupBy("frame", F.trunc("epoch", "month").alias("month")).agg(F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"))
    span = m.groupBy("frame").agg(F.explode(F.sequence(F.min("month"), F.max("month"), F.expr("interval 1 month"))).alias("month"))
    return span.join(m, ["frame", "month"], "left")


def rereference(series: DataFrame, until: Column | None = None) -> DataFrame:
    """Values minus that of the first epoch, or of the last epoch before ``until`` (the first if none is)."""
    first = F.min_by("value", "epoch")
    ref = first if until is None else F.coalesce(F.max_by("value", F.when(F.col("epoch") < until, F.col("epoch"))), first)
    return series.join(series.groupBy("frame").agg(ref.alias("ref")), "frame").withColumn("value", F.col("value") - F.col("ref")).drop("ref")


def revisit_forecast(epochs: DataFrame, event: Column, step_days: int = 6, recent: int = 5) -> DataFrame:
    """Per frame: last epoch, worst of the recent gaps, next possible, next expected, and first possible at or after the event."""
    rows = last_epochs(epochs.withColumn("gap", F.datediff("epoch", F.lag("epoch").over(by_frame()))), recent)
    s = rows.groupBy("frame").agg(F.max("epoch").alias("last"), F.max("gap").alias("worst"))
    steps = F.greatest(F.ceil(F.datediff(event, "last") / step_days), F.lit(1)).cast("int")
    return s.select("frame", "last", "worst", F.date_add("last", step_days).alias("next_possible"), F.date_add(F.col("last"), F.coalesce("worst", F.lit(step_days))).alias("next_expected"), F.date_add(F.col("last"), steps * step_days).alias("after_event"))


def auxiliary_epochs(wanted: DataFrame, processed: DataFrame, max_days: int = 181) -> DataFrame:
    """wanted (frame, epoch, reference, bursts) against processed (frame, aux, aux_bursts): the nearest processed epoch that holds all
    bursts, is nearer than the reference, and is at most ``max_days`` away; null if there is none. The equi key is frame and stretch of
    time; a processed epoch is listed under the stretches within reach."""
    stretch = lambda c: F.floor(F.unix_date(c) / max_days)
    near = processed.withColumn("__t", F.explode(F.sequence(stretch(F.date_sub("aux", max_days)), stretch(F.date_add("aux", max_days)))))
    d = F.abs(F.datediff("aux", "epoch"))
    ok = (F.col("aux") != F.col("epoch")) & (d < F.abs(F.datediff("reference", "epoch"))) & (d <= max_days) & (F.size(F.array_except("bursts", "aux_bursts")) == 0)
    best = wanted.withColumn("__t", stretch(F.col("epoch"))).join(near, ["frame", "__t"]).filter(ok).groupBy("frame", "epoch").agg(F.min_by("aux", F.struct(d, "aux")).alias("aux"))
    return wanted.join(best, ["frame", "epoch"], "left")


def latest_processing(files: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """files (date, name): of names equal but for their last nine characters, the first by name; names are held against others of the same ``by`` only."""
    prefix = F.expr("substring(name, 1, char_length(name) - 9)")
    w = Window.partitionBy(*by, "date", prefix).orderBy("name")
    return files.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def max_post_days(magnitude: Column, revisit_days: Column) -> Column:
    """Days after an earthquake for which its frames are followed: a number of acquisitions by magnitude, times the revisit time.

    Fixed values: 3 below 6, 5 below 6.5, 7 below 7, 9 below 7.5, 5 below 8, then 13; 100 for a placeholder of magnitude 0.
    """
    steps = F.when(magnitude == 0, 100).when(magnitude < 6, 3).when(magnitude < 6.5, 5).when(magnitude < 7, 7).when(magnitude < 7.5, 9).when(magnitude < 8, 5).otherwise(13)
    return steps * revisit_days


def days_since_last(epochs: DataFrame, today: Column) -> DataFrame:
    return epochs.groupBy("frame").agg(F.datediff(today, F.max("epoch")).alias("days"))
