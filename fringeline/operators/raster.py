"""Pixel tables: stack statistics, multilooking, masks, neighbourhoods, mosaics.

A raster is a tall table (frame or other keys, row, col, value ...). No-data (0 or NaN) becomes null at load. Aggregations are one
shuffle with partial sums; neighbourhoods are weighted sums one dimension at a time, or blocks with halos, so no task ever holds a
whole raster.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringeline.functions.scalar import wrap
from fringeline.operators import sliding
from fringeline.operators.lsq import huber_slope
from fringeline.operators.select import MOST, medians, with_groups
from fringeline.storage import written

CELL = ["row", "col"]


def valid(x: str | Column) -> Column:
    """Null for 0 and NaN."""
    c = F.col(x) if isinstance(x, str) else x
    return F.nullif(F.nanvl(c.cast("double"), F.lit(None).cast("double")), F.lit(0.0))


def pixel_metres(points: DataFrame, by: str, step: float) -> DataFrame:
    """Metres per pixel of a spacing in degrees, at the mean latitude."""
    metre = 111_132.954 * step
    return points.groupBy(by).agg(F.lit(metre).alias("lat_m"), (metre * F.cos(F.radians(F.avg("lat")))).alias("lon_m"))


def stack_stats(pixels: DataFrame, value: str, by: list[str] = CELL, compat: bool = False) -> DataFrame:
    """Mean, sample deviation and stability index 1 - std / mean of each pixel over its stack.

    ``compat`` reproduces a deviation in which no-data also adds the squared mean, while only valid values are counted.
    """
    v = valid(value)
    out = pixels.groupBy(*by).agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.count(v).alias("n"), F.count("*").alias("total"))
    if compat:
        squares = F.pow("std", 2) * (F.col("n") - 1) + (F.col("total") - F.col("n")) * F.pow("mean", 2)
        out = out.withColumn("std", F.sqrt(squares / F.nullif(F.col("n") - 1, F.lit(0))))
    index = 1 - F.col("std") / F.col("mean")
    return out.withColumn("stability", F.when(index <= 0, F.lit(1e-5)).otherwise(index)).drop("total")


def seasonal_coherence(pairs: DataFrame, value: str = "coh", class_days: int = 10, classes: int = 10) -> DataFrame:
    """Mean by baseline class and season of the pair's midpoint (summer: April to September); classes of more than one pair."""
    btemp = F.datediff("epoch2", "epoch1")
    mid = F.month(F.date_add("epoch1", F.floor(btemp / 2).cast("int")))
    rows = pairs.withColumns({"class": F.least(F.floor(btemp / class_days), F.lit(classes - 1)), "season": F.when(mid.between(4, 9), "summer").otherwise("winter")})
    return rows.groupBy("row", "col", "class", "season").agg(F.avg(valid(value)).alias("mean"), F.count_distinct("epoch1", "epoch2").alias("pairs")).filter("pairs > 1")


def multilook(pixels: DataFrame, looks: int, rows: int | None, cols: int, by: list[str], mag: str = "mag", pha: str = "pha", coh: str = "coh", also: tuple[Column, ...] = ()) -> DataFrame:
    """Complex mean of looks x looks cells: phase, mean coherence, valid count; partial cells at the end are trimmed, and a cell with
    fewer than four fifths valid is masked. ``also`` are further aggregates, such as the maximum of a mask or the mean height. Without a
    number of rows the grid ends at its largest row."""
    keep = F.col("col") < cols - cols % looks
    if rows is None:
        size = F.broadcast(pixels.agg((F.max("row") + 1).alias("__rows")))  # one row
        pixels = pixels.join(size, F.col("row") < F.col("__rows") - F.col("__rows") % looks)
    else:
        keep = keep & (F.col("row") < rows - rows % looks)
    ok = F.col(pha).isNotNull() & valid(coh).isNotNull()
    re, im = (F.when(ok, F.col(mag) * f(F.col(pha))) for f in (F.cos, F.sin))
    cells = pixels.filter(keep).groupBy(*by, F.floor(F.col("row") / looks).alias("row"), F.floor(F.col("col") / looks).alias("col"))
    out = cells.agg(F.avg(re).alias("re"), F.avg(im).alias("im"), F.avg(F.when(ok, F.col(coh))).alias("coh"), F.count_if(ok).alias("n"), *also)
    return out.withColumns({"pha": F.when(F.col("n") >= looks * looks * 0.8, F.atan2("im", "re")), "masked": F.col("n") < looks * looks * 0.8})


def pair_coherence(first: DataFrame, second: DataFrame, looks: int) -> DataFrame:
    """Interferogram phase and coherence abs(sum s1 conj(s2)) / sum abs(s1 conj(s2)) from scenes (row, col, re, im)."""
    a = first.join(second.withColumnsRenamed({"re": "re2", "im": "im2"}), CELL)
    re, im = F.col("re") * F.col("re2") + F.col("im") * F.col("im2"), F.col("im") * F.col("re2") - F.col("re") * F.col("im2")
    s = a.groupBy(F.floor(F.col("row") / looks).alias("row"), F.floor(F.col("col") / looks).alias("col")).agg(F.sum(re).alias("re"), F.sum(im).alias("im"), F.sum(F.hypot(re, im)).alias("power"))
    return s.select("row", "col", F.atan2("im", "re").alias("pha"), (F.hypot("re", "im") / F.nullif("power", F.lit(0.0))).alias("coh"))


def pair_quality(pixels: DataFrame, by: list[str], unw: str, coh: str) -> DataFrame:
    """Shares of pixels with data and unwrapped, and coherence statistics with zeros counted and the population deviation."""
    return pixels.groupBy(*by).agg(
        (F.count_if(F.abs(coh) > 0) / F.count("*")).alias("with_data"), (F.count_if(F.abs(unw) > 0) / F.count("*")).alias("unwrapped"),
        F.avg(coh).alias("mean"), F.stddev_pop(coh).alias("std"), F.min(coh).alias("min"), F.max(coh).alias("max"),
    )


def bad_pairs(quality: DataFrame, frame: str, share: float) -> DataFrame:
    """Flags pairs whose mean coherence or unwrapped share is below a share of the frame's best."""
    best = lambda c: F.max(c).over(Window.partitionBy(frame))
    return quality.withColumn("bad", (F.col("mean") < share * best("mean")) | (F.col("unwrapped") < share * best("unwrapped")))


def grid_points(points: DataFrame, step: float) -> DataFrame:
    """Point series (lon, lat, epoch, value) -> cell medians per epoch, relative to each cell's first epoch."""
    cell = points.groupBy((F.floor(F.col("lon") / step) * step).alias("lon"), (F.floor(F.col("lat") / step) * step).alias("lat"), "epoch").agg(F.median("value").alias("value"))
    first = F.first_value("value").over(Window.partitionBy("lon", "lat").orderBy("epoch"))
    return cell.withColumn("value", F.col("value") - first)


def remove_median(pixels: DataFrame, by: list[str], value: str, most: int = MOST) -> DataFrame:
    """Subtracts each grid's median. Medians are selected first, in jobs of their own."""
    m = medians(pixels, by, valid(value), most).withColumnRenamed("median", "__m")
    return with_groups(pixels, m, by).withColumn(value, F.col(value) - F.col("__m")).drop("__m")


def overlap_offsets(pixels: DataFrame, most: int = MOST) -> DataFrame:
    """pixels (place, row, col, value): offsets that chain neighbouring grids by the median difference in their overlap."""
    nxt = pixels.select((F.col("place") - 1).alias("place"), *CELL, F.col("value").alias("value2"))
    both = pixels.join(nxt, ["place", *CELL]).filter(valid("value").isNotNull() & valid("value2").isNotNull()).select((F.col("place") + 1).alias("place"), "value", "value2")
    d = medians(both, ["place"], F.col("value") - F.col("value2"), most).withColumnRenamed("median", "step")
    places = pixels.select("place").distinct().join(d, "place", "left")
    # a row for each grid of the chain
    return places.withColumn("offset", F.sum(F.coalesce("step", F.lit(0.0))).over(Window.partitionBy(F.lit(0)).orderBy("place"))).select("place", "offset")


def grow_mosaic(grids: DataFrame, places: list[int], tile: int = 1024, most: int = MOST) -> DataFrame:
    """grids (place, row, col, value) laid one over the other in the order of ``places``: each is shifted by the median difference between the
    mosaic so far and itself where both are valid (not at all without an overlap), and then covers it. (row, col, value, place).

    The mosaic is tiles of ``tile`` x ``tile`` pixels. A round, one for each grid, reads the tiles that the grid touches and writes them anew, in the
    shared folder; the others stay where they are. The driver keeps which round has each tile.
    """
    key = F.concat_ws("_", F.floor(F.col("row") / tile), F.floor(F.col("col") / tile))
    rounds: list[DataFrame] = []
    last: dict[str, int] = {}  # a tile's newest round

    def current(tiles: list[str]) -> DataFrame | None:
        """The mosaic's pixels in these tiles."""
        of: dict[int, list[str]] = {}
        for t in tiles:
            if t in last:
                of.setdefault(last[t], []).append(t)
        return reduce(DataFrame.unionByName, [rounds[r].filter(F.col("tile").isin(names)) for r, names in of.items()]) if of else None

    for place in places:
        own = grids.filter(F.col("place") == place).select(*CELL, valid("value").alias("value")).filter("value is not null")
        own = written(own.withColumn("tile", key))
        tiles = [r.tile for r in own.select("tile").distinct().collect()]
        now = current(tiles)
        if now is None:
            new = own.withColumn("place", F.lit(place))
        else:
            both = own.join(now.select(*CELL, "tile", F.col("value").alias("old"), F.col("place").alias("old_place")), [*CELL, "tile"], "full")
            both = written(both)
            shift = medians(both, [], F.col("old") - F.col("value"), most).select(F.coalesce("median", F.lit(0.0)).alias("shift")).first()
            value = F.col("value") + F.lit(shift[0] if shift else 0.0)
            new = both.select(*CELL, "tile", F.coalesce(value, "old").alias("value"), F.when(F.col("value").isNotNull(), F.lit(place)).otherwise(F.col("old_place")).alias("place"))
        rounds.append(written(new.select(*CELL, "value", "place", "tile"), by=("tile",)))
        last |= dict.fromkeys(tiles, len(rounds) - 1)
    return current(list(last)).drop("tile") if last else grids.select(*CELL, "value", "place").limit(0)


def height_correction(pixels: DataFrame, by: list[str], block: int, least: float = 0.001, min_height: float = 200.0, min_coh: float = 0.4, coh: str | None = None) -> DataFrame:
    """Per frame: the median of its blocks' robust slopes of phase on height, the phase's deviation before and after taking it away (wrapped), and
    whether the correction is kept. Blocks see the pixels above ``min_height`` and, where ``coh`` names a smoothed coherence, above ``min_coh``. The correction
    is dropped below ``least`` radians a metre, and where the deviation doesn't fall."""
    seen = F.col("hgt") > min_height
    seen = seen & (F.col(coh) > min_coh) if coh else seen
    slope = height_correlation(pixels.filter(seen), by, block, robust=True).groupBy(*by).agg(F.median("slope").alias("slope"))
    after = wrap(F.col("pha") - F.col("slope") * F.col("hgt"))
    s = with_groups(pixels, slope, by).groupBy(*by, "slope").agg(F.stddev_pop("pha").alias("std_before"), F.stddev_pop(after).alias("std_after"))
    return s.withColumn("kept", (F.abs("slope") >= least) & (F.col("std_after") < F.col("std_before")))


def height_corrected(pixels: DataFrame, by: list[str], block: int, **masks) -> DataFrame:
    """``pixels`` with the kept corrections taken from ``pha``."""
    kept = height_correction(pixels, by, block, **masks).filter("kept").select(*by, F.col("slope").alias("__slope"))
    return pixels.join(kept, by, "left").withColumn("pha", F.when(F.col("__slope").isNotNull(), wrap(F.col("pha") - F.col("__slope") * F.col("hgt"))).otherwise(F.col("pha"))).drop("__slope")


def correlation(x: str, y: str) -> Column:
    """Correlation of the rows that have both; NaN where either doesn't vary, for which F.corr fails by a division by zero."""
    x_, y_ = F.when(F.col(y).isNotNull(), F.col(x)), F.when(F.col(x).isNotNull(), F.col(y))
    spread = F.stddev_pop(x_) * F.stddev_pop(y_)
    return F.when(spread != 0, F.covar_pop(x, y) / spread).when(spread == 0, F.lit(float("nan")))


def height_correlation(pixels: DataFrame, by: list[str], block: int, min_r: float = 0.3, min_relief: float = 100.0, robust: bool = False) -> DataFrame:
    """Slope of phase on height in each block that is correlated and steep enough, by least squares or by a fit that outliers don't draw; the frame's
    value is their median. A steep block whose phase doesn't vary has no correlation (NaN) and takes part, with slope 0."""
    key = [*by, "brow", "bcol"]
    rows = pixels.withColumns({"brow": F.floor(F.col("row") / block), "bcol": F.floor(F.col("col") / block)})
    s = rows.groupBy(*key).agg(correlation("hgt", "pha").alias("r"), F.regr_slope("pha", "hgt").alias("slope"), (F.max("hgt") - F.min("hgt")).alias("relief"))
    s = s.filter((F.abs("r") > min_r) & (F.col("relief") >= min_relief))
    if not robust:
        return s
    # only such blocks are fitted; the join's shuffle by block serves all rounds of the fit
    fitted = huber_slope(rows.join(s.select(*key), key, "left_semi"), key, "hgt", "pha").select(*key, "slope")
    return s.drop("slope").join(fitted, key)


def correction_benefit(pixels: DataFrame, by: list[str], before: str, after: str) -> DataFrame:
    s = pixels.groupBy(*by).agg(F.stddev_pop(before).alias("std_before"), F.stddev_pop(after).alias("std_after"))
    return s.withColumn("reduction", 100 * (1 - F.col("std_after") / F.nullif("std_before", F.lit(0.0))))


def normalise(pixels: DataFrame, by: list[str], value: str, low: float, high: float) -> DataFrame:
    """Scale to [low, high] per group, with the scale and offset used."""
    s = pixels.groupBy(*by).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    scale = (high - low) / F.nullif(F.col("__hi") - F.col("__lo"), F.lit(0.0))
    return pixels.join(s, by).withColumns({"scale": scale, "offset": low - F.col("__lo") * scale}).withColumn("norm", F.col(value) * F.col("scale") + F.col("offset")).drop("__lo", "__hi")


def correct_pairs(pixels: DataFrame, correction: DataFrame, sign: int = 1, wrapped: bool = False) -> DataFrame:
    """pixels (epoch1, epoch2, row, col, pha) minus the difference of an epoch correction (epoch, row, col, value); both epochs are required."""
    out = pixels
    for i in (1, 2):
        out = out.join(correction.select(F.col("epoch").alias(f"epoch{i}"), *CELL, F.col("value").alias(f"__c{i}")), [f"epoch{i}", *CELL])
    new = F.col("pha") - sign * (F.col("__c2") - F.col("__c1"))
    return out.withColumn("pha", wrap(new) if wrapped else new).drop("__c1", "__c2")


def exact_mean(value: str) -> Column:
    """Mean of doubles below 10 ** 20 that rows give alike in any order: a sum of decimals, freed from what doubles leave below the 13th digit."""
    return F.avg(F.col(value).cast("decimal(38,18)")).cast("decimal(38,13)").cast("double")


def fill_from(first: DataFrame, second: DataFrame, on: list[str], value: str) -> DataFrame:
    """Values of ``first``, else of ``second``; 0 counts as missing."""
    s = second.select(*on, F.col(value).alias("__second"))
    return first.join(s, on, "full").select(*on, F.coalesce(valid(value), valid("__second")).alias(value))


def kernel_sums(pixels: DataFrame, by: list[str], sums: dict[str, Column], weights: list[float]) -> DataFrame:
    """(by, row, col, ...) of every place that a pixel reaches: each of ``sums`` added up with weights[i] weights[j] over the box about it.

    The box is gone through one dimension at a time, so a pixel is sent to 2 len(weights) places, and all sums go together.
    """
    h, names = len(weights) // 2, list(sums)
    reach = F.explode(F.array(*[F.struct(F.lit(i - h).alias("d"), F.lit(float(w)).alias("w")) for i, w in enumerate(weights)])).alias("__o")
    out = pixels.select(*by, *CELL, *[c.alias(n) for n, c in sums.items()])
    for axis in ("col", "row"):
        sent = out.select("*", reach).withColumn(axis, F.col(axis) + F.col("__o.d"))
        out = sent.groupBy(*by, *CELL).agg(*[F.sum(F.col("__o.w") * F.col(n)).alias(n) for n in names])
    return out


def gauss(sigma: float, radius: int) -> list[float]:
    from math import exp

    return [exp(-(d * d) / (2 * sigma * sigma)) for d in range(-radius, radius + 1)]


def moving(pixels: DataFrame, by: list[str], value: str, how: str, k: int, block: int = 128) -> DataFrame:
    """Median, mode (the lowest of equals), mean or population variance, and the number of values, over a k x k box, at the places that have a pixel."""
    if how in ("median", "mode"):
        return block_filter(pixels, by, value, [k // 2] * (k // 2 * 2 + 1), block, getattr(sliding, how), how)
    v, one = F.col(value).cast("double"), F.col(value).isNotNull().cast("long")
    seen = kernel_sums(pixels, by, {"s": F.coalesce(v, F.lit(0.0)), "q": F.coalesce(v * v, F.lit(0.0)), "n": one}, [1.0] * (k // 2 * 2 + 1))
    mean = F.col("s") / F.nullif("n", F.lit(0.0))
    out = mean if how == "mean" else F.greatest(F.col("q") / F.nullif("n", F.lit(0.0)) - mean * mean, F.lit(0.0))
    return seen.select(*by, *CELL, out.alias(how), F.col("n").cast("long").alias("n")).join(pixels.select(*by, *CELL), [*by, *CELL], "left_semi")


def phase_variance_coherence(pixels: DataFrame, by: list[str], pha: str, k: int) -> DataFrame:
    """Coherence from the variance of unit phasors in a box: as they have length 1, that is 1 less the square of their mean's."""
    p = pixels.select(*by, *CELL, pha).filter(F.col(pha).isNotNull())
    seen = kernel_sums(p, by, {"c": F.cos(pha), "s": F.sin(pha), "n": F.lit(1.0)}, [1.0] * (k // 2 * 2 + 1)).join(pixels.select(*by, *CELL), [*by, *CELL], "left_semi")
    return seen.select(*by, *CELL, (1 - F.pow(F.hypot("c", "s") / F.col("n"), 2)).alias("var")).withColumn("coh", F.sqrt(F.greatest(1 - F.col("var"), F.lit(0.0))))


def gauss_smooth(pixels: DataFrame, by: list[str], value: str, sigma: float, radius: int) -> DataFrame:
    """Weighted mean of the valid pixels within reach, at the pixels that are valid; no-data spreads nowhere."""
    ok = pixels.filter(valid(value).isNotNull()).select(*by, *CELL, value)
    seen = kernel_sums(ok, by, {"s": F.col(value), "w": F.lit(1.0)}, gauss(sigma, radius))
    return seen.select(*by, *CELL, (F.col("s") / F.col("w")).alias("smooth")).join(ok, [*by, *CELL], "left_semi")


def gauss_phase(pixels: DataFrame, by: list[str], pha: str, sigma: float, radius: int) -> DataFrame:
    """gauss_pha and gauss_coh of unit phasors smoothed so that intensity is conserved: what a pixel's kernel would spread over no-data, or
    beyond the grid, stays on the pixel itself."""
    reach = gauss(sigma, radius)
    total = sum(reach) ** 2
    ok = pixels.filter(F.col(pha).isNotNull()).select(*by, *CELL, F.cos(pha).alias("re"), F.sin(pha).alias("im"))
    j = ok.join(kernel_sums(ok, by, {"s_re": F.col("re"), "s_im": F.col("im"), "w": F.lit(1.0)}, reach), [*by, *CELL])
    re, im = (F.col(f"s_{c}") / total + (1 - F.col("w") / total) * F.col(c) for c in ("re", "im"))
    return j.select(*by, *CELL, F.atan2(im, re).alias("gauss_pha"), F.hypot(re, im).alias("gauss_coh"))


def fill_gauss(pixels: DataFrame, by: list[str], pha: str, sigma: float = 2.0, radius: int | None = None, rounds: int = 3) -> DataFrame:
    """Runs a job a round while the plan is built: null phases take the angle of the kernel-weighted mean of the valid phasors within ``radius`` (four
    sigma by default), in up to ``rounds`` rounds, each of which sees what the one before filled; what is left then takes the nearest value. Rounds are written."""
    reach = gauss(sigma, int(4 * sigma) if radius is None else radius)
    now = written(pixels.select(*by, *CELL, F.col(pha).alias("p")))
    for _ in range(rounds):
        if not now.filter("p is null").limit(1).count():
            break
        ok = now.filter("p is not null")
        seen = kernel_sums(ok, by, {"re": F.cos("p"), "im": F.sin("p")}, reach).select(*by, *CELL, F.atan2("im", "re").alias("new"))
        # by sorted keys: grids pass as small by the size of their files, and would be broadcast through the driver
        now = written(now.join(seen.hint("merge"), [*by, *CELL], "left").select(*by, *CELL, F.coalesce("p", "new").alias("p")))
    left = bool(now.filter("p is null").limit(1).count())
    full = fill_nearest(now, by, "p") if left else now
    return pixels.drop(pha).join(full.withColumnRenamed("p", pha).hint("merge"), [*by, *CELL])


def despiked(pixels: DataFrame, by: list[str], value: str, k: int, limit: float) -> DataFrame:
    """Moving median, to which residuals of less than ``limit`` are added back: outliers go, detail stays."""
    m = moving(pixels, by, value, "median", k).select(*by, *CELL, "median")
    j = pixels.join(m, [*by, *CELL])
    rest = F.col(value) - F.col("median")
    return j.withColumn("filtered", F.col("median") + F.when(F.abs(rest) < limit, rest).otherwise(0)).drop("median")


def mode_median(pixels: DataFrame, by: list[str], value: str, radius: int, bin_size: float, block: int = 128) -> DataFrame:
    """Median of the values in the fullest histogram bin of a disk and in the bins beside it."""
    reach = [int((radius * radius - r * r) ** 0.5 + 1e-9) for r in range(-radius, radius + 1)]
    return block_filter(pixels, by, value, reach, block, sliding.mode_median(bin_size), "value").drop("n").filter("value is not null")


def block_filter(pixels: DataFrame, by: list[str], value: str, reach: list[int], block: int, how: Callable, name: str) -> DataFrame:
    """(by, row, col, name, n) of sliding histograms: ``reach`` has the half width of each row of the window, ``how`` is one of ``sliding``.

    Blocks come with a halo of half the window; a task holds (block + window)^2 pixels and as many counts for each of the block's rows.
    """
    h = len(reach) // 2
    edge = lambda c: F.explode(F.sequence(F.floor((F.col(c) - h) / block), F.floor((F.col(c) + h) / block)))
    halo = pixels.select(*by, *[F.col(c).cast("long").alias(c) for c in CELL], F.col(value).cast("double").alias("__v")).withColumn("__br", edge("row")).withColumn("__bc", edge("col"))

    def swept(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(pdf["__br"].iloc[0]) * block - h, int(pdf["__bc"].iloc[0]) * block - h
        grid = np.full((block + 2 * h, block + 2 * h), np.nan)
        r, c = pdf["row"].to_numpy() - r0, pdf["col"].to_numpy() - c0
        grid[r, c] = pdf["__v"]
        # no more of the block than it has pixels in
        a, b, left, right = r.min(), r.max() + 1, c.min(), c.max() + 1
        grid = np.pad(grid[a:b, left:right], h, constant_values=np.nan)
        out, many = sliding.sweep(grid, reach, how)
        own = (r >= h) & (r < h + block) & (c >= h) & (c < h + block)
        at = (r[own] - a, c[own] - left)
        return pdf.loc[own, [*by, *CELL]].assign(**{name: out[at], "n": many[at]})

    kinds = "".join(f"{c} {pixels.schema[c].dataType.simpleString()}, " for c in by)
    found = halo.groupBy(*by, "__br", "__bc").applyInPandas(swept, f"{kinds}row long, col long, {name} double, n long")
    return found.withColumn(name, F.nanvl(name, F.lit(None).cast("double")))


def gradient(pixels: DataFrame, by: list[str], value: str) -> DataFrame:
    """Gradient magnitude: central differences, one-sided at edges and beside holes."""
    step = {}
    for axis, other in (("row", "col"), ("col", "row")):
        w = Window.partitionBy(*by, other).orderBy(axis)
        near = lambda f, d: F.when(f(axis).over(w) == F.col(axis) + d, f(value).over(w))  # noqa: E731, B023
        back, ahead = near(F.lag, -1), near(F.lead, 1)
        span = F.when(back.isNotNull() & ahead.isNotNull(), 2.0).when(back.isNotNull() | ahead.isNotNull(), 1.0)
        step[axis] = (F.coalesce(ahead, F.col(value)) - F.coalesce(back, F.col(value))) / span
    return pixels.withColumn("gradient", F.hypot(F.coalesce(step["row"], F.lit(0.0)), F.coalesce(step["col"], F.lit(0.0))))


def residues(pixels: DataFrame, by: list[str], pha: str) -> DataFrame:
    """Loops of 2 x 2 pixels whose wrapped phase steps don't sum to zero: charge -1 or 1 at the upper left pixel."""
    p = pixels.select(*by, *CELL, F.col(pha).alias("p"))
    shifted = lambda dr, dc, name: p.select(*by, (F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"), F.col("p").alias(name))
    loop = p.join(shifted(0, 1, "p2"), [*by, *CELL]).join(shifted(1, 1, "p3"), [*by, *CELL]).join(shifted(1, 0, "p4"), [*by, *CELL])
    total = wrap(F.col("p2") - F.col("p")) + wrap(F.col("p3") - F.col("p2")) + wrap(F.col("p4") - F.col("p3")) + wrap(F.col("p") - F.col("p4"))
    return loop.select(*by, *CELL, F.round(total / (2 * F.pi())).cast("int").alias("charge")).filter("charge != 0")


def _nearest_columns(p: pd.DataFrame) -> np.ndarray:
    """Place in ``p`` (a row's columns in order: col, near, the row distance of the column's nearest value or null, r0) of the value nearest to each.

    The lower envelope of the parabolas near^2 + (x - col)^2, with whole numbers: the last place at which the left one of two is better (or as good
    and smaller in row, then column) follows from their difference, which is linear.
    """
    col, near, r0 = p["col"].tolist(), p["near"].tolist(), p["r0"].tolist()
    stack: list[tuple[int, int]] = []  # (place, first col at which it is best)
    for j in range(len(col)):
        if near[j] != near[j]:
            continue
        start = None
        while stack:
            i, begin = stack[-1]
            # i is at least as good while 2 x (col j - col i) <= up
            up = int(near[j] ** 2 - near[i] ** 2) + col[j] ** 2 - col[i] ** 2
            last, rest = divmod(up, 2 * (col[j] - col[i]))
            if rest == 0 and r0[i] > r0[j]:
                last -= 1
            start = last + 1
            if start > begin:
                break
            stack.pop()
            start = None
        stack.append((j, -(1 << 62) if start is None else start))
    if not stack:
        return np.full(len(col), -1)
    places, begins = np.array(stack, dtype=np.int64).T
    return places[np.searchsorted(begins, np.array(col), "right") - 1]


def fill_nearest(pixels: DataFrame, by: list[str], value: str) -> DataFrame:
    """Null pixels take the nearest valid value; smallest row, then column in a tie.

    An exact distance transform, whatever the width of the holes: windows along the columns give the nearest valid row above and below, for the rows
    that have holes; along each such row the lower envelope of the columns' distances gives the nearest of all. A task holds a row or a
    column of a grid. Groups without a valid value stay empty.
    """
    kind = pixels.schema[value].dataType.simpleString()
    grid = pixels.select(*by, *[F.col(c).cast("long").alias(c) for c in CELL], F.col(value).alias("__v"))
    hole = grid.filter("__v is null").select(*by, *CELL)
    # every column of a grid is asked at each row with a hole, also where it has no pixel
    rows, cols = hole.select(*by, "row").distinct(), grid.filter("__v is not null").select(*by, "col").distinct()
    if not by:
        rows, cols = rows.withColumn("__one", F.lit(1)), cols.withColumn("__one", F.lit(1))
    asked = rows.join(cols, by or ["__one"]).select(*by, *CELL, F.lit(None).cast(kind).alias("__v"), F.lit(True).alias("asked"))
    both = grid.filter("__v is not null").select(*by, *CELL, "__v", F.lit(False).alias("asked")).unionByName(asked)
    here = F.when(F.col("asked"), F.lit(None)).otherwise(F.struct(F.col("row").alias("r"), F.col("__v").alias("v")))
    # a row's value comes before its question in both directions
    along = lambda order: Window.partitionBy(*by, "col").orderBy(order, "asked").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumns({"above": F.last(here, True).over(along(F.col("row"))), "below": F.last(here, True).over(along(F.col("row").desc()))}).filter("asked")
    up, down = F.col("row") - F.col("above.r"), F.col("below.r") - F.col("row")
    best = F.when(F.col("below").isNull() | (up <= down), F.col("above")).otherwise(F.col("below"))
    seen = seen.select(*by, *CELL, best.alias("best")).join(hole.withColumn("__hole", F.lit(True)), [*by, *CELL], "full")
    seen = seen.select(*by, *CELL, F.abs(F.col("best.r") - F.col("row")).alias("near"), F.col("best.r").alias("r0"), F.col("best.v").alias("v"), F.coalesce("__hole", F.lit(False)).alias("hole"))

    def envelope(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("col")
        at = _nearest_columns(p)
        wanted = p["hole"].to_numpy(bool) & (at >= 0)
        return p.loc[wanted, [*by, *CELL]].assign(__fill=p["v"].to_numpy()[at[wanted]])

    kinds = "".join(f"{c} {pixels.schema[c].dataType.simpleString()}, " for c in by)
    found = seen.groupBy(*by, "row").applyInPandas(envelope, f"{kinds}row long, col long, __fill {kind}")
    return pixels.join(found.hint("merge"), [*by, *CELL], "left").withColumn(value, F.coalesce(value, "__fill")).drop("__fill")


def _tile_labels(rows: list[int], cols: list[int]) -> list[tuple[int, int]]:
    """Label of each cell of one tile: the smallest (row, col) of its four-connected part."""
    at = {c: i for i, c in enumerate(zip(rows, cols))}
    parent = list(range(len(rows)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for (r, c), i in at.items():
        for other in ((r - 1, c), (r, c - 1)):
            if (j := at.get(other)) is not None:
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    return [(rows[k], cols[k]) for k in map(root, range(len(rows)))]


def islands(pixels: DataFrame, by: list[str], tile: int = 256, max_rounds: int = 60) -> DataFrame:
    """Connected components (four neighbours) of the pixels given: label and size. Labels are the smallest row and column.

    Tiles are labelled on their own; labels that meet at tile borders are then joined by spreading the smallest one and jumping to
    its own label, on the labels alone. Rounds are written to the shared folder.
    """
    kinds = ", ".join(f"{c} {pixels.schema[c].dataType.simpleString()}" for c in by)
    spots = pixels.select(*by, *[F.col(c).cast("long").alias(c) for c in CELL], F.floor(F.col("row") / tile).alias("__tr"), F.floor(F.col("col") / tile).alias("__tc"))

    def label(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(CELL)
        return p[[*by, *CELL]].assign(**dict(zip(("lr", "lc"), zip(*_tile_labels(p["row"].tolist(), p["col"].tolist())))))

    own = written(spots.groupBy(*by, "__tr", "__tc").applyInPandas(label, (f"{kinds}, " if by else "") + "row long, col long, lr long, lc long"))
    own = own.withColumn("label", F.struct(F.col("lr").alias("row"), F.col("lc").alias("col"))).drop("lr", "lc")
    edge = own.filter((F.pmod("row", F.lit(tile)) == 0) | (F.pmod("col", F.lit(tile)) == 0)).select(*by, *CELL, F.col("label").alias("a"), F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in ((-1, 0), (0, -1))])).alias("o"))
    crossed = ((F.col("o.r") == -1) & (F.pmod("row", F.lit(tile)) == 0)) | ((F.col("o.c") == -1) & (F.pmod("col", F.lit(tile)) == 0))
    edge = edge.filter(crossed).select(*by, (F.col("row") + F.col("o.r")).alias("row"), (F.col("col") + F.col("o.c")).alias("col"), "a")
    links = edge.join(own.select(*by, *CELL, F.col("label").alias("b")), [*by, *CELL]).select(*by, "a", "b").filter("a != b").distinct()
    links = written(links.unionByName(links.select(*by, F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    now = written(links.select(*by, "a", F.col("a").alias("label")).distinct())
    state = None
    for _ in range(max_rounds):
        near = links.join(now.select(*by, F.col("a").alias("b"), F.col("label").alias("other")), [*by, "b"]).groupBy(*by, "a").agg(F.min("other").alias("other"))
        best = now.join(near, [*by, "a"]).select(*by, "a", F.least("label", "other").alias("label"))
        up = now.select(*by, F.col("a").alias("label"), F.col("label").alias("up"))
        now = written(best.join(up, [*by, "label"]).select(*by, "a", F.least("label", "up").alias("label")))
        sums = now.agg(F.sum(F.xxhash64("a", "label").cast("decimal(38,0)"))).first()[0]
        if sums == state:
            break
        state = sums
    else:
        raise RuntimeError("labels did not settle; raise max_rounds")
    joined = own.withColumnRenamed("label", "a").join(now, [*by, "a"], "left").select(*by, *CELL, F.coalesce("label", "a").alias("label"))
    joined = written(joined)
    return joined.join(joined.groupBy(*by, "label").agg(F.count("*").alias("size")), [*by, "label"])


def island_pixels(metres: float, km: float = 7.0) -> int:
    """Pixels of a square of so many kilometres a side."""
    return round(km * 1000 / metres) ** 2


def remove_islands(pixels: DataFrame, by: list[str], value: str, pixels_at_least: int) -> DataFrame:
    """``pixels`` whose value is null on islands of fewer than so many pixels."""
    small = islands(pixels.filter(F.col(value).isNotNull()), by).filter(F.col("size") < pixels_at_least).select(*by, *CELL, F.lit(True).alias("__small"))
    return pixels.join(small, [*by, *CELL], "left").withColumn(value, F.when(F.col("__small").isNull(), F.col(value))).drop("__small")


def resample(coarse: DataFrame, fine: DataFrame, by: list[str], factor: int) -> DataFrame:
    """Values of a coarse grid on the cells of a finer one."""
    c = coarse.withColumnsRenamed({"row": "__r", "col": "__c"})
    return fine.withColumns({"__r": F.floor(F.col("row") / factor), "__c": F.floor(F.col("col") / factor)}).join(c, [*by, "__r", "__c"]).drop("__r", "__c")


def point_series(pixels: DataFrame, points: DataFrame) -> DataFrame:
    """Series of the pixels named by points (point, row, col)."""
    return pixels.join(points, CELL)


