"""Least squares per pixel or frame, as grouped sums of the normal equations and closed-form solutions.

One shuffle with partial sums; nothing leaves code generation except network inversion and surfaces, whose matrices are factored in numpy.
A determinant below ``TINY`` times its scale counts as singular, and the solution is null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fringeline.operators.select import with_groups

TINY = 1e-12


def _det3(m: list[list[Column]]) -> Column:
    return m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])


def fit3(rows: DataFrame, by: list[str], terms: list[Column], value: Column, weight: Column | None = None) -> DataFrame:
    """x0, x1, x2 of a weighted fit on three terms, the count, and the determinant's inverse diagonal v0, v1, v2."""
    w = F.lit(1.0) if weight is None else weight
    ok = value.isNotNull() & terms[0].isNotNull() & terms[1].isNotNull() & terms[2].isNotNull()
    sums = {f"a{i}{j}": F.sum(F.when(ok, w * terms[i] * terms[j])) for i in range(3) for j in range(i, 3)} | {f"b{i}": F.sum(F.when(ok, w * terms[i] * value)) for i in range(3)}
    s = rows.groupBy(*by).agg(*[e.alias(n) for n, e in sums.items()], F.count_if(ok).alias("n"))
    a = [[F.col(f"a{min(i, j)}{max(i, j)}") for j in range(3)] for i in range(3)]
    det = _det3(a)
    scale = F.col("a00") * F.col("a11") * F.col("a22")
    good = F.abs(det) > TINY * scale
    out = {}
    for k in range(3):
        m = [[F.col(f"b{i}") if j == k else a[i][j] for j in range(3)] for i in range(3)]
        p, q = [i for i in range(3) if i != k]
        out[f"x{k}"] = F.when(good, _det3(m) / det)
        out[f"v{k}"] = F.when(good, (a[p][p] * a[q][q] - a[p][q] * a[q][p]) / det)
    return s.select(*by, *[e.alias(n) for n, e in out.items()], "n")


def fit2(rows: DataFrame, by: list[str], terms: list[Column], value: Column, weight: Column | None = None) -> DataFrame:
    """x0, x1 and the inverse diagonal v0, v1 of a weighted fit on two terms."""
    w = F.lit(1.0) if weight is None else weight
    ok = value.isNotNull()
    s = rows.groupBy(*by).agg(
        *[F.sum(F.when(ok, w * terms[i] * terms[j])).alias(f"a{i}{j}") for i, j in ((0, 0), (0, 1), (1, 1))], *[F.sum(F.when(ok, w * terms[i] * value)).alias(f"b{i}") for i in (0, 1)], F.count_if(ok).alias("n")
    )
    a, b, c = F.col("a00"), F.col("a01"), F.col("a11")
    det = a * c - b * b
    good = F.abs(det) > TINY * a * c
    return s.select(*by, F.when(good, (F.col("b0") * c - F.col("b1") * b) / det).alias("x0"), F.when(good, (F.col("b1") * a - F.col("b0") * b) / det).alias("x1"), F.when(good, c / det).alias("v0"), F.when(good, a / det).alias("v1"), "n")


def up_east(look: DataFrame, by: list[str], frames: int, value: str = "vel", std: str | None = None) -> DataFrame:
    """Up and east from ``frames`` look directions (inc, heading in degrees), with 1-sigma; null if a frame is missing."""
    i, h = F.radians("inc"), F.radians("heading")
    weight = None if std is None else 1 / (F.col(std) * F.col(std))
    s = fit2(look, by, [F.cos(i), -F.sin(i) * F.cos(h)], F.col(value), weight)
    full = F.col("n") >= frames
    return s.select(*by, F.when(full, F.col("x0")).alias("up"), F.when(full, F.col("x1")).alias("east"), F.when(full, F.sqrt("v0")).alias("up_std"), F.when(full, F.sqrt("v1")).alias("east_std"), "n")


def up_east_north(look: DataFrame, by: list[str], frames: int, value: str = "vel", std: str | None = None) -> DataFrame:
    """Up, east and north from three looks or more."""
    i, h = F.radians("inc"), F.radians("heading")
    weight = None if std is None else 1 / (F.col(std) * F.col(std))
    s = fit3(look, by, [F.cos(i), -F.sin(i) * F.cos(h), F.sin(i) * F.sin(h)], F.col(value), weight)
    full = F.col("n") >= frames
    return s.select(*by, *[F.when(full, F.col(f"x{k}")).alias(n) for k, n in enumerate(("up", "east", "north"))], *[F.when(full, F.sqrt(f"v{k}")).alias(f"{n}_std") for k, n in enumerate(("up", "east", "north"))], "n")


def deramp(pixels: DataFrame, by: list[str], value: str) -> DataFrame:
    """Subtract the plane fitted to each grid."""
    r, c = F.col("row").cast("double"), F.col("col").cast("double")
    plane = fit3(pixels, by, [F.lit(1.0), r, c], F.col(value)).select(*by, "x0", "x1", "x2")
    return pixels.join(plane, by).withColumn("deramped", F.col(value) - (F.col("x0") + F.col("x1") * r + F.col("x2") * c)).drop("x0", "x1", "x2")


def surface_terms(degree: int, x: Column, y: Column) -> list[Column]:
    return [F.pow(x, F.lit(i)) * F.pow(y, F.lit(j)) for i in range(degree + 1) for j in range(degree + 1 - i)]


#: Slots in which a group's triangles meet first; the slots' own then meet in one task, a triangle of terms each.
SLOTS = 256


def stable_fit(rows: DataFrame, by: list[str], terms: list[Column], value: Column) -> DataFrame:
    """(by, coef): least squares on the terms by QR, without normal equations, so that half the digits aren't lost on raw powers.

    Each partition turns its rows into one triangle R of (terms, value) for a group, batch by batch; triangles are stacked and factored again in
    ``SLOTS`` slots, and theirs once more. Rows with a null value or term take no part; a group whose terms depend on one another gets the solution of least norm.
    """
    n = len(terms) + 1
    kinds = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in by)
    ok = value.isNotNull()
    for t in terms:
        ok = ok & t.isNotNull()
    flat = rows.filter(ok).select(*by, F.array(*[t.cast("double") for t in terms], value.cast("double")).alias("__r"))

    def triangle(parts: list[np.ndarray]) -> np.ndarray:
        r = np.linalg.qr(np.concatenate(parts), mode="r")
        return np.concatenate((r, np.zeros((n - len(r), n)))) if len(r) < n else r

    def first(batches):
        held: dict[tuple, np.ndarray] = {}
        slot = TaskContext.get().partitionId() % SLOTS

        def out() -> pd.DataFrame:
            frame = pd.DataFrame([(*k, slot, r.ravel().tolist()) for k, r in held.items()], columns=[*by, "__slot", "__r"])
            held.clear()
            return frame

        for p in batches:
            a = np.stack(p["__r"].to_numpy()) if len(p) else np.zeros((0, n))
            groups = p.groupby(by, sort=False, dropna=False).indices if by else {(): np.arange(len(p))}
            for k, at in groups.items():
                k = k if isinstance(k, tuple) else (k,)
                held[k] = triangle(([held[k]] if k in held else []) + [a[at]])
            if len(held) > 10_000:
                yield out()
        if held:
            yield out()

    def merged(p: pd.DataFrame) -> pd.DataFrame:
        r = triangle([np.reshape(x, (n, n)) for x in p["__r"]])
        return p.iloc[:1].assign(__r=[r.ravel().tolist()])

    def solved(p: pd.DataFrame) -> pd.DataFrame:
        r = np.reshape(merged(p)["__r"].iloc[0], (n, n))
        coef = np.linalg.lstsq(r[:, :-1], r[:, -1], rcond=None)[0]
        return p.iloc[:1][by].assign(coef=[coef.tolist()])

    triangles = flat.mapInPandas(first, f"{kinds}__slot int, __r array<double>")
    triangles = triangles.groupBy(*by, "__slot").applyInPandas(merged, f"{kinds}__slot int, __r array<double>")
    return triangles.groupBy(*by).applyInPandas(solved, f"{kinds}coef array<double>")


def surface_deramp(pixels: DataFrame, by: list[str], value: str, degree: int, scale: float) -> DataFrame:
    """Subtract a surface of the given degree from each grid."""
    t = surface_terms(degree, F.col("row") / scale, F.col("col") / scale)
    solved = stable_fit(pixels, by, t, F.col(value)).withColumnRenamed("coef", "__coef")
    surface = sum((F.get("__coef", F.lit(k)) * t[k] for k in range(1, len(t))), F.get("__coef", F.lit(0)) * t[0])
    return with_groups(pixels, solved, by).withColumn("deramped", F.col(value) - surface).drop("__coef")


def velocity(series: DataFrame, by: list[str], value: str) -> DataFrame:
    """Slope per year, and intercept, of a series on its epoch."""
    years = F.datediff("epoch", F.lit("2000-01-01").cast("date")) / 365.25
    return series.groupBy(*by).agg(F.regr_slope(value, years).alias("vel"), F.regr_intercept(value, years).alias("intercept"), F.count(value).alias("n"))


def annual_velocity(series: DataFrame, by: list[str], frame: str, value: str, buffer_days: int = 0) -> DataFrame:
    """Velocity in each calendar year that all frames have, optionally with days of the years beside it."""
    frames = series.agg(F.count_distinct(frame).alias("__frames"))
    years = series.select(frame, F.year("epoch").alias("year")).distinct().groupBy("year").agg(F.count("*").alias("__n")).crossJoin(F.broadcast(frames)).filter("__n = __frames").select("year")
    near = F.explode(F.array_distinct(F.array(F.year(F.date_sub("epoch", buffer_days)), F.year("epoch"), F.year(F.date_add("epoch", buffer_days)))))
    return velocity(series.withColumn("year", near).join(years, "year", "left_semi"), [*by, frame, "year"], value)


def period_velocity(series: DataFrame, periods: DataFrame, by: list[str], value: str) -> DataFrame:
    """Velocity in each period (period, start, stop). The month is the equi key; a period is listed under each of its months."""
    month = F.trunc("epoch", "month")
    p = periods.withColumn("__m", F.explode(F.sequence(F.trunc("start", "month"), F.trunc("stop", "month"), F.expr("interval 1 month"))))
    rows = series.withColumn("__m", month).join(p, "__m").filter(F.col("epoch").between(F.col("start"), F.col("stop")))
    return velocity(rows, [*by, "period"], value)


def dilution(look: DataFrame, by: list[str]) -> DataFrame:
    """Dilution of precision of up, east and north from the looks at a point."""
    i, h = F.radians("inc"), F.radians("heading")
    s = fit3(look, by, [F.cos(i), -F.sin(i) * F.cos(h), F.sin(i) * F.sin(h)], F.lit(1.0))
    return s.select(*by, *[F.sqrt(f"v{k}").alias(n) for k, n in enumerate(("up_dop", "east_dop", "north_dop"))], "n")


def seasonal(series: DataFrame, by: list[str], value: str, std: str | None = None) -> DataFrame:
    """Constant, rate, sine and cosine by weighted least squares; 4 x 4 systems are solved from one row of sums for each group. Time is counted from the
    middle of all epochs in the sums, which keeps them well conditioned, and from 2000 in the result."""
    t = F.datediff("epoch", F.lit("2000-01-01").cast("date")) / 365.25
    middle = F.broadcast(series.agg(F.coalesce(F.avg(t), F.lit(0.0)).alias("__t0")))  # one row
    series = series.crossJoin(middle)
    g = [F.lit(1.0), t - F.col("__t0"), F.sin(2 * F.pi() * t), F.cos(2 * F.pi() * t)]
    w = F.lit(1.0) if std is None else 1 / (F.col(std) * F.col(std))
    pick = [(i, j) for i in range(4) for j in range(i, 4)]
    ok = F.col(value).isNotNull() & w.isNotNull()
    s = series.filter(ok).groupBy(*by).agg(*[F.sum(w * g[i] * g[j]).alias(f"a{i}{j}") for i, j in pick], *[F.sum(w * g[i] * F.col(value)).alias(f"b{i}") for i in range(4)], F.first("__t0").alias("__t0"))

    def solve(batches):
        for p in batches:
            a, b = np.zeros((len(p), 4, 4)), np.stack([p[f"b{i}"].to_numpy(float) for i in range(4)], axis=1)
            for i, j in pick:
                a[:, i, j] = a[:, j, i] = p[f"a{i}{j}"].to_numpy(float)
            x = np.full((len(p), 4), np.nan)
            good = np.isfinite(a).all(axis=(1, 2)) & (np.linalg.cond(np.nan_to_num(a)) < 1e12)
            if good.any():
                x[good] = np.linalg.solve(a[good], b[good][..., None])[..., 0]
            x[:, 0] -= x[:, 1] * p["__t0"].to_numpy(float)
            yield pd.concat([p[by].reset_index(drop=True), pd.DataFrame(x, columns=["const", "rate", "sin", "cos"])], axis=1)

    kinds = ", ".join(f"{c} {series.schema[c].dataType.simpleString()}" for c in by)
    return s.mapInPandas(solve, f"{kinds}, const double, rate double, sin double, cos double")


def _without(a: np.ndarray, inverse: np.ndarray, x: np.ndarray, rest: np.ndarray, dropped: np.ndarray) -> np.ndarray:
    """Solutions of pixels (columns of ``x``) without their dropped pairs, by downdates of the common solution; NaN where the rest ties no longer all.

    ``rest`` holds the residuals, ``dropped`` (pairs, pixels) the pairs left out. Pixels that drop equally many are solved together.
    """
    out = x.copy()
    many = dropped.sum(axis=0)
    for k in np.unique(many[many > 0]).tolist():
        own = np.flatnonzero(many == k)
        pairs = np.nonzero(dropped[:, own].T)[1].reshape(len(own), k)
        rows = a[pairs]  # pixels, dropped pairs, unknowns
        back = rows @ inverse
        left = np.eye(k) - back @ rows.transpose(0, 2, 1)
        sound = np.linalg.eigvalsh(left)[:, 0] > 1e-9
        r = rest[pairs, own[:, None]]
        step = np.full((len(own), a.shape[1]), np.nan)
        if sound.any():
            step[sound] = (back[sound].transpose(0, 2, 1) @ np.linalg.solve(left[sound], r[sound][..., None]))[..., 0]
        out[:, own] = x[:, own] - step.T
    return out


def invert_network(pairs: DataFrame, by: list[str], outlier: float = 0.8 * np.pi, blocks: int | None = None) -> DataFrame:
    """pairs (by, epoch1, epoch2, value) -> (by, epoch, value): series from a network by least squares, first epoch 0.

    Pairs whose residual exceeds ``outlier`` are dropped and the rest is solved again; epochs that the network doesn't tie are null. A pixel's
    pairs become one row, and the epochs of its pairs that have a value one number, the network. Pixels are dealt to ``blocks`` by hash (by default
    16 for each shuffle partition); in a block each network is factored once and solves all its pixels together, as columns; dropped pairs are taken
    out of the common solution.
    """
    kinds = "".join(f"{c} {pairs.schema[c].dataType.simpleString()}, " for c in by)
    blocks = blocks or 16 * int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    day = lambda c: F.unix_date(F.col(c))
    found = F.nanvl(F.col("value").cast("double"), F.lit(None).cast("double"))
    rows = pairs.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(day("epoch1").alias("a"), day("epoch2").alias("b"), found.alias("v")))).alias("__p"))
    net = F.transform("__p", lambda p: F.struct(p["a"], p["b"], p["v"].isNotNull()))
    rows = rows.select(*by, F.transform("__p", lambda p: p["a"]).alias("__a"), F.transform("__p", lambda p: p["b"]).alias("__b"), F.transform("__p", lambda p: F.coalesce(p["v"], F.lit(0.0))).alias("__v"), F.transform("__p", lambda p: p["v"].isNotNull()).alias("__k"), F.xxhash64(net).alias("__net"), F.pmod(F.xxhash64(*by), F.lit(blocks)).cast("int").alias("__block"))

    def solved(one: np.ndarray, two: np.ndarray, keep: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Epochs of one network, and the series (pixels, epochs) of its pixels' values (pixels, pairs)."""
        epochs, at = np.unique(np.concatenate((one, two)), return_inverse=True)
        a = np.zeros((len(one), len(epochs)))
        a[np.arange(len(one)), at[len(one) :]] += 1
        a[np.arange(len(one)), at[: len(one)]] -= 1
        a, d = a[keep, 1:], d[:, keep].T
        x = np.full((len(epochs), d.shape[1]), np.nan)
        if len(a) >= a.shape[1]:
            q, r = np.linalg.qr(a)
            # entries are 0, 1 and -1: a network that leaves an epoch untied has a pivot of rounding size
            if np.abs(np.diag(r)).min(initial=1.0) > 1e-9:
                inverse = np.linalg.inv(r)
                sol = inverse @ (q.T @ d)
                rest = d - a @ sol
                dropped = np.abs(rest) > outlier
                x[0], x[1:] = 0.0, _without(a, inverse @ inverse.T, sol, rest, dropped) if dropped.any() else sol
        return epochs, x.T

    def invert(p: pd.DataFrame) -> pd.DataFrame:
        one, two, keep, value = (p[c].to_numpy() for c in ("__a", "__b", "__k", "__v"))
        order, epochs, series = [], [], []
        for at in p.groupby("__net", sort=False).indices.values():
            e, x = solved(one[at[0]], two[at[0]], keep[at[0]].astype(bool), np.stack(value[at]))
            order.append(at)
            epochs += [e] * len(at)
            series += list(x)
        return p[by].iloc[np.concatenate(order)].assign(__e=epochs, __x=series)

    out = rows.groupBy("__block").applyInPandas(invert, f"{kinds}__e array<int>, __x array<double>")
    out = out.select(*by, F.inline(F.arrays_zip(F.col("__e").alias("e"), F.col("__x").alias("x"))))
    return out.select(*by, F.date_from_unix_date("e").alias("epoch"), F.nanvl("x", F.lit(None).cast("double")).alias("value"))


def huber_slope(pixels: DataFrame, by: list[str], x: str, y: str, delta: float = 1.345, rounds: int = 12) -> DataFrame:
    """(by, slope, intercept, n): robust line of each block by reweighted least squares; null where x doesn't vary. Blocks are bounded by the caller's keys.

    A round is two windows over the blocks, the weighted sums and the median of the residuals that scales the next weights; all rounds share the
    one shuffle by block.
    """
    w, own = Window.partitionBy(*by), F.col
    rows = pixels.select(*by, own(x).cast("double").alias("__x"), own(y).cast("double").alias("__y")).filter("__x is not null and __y is not null")
    # about the means, so that sums of squares keep their digits
    rows = rows.withColumns({"__mx": F.avg("__x").over(w), "__my": F.avg("__y").over(w)})
    rows = rows.select(*by, "__mx", "__my", (own("__x") - own("__mx")).alias("__x"), (own("__y") - own("__my")).alias("__y"), F.lit(1.0).alias("__w"))
    for i in range(rounds):
        total = lambda e: F.sum(own("__w") * e).over(w)
        rows = rows.withColumns({"__s": F.sum("__w").over(w), "__sx": total(own("__x")), "__sy": total(own("__y")), "__xx": total(own("__x") * own("__x")), "__xy": total(own("__x") * own("__y"))})
        det = own("__s") * own("__xx") - own("__sx") * own("__sx")
        slope = F.when(det > TINY * own("__s") * own("__xx"), (own("__s") * own("__xy") - own("__sx") * own("__sy")) / det)
        rows = rows.select(*by, "__mx", "__my", "__x", "__y", "__s", "__sx", "__sy", slope.alias("slope"))
        rows = rows.withColumn("__c", (own("__sy") - own("slope") * own("__sx")) / own("__s"))
        if i + 1 < rounds:
            rows = rows.withColumn("__r", F.abs(own("__y") - own("__c") - own("slope") * own("__x")))
            rows = rows.withColumn("__m", F.median("__r").over(w) / 0.6745)
            scale = F.when(own("__m") > 0, own("__m")).otherwise(F.lit(1.0))
            rows = rows.select(*by, "__mx", "__my", "__x", "__y", F.least(F.lit(1.0), delta * scale / F.greatest("__r", F.lit(1e-12))).alias("__w"))
    return rows.groupBy(*by).agg(F.first("slope").alias("slope"), F.first(own("__my") + own("__c") - own("slope") * own("__mx")).alias("intercept"), F.count("*").alias("n"))
