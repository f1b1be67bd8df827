"""Stable and robust fits, and networks with dropped pairs, against numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeline.operators import lsq as L
from fringeline.operators import raster as R

RND = np.random.default_rng(31)


def terms(x, y, degree):
    return np.stack([x**i * y**j for i in range(degree + 1) for j in range(degree + 1 - i)], axis=1)


@pytest.mark.parametrize("degree, scale", [(2, 40.0), (3, 1.0)])
def test_surface_equals_lstsq(spark, degree, scale):
    """Raw powers of rows up to 300: normal equations would keep a few digits of a cubic."""
    cells = [(f, int(r), int(c), None if k % 17 == 0 else float(3 + 0.2 * r - 0.001 * r * c + 1e-5 * c**3 + RND.normal())) for f in ("a", "b") for k, (r, c) in enumerate(RND.integers(0, 300, (1500, 2)))]
    p = spark.createDataFrame(cells, "frame string, row int, col int, v double").repartition(7)
    got = L.surface_deramp(p, ["frame"], "v", degree, scale).collect()
    for f in ("a", "b"):
        own = [(r, c, v) for g, r, c, v in cells if g == f and v is not None]
        x, y, v = np.array(own, float).T
        a = terms(x / scale, y / scale, degree)
        rest = dict(zip(((int(r), int(c), z) for r, c, z in own), v - a @ np.linalg.lstsq(a, v, rcond=1e-15)[0]))
        assert all(abs(r.deramped - rest[r.row, r.col, r.v]) < 1e-7 for r in got if r.frame == f and r.v is not None)
    assert len(got) == len(cells)


def test_fit_of_too_few_rows_and_without_keys(spark):
    p = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, None)], "row int, col int, v double")
    got = {(r.row, r.col): r.deramped for r in L.surface_deramp(p, [], "v", 2, 1.0).collect()}
    assert got[0, 0] == pytest.approx(0, abs=1e-12) and got[0, 1] == pytest.approx(0, abs=1e-12) and got[1, 0] is None


def test_seasonal_equals_lstsq(spark):
    rows = [(k, dt.date(2014, 1, 1) + dt.timedelta(days=int(d)), float(5 + 3 * d / 365 + np.sin(d / 58) + RND.normal()), float(1 + d % 3)) for k in range(5) for d in RND.integers(0, 3000, 60)]
    rows.append((0, dt.date(2015, 1, 1), None, 1.0))
    for r in L.seasonal(spark.createDataFrame(rows, "k int, epoch date, v double, s double"), ["k"], "v", "s").collect():
        own = [(e, v, s) for k, e, v, s in rows if k == r.k and v is not None]
        t = np.array([(e - dt.date(2000, 1, 1)).days / 365.25 for e, *_ in own])
        w = 1 / np.array([s for *_, s in own])
        a = np.stack([np.ones_like(t), t, np.sin(2 * np.pi * t), np.cos(2 * np.pi * t)], axis=1)
        want = np.linalg.lstsq(a * w[:, None], np.array([v for _, v, _ in own]) * w, rcond=None)[0]
        assert np.allclose([r.const, r.rate, r.sin, r.cos], want, rtol=1e-8, atol=1e-8)


def test_huber_equals_reweighting(spark):
    rows = [(b, float(x), float(2 + 0.01 * x + RND.normal() * 0.1 + (30 if i % 9 == 0 else 0))) for b in range(4) for i, x in enumerate(RND.uniform(1000, 1500, 60))]
    rows += [(9, 1.0, 2.0), (9, 1.0, 3.0), (9, None, 1.0)]
    got = {r.b: r for r in L.huber_slope(spark.createDataFrame(rows, "b int, x double, y double"), ["b"], "x", "y").collect()}
    for b in range(4):
        x, y = np.array([r[1:] for r in rows if r[0] == b]).T
        a, w = np.stack([x - x.mean(), np.ones_like(x)], axis=1), np.ones(len(x))
        for _ in range(12):
            sol = np.linalg.lstsq(a * np.sqrt(w)[:, None], y * np.sqrt(w), rcond=None)[0]
            r = np.abs(y - a @ sol)
            w = np.minimum(1, 1.345 * np.median(r) / 0.6745 / np.maximum(r, 1e-12))
        assert got[b].slope == pytest.approx(sol[0], rel=1e-8) and got[b].intercept == pytest.approx(sol[1] - sol[0] * x.mean(), rel=1e-6)
        assert abs(got[b].slope - 0.01) < 0.001
    assert got[9].slope is None


def test_height_correction_is_robust_and_masked(spark):
    """A tenth of the pixels is turned far off, low and incoherent ones carry another slope: neither draws the slope."""
    rows = []
    for r in range(40):
        for c in range(40):
            h, coh = 150.0 + 20 * r + c, 0.9 if c % 4 else 0.1
            good = h > 200 and coh > 0.4
            rows.append(("f", r, c, h, coh, 0.002 * h + (2.0 if good and (r * 7 + c) % 10 == 0 else 0.0) if good else -0.005 * h))
    p = spark.createDataFrame(rows, "frame string, row int, col int, hgt double, coh double, pha double")
    got = R.height_correction(p, ["frame"], 20, coh="coh").first()
    assert got.slope == pytest.approx(0.002, abs=2e-4)
    plain = R.height_correlation(p, ["frame"], 20).agg(F.median("slope").alias("s")).first().s
    assert plain is None or abs(plain - 0.002) > 5e-4  # without masks: not even correlated, or another slope


def brute_inversion(pairs, outlier):
    epochs = sorted({e for a, b, _ in pairs for e in (a, b)})
    keep = [p for p in pairs if p[2] is not None]

    def solve(own):
        a = np.zeros((len(own), len(epochs)))
        for i, (e, f, _) in enumerate(own):
            a[i, epochs.index(f)] += 1
            a[i, epochs.index(e)] -= 1
        a = a[:, 1:]
        if not len(own) or np.linalg.matrix_rank(a) < a.shape[1]:
            return None, None
        d = np.array([v for *_, v in own])
        x = np.linalg.lstsq(a, d, rcond=None)[0]
        return x, d - a @ x

    x, rest = solve(keep)
    if x is None:
        return dict.fromkeys(epochs)
    if (np.abs(rest) > outlier).any():
        again = solve([p for p, r in zip(keep, rest) if abs(r) <= outlier])[0]
        x = [None] * len(x) if again is None else again
    return dict(zip(epochs, [0.0, *x]))


def test_network_with_dropped_pairs(spark):
    day = [dt.date(2020, 1, 1) + dt.timedelta(days=12 * i) for i in range(9)]
    rows, want = [], {}
    for k in range(60):
        reach = 1 + k % 3
        truth = np.cumsum(RND.normal(size=9))
        own = [(day[i], day[j], float(truth[j] - truth[i] + RND.normal() * 0.01)) for i in range(9) for j in range(i + 1, min(9, i + 1 + reach))]
        if k % 4:
            for at in RND.choice(len(own), k % 4, replace=False).tolist():
                own[at] = (*own[at][:2], own[at][2] + 20.0)
        if k % 5 == 0:
            own[3] = (*own[3][:2], None)
        rows += [(k, *p) for p in own]
        want[k] = brute_inversion(own, 2.5)
    got = {}
    for r in L.invert_network(spark.createDataFrame(rows, "k int, epoch1 date, epoch2 date, value double"), ["k"], 2.5, 3).collect():
        got.setdefault(r.k, {})[r.epoch] = r.value
    assert set(got) == set(want)
    for k, series in want.items():
        assert set(got[k]) == set(series)
        for e, v in series.items():
            assert got[k][e] == (None if v is None else pytest.approx(v, abs=1e-9)), (k, e)
