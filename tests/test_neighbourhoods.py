"""Neighbourhoods of two frames with holes against plain windows."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeline.operators import raster as R

RND = np.random.default_rng(21)
SHAPE = (23, 31)
#: frame -> value or None by place; a fifth of the places has no pixel at all, and columns of the frames overlap.
FRAMES = {f: {(r, c): None if RND.random() < 0.2 else float(RND.integers(-40, 40)) for r in range(SHAPE[0]) for c in range(SHAPE[1]) if RND.random() < 0.8} for f in ("a", "b")}


@pytest.fixture(scope="module")
def pixels(spark):
    return spark.createDataFrame([(f, r, c, v) for f, cells in FRAMES.items() for (r, c), v in cells.items()], "frame string, row int, col int, v double").cache()


def windows(k, keep=lambda dr, dc: True):
    h = k // 2
    for f, cells in FRAMES.items():
        for r, c in cells:
            yield (f, r, c), [v for dr in range(-h, h + 1) for dc in range(-h, h + 1) if keep(dr, dc) and (v := cells.get((r + dr, c + dc))) is not None]


def found(df, name):
    return {(r.frame, r.row, r.col): r[name] for r in df.collect()}


@pytest.mark.parametrize("k, block", [(3, 8), (5, 128), (51, 16)])
def test_moving(spark, pixels, k, block):
    near = dict(windows(k))
    assert found(R.moving(pixels, ["frame"], "v", "median", k, block), "median") == {p: float(np.median(v)) if v else None for p, v in near.items()}
    modes = {p: min(Counter(v).items(), key=lambda x: (-x[1], x[0]))[0] if v else None for p, v in near.items()}
    assert found(R.moving(pixels, ["frame"], "v", "mode", k, block), "mode") == modes
    assert found(R.moving(pixels, ["frame"], "v", "mode", k, block), "n") == {p: len(v) for p, v in near.items()}
    for how, of in (("mean", np.mean), ("var", np.var)):
        got = found(R.moving(pixels, ["frame"], "v", how, k), how)
        assert set(got) == set(near) and all(got[p] == pytest.approx(of(v)) if v else got[p] is None for p, v in near.items())


@pytest.mark.parametrize("radius", [1, 4])
def test_mode_median(pixels, radius):
    want = {}
    for p, v in windows(2 * radius + 1, lambda dr, dc: dr * dr + dc * dc <= radius * radius):
        if v:
            top = min(Counter(x // 7 for x in v).items(), key=lambda x: (-x[1], x[0]))[0]
            want[p] = float(np.median([x for x in v if abs(x // 7 - top) <= 1]))
    assert found(R.mode_median(pixels, ["frame"], "v", radius, 7.0, 8), "value") == want


def test_gauss_and_boxes(pixels):
    smooth = found(R.gauss_smooth(pixels, ["frame"], "v", 1.5, 3), "smooth")
    coh = found(R.phase_variance_coherence(pixels, ["frame"], "v", 5), "coh")
    for f, cells in FRAMES.items():
        for (r, c), own in cells.items():
            near = [(dr, dc, cells[r + dr, c + dc]) for dr in range(-3, 4) for dc in range(-3, 4) if cells.get((r + dr, c + dc))]
            if own:
                w = [np.exp(-(a * a + b * b) / 4.5) for a, b, _ in near]
                assert smooth[f, r, c] == pytest.approx(np.dot(w, [v for *_, v in near]) / sum(w))
            unit = [np.exp(1j * cells[r + dr, c + dc]) for dr in range(-2, 3) for dc in range(-2, 3) if cells.get((r + dr, c + dc)) is not None]
            if unit:
                assert coh[f, r, c] == pytest.approx(abs(np.mean(unit)), abs=1e-7)


def test_rows_grow_with_the_radius_not_its_square(spark):
    """The sums of one dimension are all that meets the second: places a pixel reaches, not pixels of the box."""
    one = spark.createDataFrame([(0, 0, 1.0)], "row int, col int, v double")
    out = R.kernel_sums(one, [], {"s": F.col("v")}, R.gauss(4.0, 16)).collect()
    assert len(out) == 33 * 33 and sum(r.s for r in out) == pytest.approx(sum(R.gauss(4.0, 16)) ** 2)


def test_fill_nearest(pixels):
    got = found(R.fill_nearest(pixels, ["frame"], "v"), "v")
    for f, cells in FRAMES.items():
        ok = [(r, c, v) for (r, c), v in cells.items() if v is not None]
        for (r, c), v in cells.items():
            assert got[f, r, c] == (v if v is not None else min(((r - a) ** 2 + (c - b) ** 2, a, b, x) for a, b, x in ok)[3])


def test_fill_one_value_far_away(spark):
    """A hole of a hundred thousand columns takes one pass."""
    line = spark.range(100_000).select(F.lit(0).alias("row"), F.col("id").alias("col"), F.when(F.col("id").isin(3, 99_990), F.col("id")).alias("v"))
    got = R.fill_nearest(line, [], "v").groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == {3: 49_997, 99_990: 50_003}
