"""Distributed selection, the tiled mosaic."""

import glob
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeline.operators import raster as R
from fringeline.operators.select import medians

RND = np.random.default_rng(12)
GROUPS = {
    "even": RND.normal(size=4000).tolist(),
    "odd": (RND.normal(size=4001) ** 9).tolist(),
    "one value": [3.5] * 3000,
    "mostly one": [1.0] * 2700 + RND.normal(size=300).tolist(),
    "edge of a tie": [0.25] * 999 + [0.5] + [2.0] * 1000,
    "two values": [-1.0] * 1500 + [4.0] * 1500,
    "wide": [(-1) ** i * 10.0 ** (i % 300) for i in range(2500)],
    "small": [5.0, 1.0],
    "none": [None, None],
}


@pytest.mark.parametrize("most", [50, 1000, 100_000])
def test_medians_of_groups(spark, most):
    rows = spark.createDataFrame([(g, i % 3, v) for g, values in GROUPS.items() for i, v in enumerate(values)], "g string, other int, v double").repartition(6)
    want = {g: statistics.median([x for x in v if x is not None]) for g, v in GROUPS.items() if g != "none"}
    assert {r.g: r.median for r in medians(rows, ["g"], F.col("v"), most).collect()} == pytest.approx(want, rel=1e-12)


def test_median_of_a_whole_table(spark):
    rows = spark.range(20_001).select((F.hash("id") % 1000).cast("double").alias("v"))
    want = statistics.median(r.v for r in rows.collect())
    for most in (100, 100_000):
        assert [r.median for r in medians(rows, [], F.col("v"), most).collect()] == [want]


def test_one_large_group(spark):
    """250 times ``most`` values under one key."""
    rows = spark.range(50_000).select(F.lit("g").alias("g"), F.rand(3).alias("v"))
    got = medians(rows, ["g"], F.col("v"), 200).first().median
    assert got == pytest.approx(statistics.median(r.v for r in rows.collect()), rel=1e-12)


def test_mosaic_rounds_touch_their_tiles(spark, tmp_path):
    """Two far pairs of grids: a round's table has the tiles of its own grid only."""
    rows = []
    for place, (r0, c0, level) in enumerate([(0, 0, 0.0), (0, 4, 2.0), (100, 100, 5.0), (104, 100, 9.0)]):
        rows += [(place, r0 + r, c0 + c, float(10 + r + c0 + c + level)) for r in range(8) for c in range(8)]
    grids = spark.createDataFrame(rows, "place int, row long, col long, value double")
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    local = folder.removeprefix("file:")
    before = set(glob.glob(f"{local}/tables/*"))
    for most in (10, 100_000):
        got = {(r.row, r.col): (r.value, r.place) for r in R.grow_mosaic(grids, [0, 1, 2, 3], tile=16, most=most).collect()}
        assert len(got) == 2 * (64 + 32)
        assert got[0, 4] == (14.0, 1) and got[0, 0] == (10.0, 0) and got[7, 11] == (28.0, 1)  # shifted by -2 onto the first
        assert got[100, 100] == (115.0, 2) and got[104, 100][1] == 3
    tiled = [t for t in set(glob.glob(f"{local}/tables/*")) - before if glob.glob(f"{t}/tile=*")]
    assert sorted(len(glob.glob(f"{t}/tile=*")) for t in tiled) == sorted(2 * [1, 1, 1, 1])


def test_remove_median_without_and_with_rounds(spark):
    p = spark.createDataFrame([(f, i, 0, float(RND.normal())) for f in "ab" for i in range(500)], "f string, row int, col int, v double").cache()
    one, two = (sorted(map(tuple, R.remove_median(p, ["f"], "v", most).collect())) for most in (20, 10_000))
    assert [x[:3] for x in one] == [x[:3] for x in two] and [x[3] for x in one] == pytest.approx([x[3] for x in two], abs=1e-12)
