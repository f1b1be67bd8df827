"""Polygons by bands and scanlines against plain ray casting."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeline.operators import spatial as S


def inside(ring, x, y):
    n = 0
    for (xa, ya), (xb, yb) in zip(ring, ring[1:] + ring[:1]):
        n += (ya > y) != (yb > y) and x < (xb - xa) * (y - ya) / (yb - ya) + xa
    return n % 2 == 1


def rings():
    rnd = np.random.default_rng(3)
    star = [((3 + 2 * (i % 2) + 0.3 * rnd.random()) * math.cos(math.tau * i / 60), (3 + 2 * (i % 2)) * math.sin(math.tau * i / 60)) for i in range(60)]
    comb = [(-4 + 0.1 * i, 4.0 if i % 2 else -4.0) for i in range(80)] + [(4.0, -5.0), (-4.0, -5.0)]  # every tooth spans the height
    flat = [(0.0, 1.0), (1.0, 1.0), (2.0, 1.0), (3.0, 1.0)]
    whole = [(-2.0, -2.0), (2.0, -2.0), (2.0, 2.0), (-2.0, 2.0)]  # corners on grid points
    return {"star": star, "comb": comb, "flat": flat, "whole": whole}


def frame(spark, rings):
    return spark.createDataFrame([(p, i, float(x), float(y)) for p, r in rings.items() for i, (x, y) in enumerate(r)], "poly string, seq int, x double, y double")


def test_points(spark):
    shapes, rnd = rings(), np.random.default_rng(4)
    spots = [(i, float(x), float(y)) for i, (x, y) in enumerate(rnd.uniform(-6, 6, (1500, 2)))] + [(9000 + i, float(i % 5 - 2), float(i // 5 - 2)) for i in range(25)]
    points = spark.createDataFrame(spots, "id int, lon double, lat double")
    want = {(i, p) for i, x, y in spots for p, r in shapes.items() if inside(r, x, y)}
    assert {tuple(r) for r in S.points_in_polygons(points, frame(spark, shapes), "id").collect()} == want


@pytest.mark.parametrize("step", [0.25, -0.25])
def test_grid(spark, step):
    shapes = rings()
    lat0 = -6.0 if step > 0 else 6.0
    got = {tuple(r) for r in S.pixels_in_polygons(frame(spark, shapes), -6.0, lat0, 0.25, step, 49, 49).collect()}
    assert got == {(p, r, c) for p, ring in shapes.items() for r in range(49) for c in range(49) if inside(ring, -6.0 + 0.25 * c, lat0 + step * r)}
    pixels = spark.range(49 * 49).select(F.floor(F.col("id") / 49).alias("row"), (F.col("id") % 49).alias("col"))
    assert S.masked_by_polygons(pixels, frame(spark, shapes), -6.0, lat0, 0.25, step, 49, 49).count() == len({x[1:] for x in got})


def test_a_long_coast_is_listed_by_crossings(spark):
    """100,000 vertices over a grid of ten million cells: rows follow the crossings of grid rows, and a point meets a few edges."""
    n = 100_000
    angle = F.lit(2 * math.pi / n) * F.col("id")
    reach = 40 + 3 * F.sin(angle * 500)
    coast = spark.range(n).select(F.lit("coast").alias("poly"), F.col("id").cast("int").alias("seq"), (reach * F.cos(angle)).alias("x"), (reach * F.sin(angle)).alias("y"))
    spans = S.polygon_spans(coast, -45.0, 0.03, 3000)
    assert spans.count() < 3000 * 100
    edges, boxes = S.banded_edges(coast)
    listed, bands = edges.count(), boxes.first().bands
    assert listed <= 3 * n and listed / bands < 400
    cells = S.pixels_in_polygons(coast, -45.0, -45.0, 0.03, 0.03, 3000, 3000).count()
    assert cells == pytest.approx(math.pi * (40**2 + 4.5) / 0.03**2, rel=0.001)
