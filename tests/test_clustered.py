"""Clips of clustered tables read few row groups."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fringeline.sources import readers, writers


def groups(path, **bounds):
    """Row groups of a table, and those whose bounds meet the ranges."""
    every = met = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            stats = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c).statistics for c in range(meta.num_columns)}
            every += 1
            met += all(stats[k].max >= low and stats[k].min <= high for k, (low, high) in bounds.items())
    return every, met


def test_morton(spark):
    got = [r.m for r in spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (2, 0), (3, 5), (65535, 65535)], "x long, y long").select(writers.morton(F.col("x"), F.col("y")).alias("m")).collect()]
    assert got == [0, 1, 2, 3, 4, 0b100111, 2**32 - 1]


def test_a_clip_of_a_hundredth_reads_few_groups(spark, tmp_path):
    points = spark.range(400_000).select("id", (F.rand(1) * 360 - 180).alias("lon"), (F.rand(2) * 180 - 90).alias("lat"))
    path = str(tmp_path / "points")
    writers.clustered(points, path, "lon", "lat", 1.0, -180.0, -90.0, files=8, rows=1000)
    clip = {"lon": (20.0, 56.0), "lat": (10.0, 28.0)}  # a hundredth of the area
    every, met = groups(path, **clip)
    assert every >= 300 and met < 0.05 * every
    inside = F.col("lon").between(20, 56) & F.col("lat").between(10, 28)
    assert readers.clipped_pixels(spark, path, 20, 56, 10, 28).count() == points.filter(inside).count()
    assert spark.read.parquet(path).count() == 400_000


def test_cube_has_cells(spark, tmp_path):
    pixels = spark.range(256 * 256).select(F.lit("f").alias("frame"), F.lit("2020-01").alias("epoch"), F.floor(F.col("id") / 256).alias("row"), (F.col("id") % 256).alias("col"), F.lit(0.5).alias("coh"))
    path = str(tmp_path / "cube")
    writers.pixel_cube(pixels, path, cell=64)
    cube = spark.read.parquet(path)
    assert cube.count() == 256 * 256 and cube.select("cell").distinct().count() == 16
    assert cube.filter("row < 64 and col < 64").select("cell").distinct().count() == 1


def test_places_outside_the_cells_are_kept(spark, tmp_path):
    path = str(tmp_path / "odd")
    writers.clustered(spark.createDataFrame([(-999.0, 5.0), (None, 1.0), (1e9, 1e9)], "lon double, lat double"), path, "lon", "lat", 1.0)
    assert spark.read.parquet(path).count() == 3


@pytest.mark.parametrize("bits", [16])
def test_cells_are_local(spark, bits):
    """A square of cells aligned to a power of two is one range of numbers."""
    cells = spark.range(8).crossJoin(spark.range(8).withColumnRenamed("id", "y")).select(writers.morton(F.col("id") + 24, F.col("y") + 40, bits).alias("m"))
    low, high, n = cells.agg(F.min("m"), F.max("m"), F.count("*")).first()
    assert high - low + 1 == n == 64
