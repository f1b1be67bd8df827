"""Ingest jobs: text, CSV, XML and binary files to DataFrames. Paths may be folders or globs that Spark reads."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _day(column):
    return F.try_to_date(column, "yyyyMMdd")


def baselines(spark: SparkSession, path: str) -> DataFrame:
    """(epoch, bperp) of baseline files. Lines of four columns give their secondary epoch, and the first one the primary as 0; lines of
    nine give both epochs of a pair. A file is recognised line by line, so layouts may be mixed. The last line of an epoch isn't
    known in a distributed read, so an epoch given twice appears twice."""
    p = F.split(F.trim("value"), r"\s+")
    at = lambda i: F.get(p, F.lit(i))
    row = lambda day, b: F.struct(_day(day).alias("epoch"), b.cast("double").alias("bperp"))
    new = F.array(row(at(1), at(2)), row(at(0), F.lit("0")))
    old = F.array(row(at(1), at(7)), row(at(2), at(8)))
    lines = spark.read.text(path).select(F.when(F.size(p) == 4, new).when(F.size(p) == 9, old).alias("rows"))
    return lines.filter("rows is not null").select(F.inline("rows")).filter("epoch is not null").distinct()


def pair_list(spark: SparkSession, path: str) -> DataFrame:
    """(epoch1, epoch2) of lines like 20170302_20170314, with a dash, a blank or other text around."""
    e = [_day(F.regexp_extract("value", r"(\d{8})[-_\s]+(\d{8})", i)) for i in (1, 2)]
    return spark.read.text(path).select(e[0].alias("epoch1"), e[1].alias("epoch2")).filter("epoch1 is not null and epoch2 is not null")


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, acq_date): the date is the first yyyymmdd followed by T in the name, else a yyyy/mm/dd folder."""
    name = F.element_at(F.split("path", "/"), -1)
    inside = _day(F.regexp_extract(name, r"(\d{8})T\d{6}", 1))
    folder = _day(F.regexp_replace(F.regexp_extract("path", r"(\d{4}/\d{2}/\d{2})", 1), "/", ""))
    return spark.read.text(path).select(F.trim("value").alias("path")).filter("path != ''").select("path", name.alias("name"), F.coalesce(inside, folder).alias("acq_date"))


def polygon_vertices(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``poly seq x y`` -> closed rings (poly, seq, x, y); polygons of three vertices or fewer are dropped."""
    p = F.split(F.trim("value"), r"\s+")
    v = spark.read.text(path).select(F.get(p, F.lit(0)).cast("long").alias("poly"), F.get(p, F.lit(1)).cast("int").alias("seq"), F.get(p, F.lit(2)).cast("double").alias("x"), F.get(p, F.lit(3)).cast("double").alias("y"))
    w = Window.partitionBy("poly").orderBy("seq")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    last = F.row_number().over(w) == F.count("*").over(Window.partitionBy("poly"))
    ends = v.withColumns({"n": F.count("*").over(Window.partitionBy("poly")), "x0": F.first("x").over(every), "y0": F.first("y").over(every), "last": last}).filter("n > 3")
    own = F.struct("seq", "x", "y")
    again = F.struct((F.col("seq") + 1).alias("seq"), F.col("x0").alias("x"), F.col("y0").alias("y"))
    is_open = F.col("last") & ((F.col("x") != F.col("x0")) | (F.col("y") != F.col("y0")))
    return ends.select("poly", F.inline(F.when(is_open, F.array(own, again)).otherwise(F.array(own))))


def wide_series(spark: SparkSession, path: str) -> DataFrame:
    """CSV of LAT, LON, VEL, COHER and a column for each date -> (lat, lon, vel, coh, epoch, value)."""
    d = spark.read.option("header", True).csv(path)
    dates = [c for c in d.columns if len(c) == 10 and c[4] == "-" and c[7] == "-"]
    ids = ["LAT", "LON", "VEL", "COHER"]
    long = d.unpivot(ids, dates, "epoch", "value")
    return long.select(*[F.col(c).cast("double").alias(n) for c, n in zip(ids, ("lat", "lon", "vel", "coh"))], F.to_date("epoch").alias("epoch"), F.col("value").cast("double").alias("value"))


def raster_pixels(files: DataFrame, width: int, dtype: str, block_rows: int = 256) -> DataFrame:
    """files (path, content) of flat rasters -> (path, row, col, re, im); no-data 0 is null.

    ``dtype`` is numpy's, such as >f4 or <c8, or >i2c for complex int16. A file is decoded by one task, in blocks of rows.
    """

    def pixels(batches):
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                if dtype.endswith("i2c"):
                    flat = np.frombuffer(content, dtype[:-1]).astype("f4")
                    a = (flat[0::2] + 1j * flat[1::2]).reshape(-1, width)
                else:
                    a = np.frombuffer(content, dtype).reshape(-1, width)
                for r in range(0, len(a), block_rows):
                    part = a[r : r + block_rows]
                    row, col = np.indices(part.shape)
                    re = part.real.astype(float).ravel()
                    im = part.imag.astype(float).ravel() if np.iscomplexobj(part) else np.full(part.size, np.nan)
                    none = (part == 0).ravel() | np.isnan(re)
                    yield pd.DataFrame({"path": name, "row": row.ravel() + r, "col": col.ravel(), "re": pd.Series(re).mask(none), "im": pd.Series(im).mask(none)})

    found = files.mapInPandas(pixels, "path string, row long, col long, re double, im double")
    return found.select("path", "row", "col", *[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in ("re", "im")])


def flat_rasters(spark: SparkSession, path: str, width: int, dtype: str) -> DataFrame:
    """raster_pixels() of the binary files at a path."""
    return raster_pixels(spark.read.format("binaryFile").load(path).select("path", "content"), width, dtype)


def orbit_vectors(spark: SparkSession, path: str, first: str = "1900-01-01", last: str = "2100-01-01") -> DataFrame:
    """State vectors of orbit files within time bounds: (time, x, y, z, vx, vy, vz)."""
    schema = ", ".join(["UTC string"] + [f"{c} struct<_VALUE:double,_unit:string>" for c in ("X", "Y", "Z", "VX", "VY", "VZ")])
    rows = spark.read.format("xml").option("rowTag", "OSV").schema(schema).load(path)
    time = F.to_timestamp(F.regexp_replace("UTC", "^UTC=", ""))
    return rows.select(time.alias("time"), *[F.col(f"{c}._VALUE").alias(c.lower()) for c in ("X", "Y", "Z", "VX", "VY", "VZ")]).filter(F.col("time").between(F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")))


def annotation_bursts(spark: SparkSession, path: str) -> DataFrame:
    """Scene annotation -> bursts (file, burst, lon1, lon2, lat1, lat2, lon, lat): the first and last points of two successive grid
    lines are a burst's corners; the centre is their spherical mean."""
    grid = spark.read.format("xml").option("rowTag", "geolocationGridPoint").schema("line long, pixel long, latitude double, longitude double").load(path).withColumn("file", F.input_file_name())
    lines = grid.groupBy("file", "line").agg(F.min_by(F.struct("longitude", "latitude"), "pixel").alias("a"), F.max_by(F.struct("longitude", "latitude"), "pixel").alias("b"))
    w = Window.partitionBy("file").orderBy("line")
    two = lines.withColumns({"burst": F.row_number().over(w), "c": F.lead("a").over(w), "d": F.lead("b").over(w)}).filter("c is not null")
    lon, lat = ([F.col(f"{p}.{n}") for p in "abcd"] for n in ("longitude", "latitude"))
    x = sum((F.cos(F.radians(la)) * F.cos(F.radians(lo)) for lo, la in zip(lon, lat)), F.lit(0.0))
    y = sum((F.cos(F.radians(la)) * F.sin(F.radians(lo)) for lo, la in zip(lon, lat)), F.lit(0.0))
    z = sum((F.sin(F.radians(la)) for la in lat), F.lit(0.0))
    return two.select("file", "burst", F.least(*lon).alias("lon1"), F.greatest(*lon).alias("lon2"), F.least(*lat).alias("lat1"), F.greatest(*lat).alias("lat2"), F.degrees(F.atan2(y, x)).alias("lon"), F.degrees(F.atan2(z, F.hypot(x, y))).alias("lat"))


def clipped_pixels(spark: SparkSession, path: str, lon1: float, lon2: float, lat1: float, lat2: float) -> DataFrame:
    """A Parquet pixel table within an area; the bounds reach the row groups."""
    return spark.read.parquet(path).filter(F.col("lon").between(lon1, lon2) & F.col("lat").between(lat1, lat2))
