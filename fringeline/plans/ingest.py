"""Ingest queries: Spark writes the driver's tables in each format to the shared folder, and the readers read them back."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fringeline.plans.registry import Registry
from fringeline.plans.views import table, view
from fringeline.sources import readers, writers
from fringeline.storage import shared_folder

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _folder(spark):
    return f"{shared_folder(spark)}/files/{uuid.uuid4().hex}"


def _text(spark, column_df):
    path = _folder(spark)
    column_df.write.text(path)
    return path


@query("""WITH n AS (SELECT fid, acq_date AS e1, acq_date + CAST(1 + fid % 12 AS INTEGER) AS e2, CAST(fid % 400 - 200 AS DOUBLE) AS b FROM @files)
    SELECT DISTINCT CAST(e AS VARCHAR) AS epoch, b AS bperp FROM (SELECT e2 AS e, b FROM n WHERE fid % 2 = 0 UNION ALL SELECT e1, 0 FROM n WHERE fid % 2 = 0 UNION ALL SELECT e1, b FROM n WHERE fid % 2 = 1 UNION ALL SELECT e2, b + 5 FROM n WHERE fid % 2 = 1)""")
def a02_baseline_files(spark, sf_dir):
    day = lambda c: F.date_format(c, "yyyyMMdd")
    f = view(spark, sf_dir, "files").withColumns({"e2": F.date_add("acq_date", (1 + F.col("fid") % 12).cast("int")), "b": (F.col("fid") % 400 - 200).cast("double")})
    new = F.concat_ws(" ", day("acq_date"), day("e2"), "b", F.lit("12.0"))
    old = F.concat_ws("  ", F.lit("1"), day("acq_date"), day("e2"), F.lit("9.9"), F.lit("12.0"), F.lit("0.0"), F.lit("12.0"), "b", F.col("b") + 5)
    path = _text(spark, f.select(F.when(F.col("fid") % 2 == 0, new).otherwise(old).alias("value")))
    return readers.baselines(spark, path).withColumn("epoch", F.col("epoch").cast("string"))


@query("SELECT DISTINCT CAST(epoch1 AS VARCHAR) AS epoch1, CAST(epoch2 AS VARCHAR) AS epoch2 FROM @pairs")
def a03_pair_lists(spark, sf_dir):
    path = _folder(spark)
    writers.pair_file(view(spark, sf_dir, "pairs"), path)
    p = readers.pair_list(spark, path).distinct()
    return p.select(*[F.col(c).cast("string").alias(c) for c in ("epoch1", "epoch2")])


@query("SELECT 'S1_' || fid AS name, CAST(acq_date AS VARCHAR) AS acq_date FROM @files WHERE fid % 2 = 0 UNION ALL SELECT 'S1_' || strftime(acq_date, '%Y%m%d') || 'T061509_' || fid, CAST(acq_date AS VARCHAR) FROM @files WHERE fid % 2 = 1")
def a04_file_lists(spark, sf_dir):
    f = view(spark, sf_dir, "files")
    plain = F.concat(F.lit("/data/"), F.date_format("acq_date", "yyyy/MM/dd"), F.lit("/S1_"), "fid")
    dated = F.concat(F.lit("/data/S1_"), F.date_format("acq_date", "yyyyMMdd"), F.lit("T061509_"), "fid")
    path = _text(spark, f.select(F.when(F.col("fid") % 2 == 0, plain).otherwise(dated).alias("value")))
    return readers.file_list(spark, path).select("name", F.col("acq_date").cast("string").alias("acq_date"))


@query("SELECT polyid AS poly, CAST(i AS BIGINT) AS seq, round(CASE i WHEN 1 THEN lon2 WHEN 2 THEN lon2 ELSE lon1 END, 4) + 0.0 AS x, round(CASE i WHEN 2 THEN lat2 WHEN 3 THEN lat2 ELSE lat1 END, 4) + 0.0 AS y FROM @frames, range(0, 5) r(i)")
def a05_polygons(spark, sf_dir):
    """Four open corners are written; the ring is closed on reading."""
    corner = [("lon1", "lat1"), ("lon2", "lat1"), ("lon2", "lat2"), ("lon1", "lat2")]
    lines = [F.concat_ws(" ", "polyid", F.lit(str(i)), F.round(x, 4), F.round(y, 4)) for i, (x, y) in enumerate(corner)]
    path = _text(spark, view(spark, sf_dir, "frames").select(F.explode(F.array(*lines)).alias("value")))
    v = readers.polygon_vertices(spark, path)
    return v.select("poly", F.col("seq").cast("long").alias("seq"), (F.col("x") + F.lit(0.0)).alias("x"), (F.col("y") + F.lit(0.0)).alias("y"))


@query("""SELECT round(lat, 1) + 0.0 AS lat, round(lon, 1) + 0.0 AS lon, tanx AS vel, CAST('2020-01-01' AS VARCHAR) AS epoch, CAST(bid AS DOUBLE) AS value FROM @bursts UNION ALL SELECT round(lat, 1) + 0.0, round(lon, 1) + 0.0, tanx, '2020-01-13', CAST(bid * 2 AS DOUBLE) FROM @bursts""")
def a06_wide_series(spark, sf_dir):
    path = _folder(spark)
    b = view(spark, sf_dir, "bursts")
    wide = b.select(F.round("lat", 1).alias("LAT"), F.round("lon", 1).alias("LON"), F.col("tanx").alias("VEL"), F.lit(0.5).alias("COHER"), F.col("bid").alias("2020-01-01"), (F.col("bid") * 2).alias("2020-01-13"))
    wide.write.option("header", True).csv(path)
    s = readers.wide_series(spark, path)
    return s.select((F.col("lat") + F.lit(0.0)).alias("lat"), (F.col("lon") + F.lit(0.0)).alias("lon"), "vel", F.col("epoch").cast("string").alias("epoch"), "value")


def _lines(spark, sf_dir, kind):
    """Fixture: (path, content), a raster line in binary for each vector; complex kinds hold thousandths and their halves."""

    @F.pandas_udf("binary")
    def packed(v: pd.Series) -> pd.Series:
        if kind == ">f4":
            return pd.Series([np.asarray(x, kind).tobytes() for x in v])
        n = [np.rint(np.asarray(x, float) * 1000) for x in v]
        pairs = [np.stack([x, np.floor(x / 2)], axis=1) for x in n]
        return pd.Series([p.astype(">i2" if kind == ">i2c" else "<f4").tobytes() for p in pairs])

    path = _folder(spark)
    table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("path"), packed("embedding").alias("content")).write.parquet(path)
    return spark.read.parquet(path)


_COMPLEX = """(SELECT vec_id AS "row", CAST(i - 1 AS BIGINT) AS col, round_even(CAST(embedding[i] AS DOUBLE) * 1000, 0) AS n FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings))"""


@query(f"""SELECT kind, "row", col, CASE WHEN n <> 0 THEN n + 0.0 END AS re, CASE WHEN n <> 0 THEN floor(n / 2) + 0.0 END AS im FROM {_COMPLEX} c, (VALUES ('>i2c'), ('<c8')) k(kind)""")
def a07_complex_rasters(spark, sf_dir):
    """Complex int16 and complex64; no-data is null in both parts."""
    kinds = [readers.raster_pixels(_lines(spark, sf_dir, k), 64, k).select(F.lit(k).alias("kind"), F.col("path").cast("long").alias("row"), "col", (F.col("re") + F.lit(0.0)).alias("re"), (F.col("im") + F.lit(0.0)).alias("im")) for k in (">i2c", "<c8")]
    return kinds[0].union(kinds[1])


@query("SELECT vec_id AS \"row\", CAST(i - 1 AS BIGINT) AS col, round(nullif(CAST(embedding[i] AS DOUBLE), 0), 6) + 0.0 AS re FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings)")
def a07_flat_rasters(spark, sf_dir):
    """A file of one big-endian raster line for each vector, told apart by its folder."""
    found = readers.raster_pixels(_lines(spark, sf_dir, ">f4"), 64, ">f4")
    return found.select(F.col("path").cast("long").alias("row"), "col", (F.round("re", 6) + F.lit(0.0)).alias("re"))


@query("SELECT event_id, CAST(event_id % 1000 AS DOUBLE) + 0.5 AS x, CAST(event_id % 77 AS DOUBLE) AS vz FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'")
def a09_orbit_vectors(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    tag = lambda n, v: F.concat(F.lit(f'<{n} unit="m">'), v, F.lit(f"</{n}>"))
    zero, k = F.lit("0.0"), F.col("event_id")
    osv = F.concat(F.lit("<OSV><UTC>UTC="), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("</UTC>"), tag("X", (k % 1000).cast("double") + 0.5), tag("Y", k.cast("double")), tag("Z", zero), tag("VX", zero), tag("VY", zero), tag("VZ", (k % 77).cast("double")), F.lit("</OSV>"))
    # a document holds sixty vectors or so
    docs = e.groupBy((k / 60).cast("long").alias("doc")).agg(F.concat(F.lit("<Orbit>"), F.array_join(F.collect_list(osv), ""), F.lit("</Orbit>")).alias("value"))
    path = _folder(spark)
    docs.repartition(8, "doc").write.partitionBy("doc").text(path)
    v = readers.orbit_vectors(spark, f"{path}/*", "2024-01-05", "2024-01-20")
    return v.select(F.col("y").cast("long").alias("event_id"), "x", "vz")


@query("SELECT polyid, CAST(n AS BIGINT) AS burst, round(lon - 1, 4) + 0.0 AS lon1, round(lon + 1, 4) + 0.0 AS lon2, round(lat + (n - 1) * 0.2, 4) + 0.0 AS lat1, round(lat + n * 0.2, 4) + 0.0 AS lat2 FROM @frames, range(1, 3) r(n)")
def a08_annotations(spark, sf_dir):
    """Each frame's annotation has three grid lines of three points, so two bursts; one file holds one frame."""
    f = view(spark, sf_dir, "frames")
    i = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i")
    pts = f.select("polyid", "lon", "lat", i).select("*", F.explode(F.sequence(F.lit(-1), F.lit(1))).alias("j"))
    xml = F.concat(F.lit("<geolocationGridPoint><line>"), F.col("i") * 1500, F.lit("</line><pixel>"), (F.col("j") + 1) * 1000, F.lit("</pixel><latitude>"), F.round(F.col("lat") + F.col("i") * 0.2, 4), F.lit("</latitude><longitude>"), F.round(F.col("lon") + F.col("j"), 4), F.lit("</longitude></geolocationGridPoint>"))
    path = _folder(spark)
    docs = pts.groupBy("polyid").agg(F.concat(F.lit("<grid>"), F.array_join(F.collect_list(xml), ""), F.lit("</grid>")).alias("value"))
    docs.repartition(4, "polyid").write.partitionBy("polyid").text(path)
    b = readers.annotation_bursts(spark, f"{path}/*")
    return b.select(F.regexp_extract("file", r"polyid=(\d+)", 1).cast("long").alias("polyid"), F.col("burst").cast("long").alias("burst"), *[(F.round(c, 4) + F.lit(0.0)).alias(c) for c in ("lon1", "lon2", "lat1", "lat2")])


@query("SELECT bid FROM @bursts WHERE lon BETWEEN -50 AND 50 AND lat BETWEEN 0 AND 40")
def a10_clipped_pixels(spark, sf_dir):
    path = _folder(spark)
    writers.clustered(view(spark, sf_dir, "bursts").select("bid", "lon", "lat"), path, "lon", "lat", 1.0, -180.0, -90.0)
    return readers.clipped_pixels(spark, path, -50, 50, 0, 40).select("bid")


@query("SELECT id, magnitude FROM @quakes")
def a11_event_report(spark, sf_dir):
    """Half of the events first, then all: the second call appends the unseen."""
    q, path = view(spark, sf_dir, "quakes").select("id", "magnitude"), _folder(spark)
    writers.append_unseen(q.filter("id % 2 = 0"), path, ["id"])
    writers.append_unseen(q, path, ["id"])
    return spark.read.option("header", True).option("sep", ";").schema(q.schema).csv(path)


@query("SELECT id, magnitude FROM @quakes WHERE magnitude >= 6")
def a11_event_rewrite(spark, sf_dir):
    """All events first; the report is then written anew without the small ones."""
    q, path = view(spark, sf_dir, "quakes").select("id", "magnitude"), _folder(spark)
    writers.rewrite_report(q, path)
    writers.rewrite_report(q.filter("magnitude >= 6"), path)
    return spark.read.option("header", True).option("sep", ";").schema(q.schema).csv(path)


@query("SELECT strftime(epoch, '%Y-%m') AS epoch, count(*) AS n, CAST(sum(round(round(coh, 6) / 2 * 255)) AS BIGINT) AS bytes FROM @pixels GROUP BY 1")
def a12_pixel_cube(spark, sf_dir):
    path = _folder(spark)
    p = view(spark, sf_dir, "pixels").select(F.lit("f1").alias("frame"), F.date_format("epoch", "yyyy-MM").alias("epoch"), "row", "col", (F.round("coh", 6) / 2).alias("coh"), F.lit(1).alias("n_inputs"))
    writers.pixel_cube(p.repartition("epoch"), path)
    c = spark.read.option("inferSchema", True).parquet(path)
    return c.groupBy(F.date_format("epoch", "yyyy-MM").alias("epoch")).agg(F.count("*").alias("n"), F.sum("coh").alias("bytes"))


@query("SELECT CAST(fid AS VARCHAR) AS value FROM @files WHERE pol = 'VV'")
def a13_list_sink(spark, sf_dir):
    path = _folder(spark)
    writers.text_list(view(spark, sf_dir, "files").filter("pol = 'VV'"), "fid", path)
    return spark.read.text(path)
