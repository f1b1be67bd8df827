"""Spatial queries: overlaps, nearest neighbours, points in polygons."""

from __future__ import annotations

from pyspark.sql import functions as F

from fringeline.operators import spatial as S
from fringeline.plans.registry import Registry
from fringeline.plans.views import view

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _v(spark, sf_dir, *names):
    return [view(spark, sf_dir, n) for n in names]


_OVERLAP = "b.lon2 >= f.lon1 AND f.lon2 >= b.lon1 AND b.lat2 >= f.lat1 AND f.lat2 >= b.lat1"


@query(f"SELECT b.bid, f.polyid FROM @bursts b JOIN @frames f ON {_OVERLAP}")
def d06_box_overlap(spark, sf_dir):
    b, f = _v(spark, sf_dir, "bursts", "frames")
    return S.boxes_overlap(b.select("bid", *S.BOX), f.select("polyid", *S.BOX)).select("bid", "polyid")


#: Four corners of bursts; twelve of frames, of which two thirds leave eight open.
_CORNERS4 = "(SELECT bid, lon - 0.4 AS x1, lon + 0.4 AS x2, lon + 0.3 AS x3, lon - 0.3 AS x4, lat - 0.1 AS y1, lat - 0.05 AS y2, lat + 0.1 AS y3, lat + 0.05 AS y4 FROM @bursts)"
_REACH = (-1.3, 1.3, 1.2, -1.2, *(0.2 * i - 0.9 for i in range(8)))


def _cornered(rows, places):
    """``rows`` with corners at offsets (lon, lat) from their centre; an offset may be null."""
    return rows.withColumns({f"corner{i}_{axis}": F.col(axis) + F.lit(d).cast("double") if not callable(d) else d(F.col(axis)) for i, pair in enumerate(places, 1) for axis, d in zip(("lon", "lat"), pair)})


def _burst_corners(spark, sf_dir):
    b = view(spark, sf_dir, "bursts").select("bid", "lon", "lat")
    return _cornered(b, [(-0.4, -0.1), (0.4, -0.05), (0.3, 0.1), (-0.3, 0.05)])


def _frame_corners(spark, sf_dir):
    f = view(spark, sf_dir, "frames").select("polyid", "lon", "lat")
    later = lambda d: lambda c: F.when(F.col("polyid") % 3 == 0, c + d)
    return _cornered(f, [(d, d / 2) if i < 4 else (later(d * 2), later(d)) for i, d in enumerate(_REACH)])


_FRAME12 = "(SELECT polyid, lon - CASE WHEN polyid % 3 = 0 THEN 1.8 ELSE 1.3 END AS lon1, lon + 1.3 AS lon2, lat - CASE WHEN polyid % 3 = 0 THEN 0.9 ELSE 0.65 END AS lat1, lat + 0.65 AS lat2 FROM @frames)"


@query(f"SELECT b.bid, f.polyid FROM {_CORNERS4} b JOIN {_FRAME12} f ON greatest(x1, x2, x3, x4) >= f.lon1 AND least(x1, x2, x3, x4) <= f.lon2 AND greatest(y1, y2, y3, y4) >= f.lat1 AND least(y1, y2, y3, y4) <= f.lat2")
def d06_corner_overlap(spark, sf_dir):
    """Boxes from corners: frames have twelve, unused ones are null and are skipped."""
    b, f = S.corner_boxes(_burst_corners(spark, sf_dir), 4), S.corner_boxes(_frame_corners(spark, sf_dir), 12)
    return S.boxes_overlap(b.select("bid", *S.BOX), f.select("polyid", *S.BOX)).select("bid", "polyid")


@query("SELECT b.bid, f.polyid FROM @bursts b JOIN @frames f ON b.lon BETWEEN f.lon1 AND f.lon2 AND b.lat BETWEEN f.lat1 AND f.lat2")
def d06_centre_overlap(spark, sf_dir):
    b, f = _v(spark, sf_dir, "bursts", "frames")
    return S.centres_in_boxes(b.select("bid", "lon", "lat"), f.select("polyid", *S.BOX)).select("bid", "polyid")


@query("SELECT v.volc_id, b.bid FROM @volcanoes v JOIN @bursts b ON v.lon BETWEEN b.lon1 - 0.3 AND b.lon2 + 0.3 AND v.lat BETWEEN b.lat1 - 0.3 AND b.lat2 + 0.3")
def d06_point_overlap(spark, sf_dir):
    v, b = _v(spark, sf_dir, "volcanoes", "bursts")
    return S.points_near_boxes(v.select("volc_id", "lon", "lat"), b.select("bid", *S.BOX), 0.3).select("volc_id", "bid")


@query(f"""SELECT DISTINCT b.bid, f.polyid AS poly FROM (SELECT bid, unnest([x1, x2, x3, x4]) AS lon, unnest([y1, y2, y3, y4]) AS lat FROM {_CORNERS4}) b JOIN @frames f ON abs(b.lon - f.lon) / 5 + abs(b.lat - f.lat) / 4 < 1""")
def d08_corners_in_polygon(spark, sf_dir):
    return S.corners_in_polygons(_burst_corners(spark, sf_dir), _diamonds(spark, sf_dir, 5.0, 4.0), "bid")


@query("""SELECT v.volc_id, n.bid FROM @volcanoes v LEFT JOIN (SELECT v.volc_id, b.bid, row_number() OVER (PARTITION BY v.volc_id ORDER BY pow(v.lon - b.lon, 2) + pow(v.lat - b.lat, 2), b.bid) AS n FROM @volcanoes v JOIN @bursts b ON abs(v.lon - b.lon) <= 1.5 AND abs(v.lat - b.lat) <= 1.5) n ON n.volc_id = v.volc_id AND n.n = 1""")
def d28_nearest_irregular(spark, sf_dir):
    return S.nearest_of_grid(*_v(spark, sf_dir, "volcanoes", "bursts"), "volc_id", "bid", 1.5)


@query(f"SELECT DISTINCT f.polyid, l.fid FROM @bursts b JOIN @frames f ON {_OVERLAP} JOIN @file_bursts l ON l.bid = b.bid")
def d07_area_files(spark, sf_dir):
    return S.area_files(*_v(spark, sf_dir, "bursts", "frames", "file_bursts"))


_DIAMOND = "abs(v.lon - f.lon) / 5 + abs(v.lat - f.lat) / 4 < 1"


@query(f"SELECT v.bid, f.polyid AS poly FROM @bursts v JOIN @frames f ON {_DIAMOND}")
def d08_point_in_polygon(spark, sf_dir):
    """Polygons are diamonds around the frames' centres, given as four vertices each."""
    return S.points_in_polygons(view(spark, sf_dir, "bursts"), _diamonds(spark, sf_dir, 5.0, 4.0), "bid")


def _diamonds(spark, sf_dir, dx, dy):
    f = view(spark, sf_dir, "frames")
    corner = [F.struct(F.lit(i).alias("seq"), (F.col("lon") + dx * a).alias("x"), (F.col("lat") + dy * b).alias("y")) for i, (a, b) in enumerate([(1, 0), (0, 1), (-1, 0), (0, -1)])]
    return f.select(F.col("polyid").alias("poly"), F.inline(F.array(*corner)))


@query("SELECT v.volc_id, f.polyid FROM @volcanoes v JOIN @frames f ON v.lon BETWEEN f.lon1 + 0.225 AND f.lon2 - 0.225 AND v.lat BETWEEN f.lat1 + 0.225 AND f.lat2 - 0.225")
def d09_points_in_frames(spark, sf_dir):
    v, f = _v(spark, sf_dir, "volcanoes", "frames")
    return S.points_in_boxes(v.select("volc_id", "lon", "lat"), f.select("polyid", *S.BOX), shrink=0.225).select("volc_id", "polyid")


@query("SELECT q.id, v.volc_id FROM @quakes q JOIN @volcanoes v ON abs(q.lon - v.lon) <= 100 / 111.111 AND abs(q.lat - v.lat) <= 100 / 111.111")
def d10_volcanoes_near(spark, sf_dir):
    q, v = _v(spark, sf_dir, "quakes", "volcanoes")
    return S.points_within(q.select("id", "lon", "lat"), v.select("volc_id", "lon", "lat"), 100 / 111.111).select("id", "volc_id")


@query("""SELECT bid, id FROM (SELECT b.bid, o.id, row_number() OVER (PARTITION BY b.bid ORDER BY sqrt(pow(b.lon - o.lon, 2) + pow(b.lat - o.lat, 2)), o.id) AS n FROM @bursts b JOIN @official o ON o.iw = b.iw
    AND least(abs(b.relorb - o.relorb), 175 - abs(b.relorb - o.relorb)) <= 1 AND abs(b.tanx - o.tanx) <= 1.5 + 1e-9 AND sqrt(pow(b.lon - o.lon, 2) + pow(b.lat - o.lat, 2)) < 1) WHERE n = 1""")
def d11_official_bursts(spark, sf_dir):
    return S.official_bursts(*_v(spark, sf_dir, "bursts", "official"))


_KM = "sqrt(pow((v.lon - b.lon) * cos(radians((v.lat + b.lat) / 2)), 2) + pow(v.lat - b.lat, 2)) * 111.111"


@query(f"""WITH d AS (SELECT v.volc_id, b.bid, {_KM} AS km FROM @volcanoes v JOIN @bursts b ON abs(v.lat - b.lat) <= 1)
    SELECT v.volc_id, n.bid, round(n.km, 6) AS km FROM @volcanoes v LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY volc_id ORDER BY km, bid) AS n FROM d WHERE km < 50) n ON n.volc_id = v.volc_id AND n.n = 1""")
def d12_nearest_burst(spark, sf_dir):
    v, b = _v(spark, sf_dir, "volcanoes", "bursts")
    return S.nearest_within(v, b, "volc_id", "bid", 50.0).select("volc_id", "bid", F.round("km", 6).alias("km"))


QUAKE_RADIUS = f"""CASE WHEN round(magnitude * 10) > 85 AND depth <= 250 THEN 2500.0 WHEN round(magnitude * 10) BETWEEN 55 AND 85 AND depth <= list_extract({list(S.QUAKE_DEPTH)}, CAST(round(magnitude * 10) AS INTEGER) - 54)
    THEN list_extract({list(S.QUAKE_KM)}, CAST(round(magnitude * 10) AS INTEGER) - 54) / 2.0 END * 360.0 / 40007.86"""


@query(f"SELECT q.id, f.polyid FROM (SELECT *, {QUAKE_RADIUS} AS r FROM @quakes) q JOIN @frames f ON q.lon + r >= f.lon1 AND f.lon2 >= q.lon - r AND q.lat + r >= f.lat1 AND f.lat2 >= q.lat - r")
def d21_event_frames(spark, sf_dir):
    return S.quake_frames(*_v(spark, sf_dir, "quakes", "frames"))


@query("SELECT bid, CAST(round((lat + 70) / 0.5) AS BIGINT) AS row_, CAST(round((lon + 180) / 0.5) AS BIGINT) AS col_ FROM @bursts")
def d28_nearest_pixel(spark, sf_dir):
    p = S.nearest_pixels(view(spark, sf_dir, "bursts").select("bid", "lon", "lat"), -180.0, -70.0, 0.5, 0.5)
    return p.select("bid", F.col("row").alias("row_"), F.col("col").alias("col_"))


@query("""WITH w AS (SELECT bid, lon1, lon2, lat1, lat2, lead(bid) OVER o AS nb, lead(lon1) OVER o AS a1, lead(lon2) OVER o AS a2, lead(lat1) OVER o AS b1, lead(lat2) OVER o AS b2 FROM (SELECT bid, relorb, iw, tanx, lon - 60 AS lon1, lon + 60 AS lon2, lat - 40 AS lat1, lat + 40 AS lat2 FROM @bursts) WINDOW o AS (PARTITION BY relorb % 3, iw ORDER BY tanx, bid))
    SELECT bid, nb AS next, round(greatest(lon1, a1), 6) AS lon1, round(least(lon2, a2), 6) AS lon2 FROM w WHERE nb IS NOT NULL AND greatest(lon1, a1) <= least(lon2, a2) AND greatest(lat1, b1) <= least(lat2, b2)""")
def d29_adjacent_overlap(spark, sf_dir):
    wide = {"lon1": F.col("lon") - 60, "lon2": F.col("lon") + 60, "lat1": F.col("lat") - 40, "lat2": F.col("lat") + 40}
    b = view(spark, sf_dir, "bursts").withColumns({"relorb": F.col("relorb") % 3, **wide})
    return S.adjacent_overlaps(b).select("bid", "next", F.round("lon1", 6).alias("lon1"), F.round("lon2", 6).alias("lon2"))


@query(f"SELECT f.polyid AS poly, count(*) AS pixels FROM @volcanoes v JOIN @frames f ON {_DIAMOND} GROUP BY f.polyid")
def d31_polygon_mask(spark, sf_dir):
    return S.polygon_counts(view(spark, sf_dir, "volcanoes"), _diamonds(spark, sf_dir, 5.0, 4.0)).withColumnRenamed("n", "pixels")


@query("""WITH c AS (SELECT polyid, lon, lat, unnest([5.0, 0.0, -5.0, 0.0]::DOUBLE[]) AS dx, unnest([0.0, 4.0, 0.0, -4.0]::DOUBLE[]) AS dy, unnest([0.0, -5.0, 0.0, 5.0]::DOUBLE[]) AS ex, unnest([4.0, 0.0, -4.0, 0.0]::DOUBLE[]) AS ey FROM @frames),
    e AS (SELECT polyid AS poly, lon + dx AS x, lat + dy AS y, lon + ex AS x2, lat + ey AS y2, lon, lat FROM c),
    g AS (SELECT poly, "row", col, count(CASE WHEN (y > -89.875 + 0.25 * "row") <> (y2 > -89.875 + 0.25 * "row") AND -179.875 + 0.25 * col < (x2 - x) * ((-89.875 + 0.25 * "row") - y) / (y2 - y) + x THEN 1 END) AS n
      FROM e, LATERAL (SELECT unnest(range(CAST(greatest(floor((lat - 4 + 89.875) / 0.25) - 1, 0) AS BIGINT), CAST(least(ceil((lat + 4 + 89.875) / 0.25) + 2, 720) AS BIGINT))) AS "row"),
      LATERAL (SELECT unnest(range(CAST(greatest(floor((lon - 5 + 179.875) / 0.25) - 1, 0) AS BIGINT), CAST(least(ceil((lon + 5 + 179.875) / 0.25) + 2, 1440) AS BIGINT))) AS col) GROUP BY 1, 2, 3)
    SELECT poly, "row", min(col) AS first, max(col) AS last, count(*) AS pixels FROM g WHERE n % 2 = 1 GROUP BY 1, 2""")
def d31_grid_mask(spark, sf_dir):
    """Cells of the globe's grid of a quarter degree in each polygon, by row."""
    cells = S.pixels_in_polygons(_diamonds(spark, sf_dir, 5.0, 4.0), -179.875, -89.875, 0.25, 0.25, 720, 1440)
    return cells.groupBy("poly", "row").agg(F.min("col").alias("first"), F.max("col").alias("last"), F.count("*").alias("pixels"))


@query("""WITH h AS (SELECT q.id, v.volc_id FROM @quakes q JOIN @volcanoes v ON abs(q.lon - v.lon) <= 1 AND abs(q.lat - v.lat) <= 1), w AS (SELECT q.id, v.volc_id FROM @quakes q JOIN @volcanoes v ON abs(q.lon - v.lon) <= 8 AND abs(q.lat - v.lat) <= 8
    WHERE q.id NOT IN (SELECT id FROM h)), a AS (SELECT * FROM h UNION ALL SELECT * FROM w) SELECT id, min(volc_id) AS volc_id FROM a GROUP BY id HAVING count(*) = 1""")
def d34_match_points(spark, sf_dir):
    """Narrow search first; only points without a hit are searched widely; accepted with exactly one hit."""
    q, v = _v(spark, sf_dir, "quakes", "volcanoes")
    return S.matched_points(q.select("id", "lon", "lat"), v.select("volc_id", "lon", "lat"), "id", "volc_id", 1.0, 8.0)


@query(f"SELECT f.polyid, b.relorb, b.iw, count(*) AS n FROM @bursts b JOIN @frames f ON {_OVERLAP} GROUP BY 1, 2, 3")
def e34_burst_list(spark, sf_dir):
    b, f = _v(spark, sf_dir, "bursts", "frames")
    return S.boxes_overlap(b.select("bid", "relorb", "iw", *S.BOX), f.select("polyid", *S.BOX)).groupBy("polyid", "relorb", "iw").agg(F.count("*").alias("n"))


@query("SELECT bid FROM @bursts b WHERE NOT EXISTS (SELECT 1 FROM @frames f WHERE b.lon1 >= f.lon1 AND b.lon2 <= f.lon2 AND b.lat1 >= f.lat1 AND b.lat2 <= f.lat2)")
def e22_not_contained(spark, sf_dir):
    b, f = _v(spark, sf_dir, "bursts", "frames")
    return S.not_contained(b, f, "bid", "polyid").select("bid")
