"""Spatial joins on longitude and latitude in degrees.

A range or nearest join would plan as a nested loop, so every operator here adds an equi key: boxes are exploded to the grid cells
they touch, points have one cell, and the exact test follows the join. Boxes across the 180th meridian are not handled.

Tables with cells are joined by sorted keys: their files are small, so that they would be broadcast through the driver, which they don't fit.
Points at one place are tested once where a result depends on the place alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BOX = ("lon1", "lon2", "lat1", "lat2")
KM_PER_DEGREE = 111.111


def bounding_box(rows: DataFrame, by: list[str]) -> DataFrame:
    """The union of boxes."""
    return rows.groupBy(*by).agg(F.min("lon1").alias("lon1"), F.max("lon2").alias("lon2"), F.min("lat1").alias("lat1"), F.max("lat2").alias("lat2"))


def corner_boxes(rows: DataFrame, corners: int) -> DataFrame:
    """``rows`` with the box (lon1, lon2, lat1, lat2) of their columns corner1_lon, corner1_lat, ... Corners that are null, as most of a
    frame's twelve are, are left out; rows without any corner have no box and are dropped."""
    ends = {}
    for axis in ("lon", "lat"):
        c = [F.col(f"corner{i}_{axis}") for i in range(1, corners + 1)]
        ends |= {f"{axis}1": F.least(*c), f"{axis}2": F.greatest(*c)}
    return rows.withColumns(ends).filter("lon1 is not null and lat1 is not null")


def centres_in_boxes(rows: DataFrame, boxes: DataFrame, size: float = 1.0) -> DataFrame:
    """Rows whose centre (lon, lat) lies in a box, with its columns."""
    return points_in_boxes(rows, boxes, size)


def points_near_boxes(points: DataFrame, boxes: DataFrame, tolerance: float, size: float = 1.0) -> DataFrame:
    """Points in boxes that are wider by ``tolerance`` degrees on every side."""
    wide = boxes.withColumns({"lon1": F.col("lon1") - tolerance, "lon2": F.col("lon2") + tolerance, "lat1": F.col("lat1") - tolerance, "lat2": F.col("lat2") + tolerance})
    return points_in_boxes(points, wide, size)


def mean_centre(points: DataFrame, by: str) -> DataFrame:
    """Spherical mean: unit vectors are averaged."""
    la, lo = F.radians("lat"), F.radians("lon")
    v = points.groupBy(by).agg(F.avg(F.cos(la) * F.cos(lo)).alias("x"), F.avg(F.cos(la) * F.sin(lo)).alias("y"), F.avg(F.sin(la)).alias("z"))
    return v.select(by, F.degrees(F.atan2("y", "x")).alias("lon"), F.degrees(F.atan2(F.col("z"), F.hypot("x", "y"))).alias("lat"))


def _cells(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size), F.floor(high / size))


def _with_box_cells(boxes: DataFrame, size: float, grow: float = 0.0) -> DataFrame:
    wide = boxes.withColumn("__x", F.explode(_cells(F.col("lon1") - grow, F.col("lon2") + grow, size)))
    return wide.withColumn("__y", F.explode(_cells(F.col("lat1") - grow, F.col("lat2") + grow, size)))


def _with_point_cell(points: DataFrame, size: float) -> DataFrame:
    return points.withColumns({"__x": F.floor(F.col("lon") / size), "__y": F.floor(F.col("lat") / size)})


def boxes_overlap(left: DataFrame, right: DataFrame, size: float = 1.0) -> DataFrame:
    """Pairs of overlapping boxes, once each: columns of ``left``, then those of ``right`` with its box named r_lon1 etc.

    A pair is kept only in the lowest cell that both boxes touch, so no distinct is needed.
    """
    r = _with_box_cells(right, size).withColumnsRenamed({c: f"r_{c}" for c in BOX})
    joined = _with_box_cells(left, size).join(r.hint("merge"), ["__x", "__y"])
    hit = (F.col("lon2") >= F.col("r_lon1")) & (F.col("r_lon2") >= F.col("lon1")) & (F.col("lat2") >= F.col("r_lat1")) & (F.col("r_lat2") >= F.col("lat1"))
    first = (F.col("__x") == F.floor(F.greatest("lon1", "r_lon1") / size)) & (F.col("__y") == F.floor(F.greatest("lat1", "r_lat1") / size))
    return joined.filter(hit & first).drop("__x", "__y")


def points_in_boxes(points: DataFrame, boxes: DataFrame, size: float = 1.0, shrink: float = 0.0) -> DataFrame:
    """Points (lon, lat) inside boxes shrunk on every side."""
    inside = F.col("lon").between(F.col("lon1") + shrink, F.col("lon2") - shrink) & F.col("lat").between(F.col("lat1") + shrink, F.col("lat2") - shrink)
    return _with_point_cell(points, size).join(_with_box_cells(boxes, size).hint("merge"), ["__x", "__y"]).filter(inside).drop("__x", "__y")


def points_within(points: DataFrame, others: DataFrame, degrees: float) -> DataFrame:
    """Pairs whose longitudes and latitudes differ by ``degrees`` at most (a square); the others' places are r_lon, r_lat."""
    o = others.withColumnsRenamed({"lon": "r_lon", "lat": "r_lat"})
    size = max(degrees, 1e-6)
    around = lambda c: F.explode(F.sequence(F.floor(F.col(c) / size) - 1, F.floor(F.col(c) / size) + 1))
    o = o.withColumn("__x", around("r_lon")).withColumn("__y", around("r_lat"))
    near = (F.abs(F.col("lon") - F.col("r_lon")) <= degrees) & (F.abs(F.col("lat") - F.col("r_lat")) <= degrees)
    return _with_point_cell(points, size).join(o.hint("merge"), ["__x", "__y"]).filter(near).drop("__x", "__y")


def distance_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Equirectangular."""
    x = (lon1 - lon2) * F.cos(F.radians((lat1 + lat2) / 2))
    y = lat1 - lat2
    return F.sqrt(x * x + y * y) * KM_PER_DEGREE


def nearest_within(points: DataFrame, others: DataFrame, key: str, other: str, km: float) -> DataFrame:
    """(key, other, km): the nearest other point of every point, null beyond ``km``."""
    # A degree of longitude is shorter towards the poles: a point looks as far to both sides as its own latitude asks for, and
    # other points have one cell. Beyond 87 degrees the search goes no wider.
    size = km / KM_PER_DEGREE
    reach = F.lit(size) / F.cos(F.radians(F.least(F.abs("lat") + size, F.lit(87.0))))
    around = lambda c, r: F.explode(F.sequence(F.floor((F.col(c) - r) / size), F.floor((F.col(c) + r) / size)))
    p = points.select(key, "lon", "lat").withColumn("__x", around("lon", reach)).withColumn("__y", around("lat", F.lit(size)))
    near = p.join(_with_point_cell(others.select(other, F.col("lon"), F.col("lat")), size).withColumnsRenamed({"lon": "r_lon", "lat": "r_lat"}), ["__x", "__y"])
    d = distance_km(F.col("lon"), F.col("lat"), F.col("r_lon"), F.col("r_lat"))
    best = near.withColumn("km", d).filter(F.col("km") < km).groupBy(key).agg(F.min_by(other, F.struct("km", other)).alias(other), F.min("km").alias("km"))
    return points.select(key).join(best, key, "left")


def polygon_edges(vertices: DataFrame) -> DataFrame:
    """vertices (poly, seq, x, y) -> edges with both ends; rings are closed, polygons of three vertices or fewer dropped."""
    w = Window.partitionBy("poly").orderBy("seq")
    every = Window.partitionBy("poly")
    rows = vertices.withColumns({"n": F.count("*").over(every), "x2": F.lead("x").over(w), "y2": F.lead("y").over(w), "x0": F.first("x").over(w), "y0": F.first("y").over(w)})
    return rows.filter("n > 3").select("poly", "x", "y", F.coalesce("x2", "x0").alias("x2"), F.coalesce("y2", "y0").alias("y2"))


def _crossing(y: Column, edge: Column | None = None) -> tuple[Column, Column]:
    """Whether an edge, of the row or a struct, crosses the parallel of latitude y (its lower end belongs to it), and where; null for a level edge."""
    x1, y1, x2, y2 = (F.col(c) if edge is None else edge[c] for c in ("x", "y", "x2", "y2"))
    spans = (y1 > y) != (y2 > y)
    return spans, (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1


def banded_edges(vertices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges listed in the bands of latitude that they touch, (poly, band, x, y, x2, y2), and each polygon's box and bands, (poly, lon1, lon2, lat1,
    lat2, bands).

    A polygon of n edges has up to n bands, as many as keep the list at three rows an edge: 2 n by its height over the way its edges
    go up and down. A parallel then meets few edges that it doesn't cross.
    """
    edges = polygon_edges(vertices)
    way = F.sum(F.abs(F.col("y2") - F.col("y")))
    n, height = F.count("*"), F.max("y") - F.min("y")
    bands = F.greatest(F.lit(1), F.least(n, F.floor(2 * n * height / F.nullif(way, F.lit(0.0))))).cast("int")
    boxes = edges.groupBy("poly").agg(F.min("x").alias("lon1"), F.max("x").alias("lon2"), F.min("y").alias("lat1"), F.max("y").alias("lat2"), F.coalesce(bands, F.lit(1)).alias("bands"))
    low, high = F.least("y", "y2"), F.greatest("y", "y2")
    listed = edges.filter("y != y2").join(boxes.select("poly", "lat1", "lat2", "bands").hint("merge"), "poly")
    return listed.select("poly", F.explode(F.sequence(band_of(low), band_of(high))).alias("band"), "x", "y", "x2", "y2"), boxes


def band_of(lat: Column) -> Column:
    """Band of a latitude within lat1..lat2; it never falls where the latitude rises."""
    share = (lat - F.col("lat1")) / F.nullif(F.col("lat2") - F.col("lat1"), F.lit(0.0))
    return F.least(F.greatest(F.floor(F.coalesce(share, F.lit(0.0)) * F.col("bands")), F.lit(0)), F.col("bands") - 1).cast("int")


def places_in_polygons(places: DataFrame, vertices: DataFrame, size: float = 1.0) -> DataFrame:
    """places (lon, lat, ...) with the column ``poly``, a row for each polygon that they lie in, by ray casting: a place meets the polygons whose box it is
    in, and of each the edges of its own band of latitude, which come as one row."""
    edges, boxes = banded_edges(vertices)
    banded = edges.groupBy("poly", "band").agg(F.collect_list(F.struct("x", "y", "x2", "y2")).alias("__edges"))
    near = points_in_boxes(places, boxes, size).withColumn("band", band_of(F.col("lat"))).drop(*BOX, "bands")

    def crossed(e: Column) -> Column:
        spans, x = _crossing(F.col("lat"), e)
        return spans & (F.col("lon") < x)

    inside = near.join(banded.hint("merge"), ["poly", "band"]).filter(F.size(F.filter("__edges", crossed)) % 2 == 1)
    return inside.select(*places.columns, "poly")


def points_in_polygons(points: DataFrame, vertices: DataFrame, key: str, size: float = 1.0) -> DataFrame:
    """(key, poly): a row for each polygon that a point lies in. Places are tested once, whatever number of points they have."""
    points = points.select(key, "lon", "lat")
    inside = places_in_polygons(points.select("lon", "lat").distinct(), vertices, size)
    return points.join(inside.hint("merge"), ["lon", "lat"]).select(key, "poly")


def polygon_counts(points: DataFrame, vertices: DataFrame, size: float = 1.0) -> DataFrame:
    """(poly, n): number of points in each polygon that has any, from the number at each place."""
    inside = places_in_polygons(points.groupBy("lon", "lat").agg(F.count("*").alias("n")), vertices, size)
    return inside.groupBy("poly").agg(F.sum("n").alias("n"))


def polygon_spans(vertices: DataFrame, lat0: float, step_lat: float, rows: int) -> DataFrame:
    """(poly, row, lon1, lon2): stretches of a grid's rows that lie in a polygon, from lon1 up to lon2, which is outside.

    A scanline fill: an edge gives a row for each grid row that it crosses, crossings are sorted along the row, and each odd one begins a
    stretch that the next one ends. Row r is at latitude lat0 + step_lat r.
    """
    edges = polygon_edges(vertices).filter("y != y2")
    ends = [(F.col(c) - lat0) / step_lat for c in ("y", "y2")]
    first, last = F.greatest(F.floor(F.least(*ends)) - 1, F.lit(0)), F.least(F.ceil(F.greatest(*ends)) + 1, F.lit(rows - 1))
    # a row more on both sides, as quotients are rounded; the test is that of points
    row = F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))).alias("row")
    spans, x = _crossing(F.lit(lat0) + F.lit(step_lat) * F.col("row"))
    crossed = edges.select("*", row).filter(spans).select("poly", "row", x.alias("lon1"))
    along = Window.partitionBy("poly", "row").orderBy("lon1")
    pairs = crossed.withColumns({"lon2": F.lead("lon1").over(along), "n": F.row_number().over(along)})
    return pairs.filter("n % 2 = 1").select("poly", "row", "lon1", "lon2")


def pixels_in_polygons(vertices: DataFrame, lon0: float, lat0: float, step_lon: float, step_lat: float, rows: int, cols: int) -> DataFrame:
    """(poly, row, col): cells of a regular grid whose centre lies in a polygon, as points_in_polygons() has it."""
    spans = polygon_spans(vertices, lat0, step_lat, rows)
    ends = [(F.col(c) - lon0) / step_lon for c in ("lon1", "lon2")]
    first, last = F.greatest(F.floor(F.least(*ends)) - 1, F.lit(0)), F.least(F.ceil(F.greatest(*ends)) + 1, F.lit(cols - 1))
    col = F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))).alias("col")
    lon = F.lit(lon0) + F.lit(step_lon) * F.col("col")
    return spans.select("*", col).filter((lon >= F.col("lon1")) & (lon < F.col("lon2"))).select("poly", "row", "col")


def masked_by_polygons(pixels: DataFrame, vertices: DataFrame, lon0: float, lat0: float, step_lon: float, step_lat: float, rows: int, cols: int) -> DataFrame:
    """``pixels`` (row, col, ...) that lie in any polygon."""
    inside = pixels_in_polygons(vertices, lon0, lat0, step_lon, step_lat, rows, cols)
    return pixels.join(inside.select("row", "col").distinct(), ["row", "col"], "left_semi")


def corners_in_polygons(rows: DataFrame, vertices: DataFrame, key: str, corners: int = 4, size: float = 1.0) -> DataFrame:
    """(key, poly): polygons in which any of a row's corners lies. Rows with the same corners are tested once, in the name of the least of them."""
    each = F.array(*[F.struct(F.col(f"corner{i}_lon").alias("lon"), F.col(f"corner{i}_lat").alias("lat")) for i in range(1, corners + 1)])
    known = F.filter(F.flatten(F.collect_list(each)), lambda c: c["lon"].isNotNull() & c["lat"].isNotNull())
    # one row for each key, so that its polygons are distinct at the end
    own = rows.groupBy(key).agg(F.array_sort(F.array_distinct(known)).alias("__c"))
    names = own.groupBy("__c").agg(F.min(key).alias("__name"))
    inside = points_in_polygons(names.select("__name", F.inline("__c")), vertices, "__name", size).distinct()
    members = own.join(names.hint("merge"), "__c").select(key, "__name")
    return members.join(inside.hint("merge"), "__name").select(key, "poly")


#: Bursts of a file that are held against each other; a larger file's are all taken to share frames.
FILE_BURSTS = 64


def area_files(bursts: DataFrame, frames: DataFrame, file_bursts: DataFrame) -> DataFrame:
    """(polyid, fid), each once: the files with a burst (bid) whose box overlaps a frame's.

    Only files with bursts so near each other that one frame may overlap two can have a frame twice. Their rows alone are made distinct; those of a
    burst that is far from all others of its file are left as they come.
    """
    # as an id may occur twice, a frame reaches over all its boxes
    whole = bounding_box(frames, ["polyid"]).agg(F.max(F.col("lon2") - F.col("lon1")).alias("fx"), F.max(F.col("lat2") - F.col("lat1")).alias("fy"))
    own = bursts.agg(F.max(F.col("lon2") - F.col("lon1")).alias("bx"), F.max(F.col("lat2") - F.col("lat1")).alias("by"))
    # one row; a little wider, as places are sent as floats
    reach = whole.crossJoin(F.broadcast(own)).select((F.col("fx") + F.col("bx") + 1e-3).alias("__rx"), (F.col("fy") + F.col("by") + 1e-3).alias("__ry"))
    lines = file_bursts.select("fid", "bid").join(bursts.select("bid", F.col("lon1").cast("float").alias("x"), F.col("lat1").cast("float").alias("y")).hint("merge"), "bid")
    files = lines.groupBy("fid").agg(F.collect_list(F.struct("bid", "x", "y")).alias("__all")).crossJoin(F.broadcast(reach))

    def crowded(one: Column) -> Column:
        near = lambda other: (other["bid"] == one["bid"]) | ((F.abs(other["x"] - one["x"]) <= F.col("__rx")) & (F.abs(other["y"] - one["y"]) <= F.col("__ry")))
        return F.struct(one["bid"].alias("bid"), ((F.size("__all") > FILE_BURSTS) | (F.size(F.filter("__all", near)) > 1)).alias("__near"))

    lines = files.select("fid", F.inline(F.transform("__all", crowded)))
    # both sides of the join below are dealt by burst
    hits = boxes_overlap(bursts.select("bid", *BOX), frames.select("polyid", *BOX)).select("bid", "polyid").repartition("bid").distinct()
    found = lines.join(hits.hint("merge"), "bid").select("polyid", "fid", "__near")
    return found.filter("not __near").drop("__near").unionByName(found.filter("__near").drop("__near").distinct())


def official_bursts(bursts: DataFrame, official: DataFrame, max_seconds: float = 1.5, max_degrees: float = 1.0) -> DataFrame:
    """(bid, id): the nearest official burst of the same swath, a track one off at most (175 is next to 1), and close in time and place."""
    cell = lambda c: F.floor(c / max_seconds)
    b = bursts.select("bid", "iw", "relorb", "tanx", "lon", "lat").withColumn("__t", F.explode(F.sequence(cell(F.col("tanx")) - 1, cell(F.col("tanx")) + 1)))
    o = official.select("id", "iw", *[F.col(c).alias(f"o_{c}") for c in ("relorb", "tanx", "lon", "lat")]).withColumn("__t", cell(F.col("o_tanx")))
    step = F.abs(F.col("relorb") - F.col("o_relorb"))
    d = F.sqrt(F.pow(F.col("lon") - F.col("o_lon"), 2) + F.pow(F.col("lat") - F.col("o_lat"), 2))
    near = b.join(o, ["iw", "__t"]).withColumn("d", d).filter((F.least(step, 175 - step) <= 1) & (F.abs(F.col("tanx") - F.col("o_tanx")) <= max_seconds + 1e-9) & (F.col("d") < max_degrees))
    return near.groupBy("bid").agg(F.min_by("id", F.struct("d", "id")).alias("id"))


#: For magnitudes 5.5, 5.6, ... 8.5 the distance in km that an earthquake may act over, and the depth in km to which it may.
QUAKE_KM = (20, 20, 21, 25, 30, 36, 42, 50, 60, 71, 84, 100, 119, 141, 167, 199, 236, 280, 333, 396, 471, 559, 664, 790, 938, 1115, 1325, 1575, 1872, 2225, 2500)
QUAKE_DEPTH = (10, 11, 12, 14, 16, 18, 21, 24, 28, 32, 36, 42, 48, 55, 63, 73, 83, 96, 110, 127, 146, 168, 193, 222, 250, 250, 250, 250, 250, 250, 250)
#: Degrees of a great circle in a km.
DEGREES_PER_KM = 360.0 / 40007.86


def quake_radius(magnitude: Column, depth: Column) -> Column:
    """Half the tabled distance as ``radius_deg`` degrees; 2500 km, not halved, above magnitude 8.5; null where the table has no entry."""
    tenth = F.round(magnitude * 10).cast("int") - 55
    km, deepest = (F.get(F.array(*[F.lit(float(x)) for x in t]), tenth) for t in (QUAKE_KM, QUAKE_DEPTH))
    small = F.when((tenth >= 0) & (tenth < len(QUAKE_KM)) & (depth <= deepest), km / 2)
    return F.when((tenth >= len(QUAKE_KM)) & (depth <= 250), F.lit(2500.0)).otherwise(small) * DEGREES_PER_KM


def quake_frame_rows(quakes: DataFrame, frames: DataFrame, size: float = 4.0) -> DataFrame:
    """Pairs of an earthquake and a frame whose box overlaps the area that it may have moved, with the other columns of both (but the earthquake's
    place and size), so that the pairs, which are many, needn't be joined with either again."""
    areas = quakes.withColumn("r", quake_radius(F.col("magnitude"), F.col("depth"))).filter("r is not null")
    own = [c for c in quakes.columns if c not in ("lon", "lat", "magnitude", "depth")]
    areas = areas.select(*own, (F.col("lon") - F.col("r")).alias("lon1"), (F.col("lon") + F.col("r")).alias("lon2"), (F.col("lat") - F.col("r")).alias("lat1"), (F.col("lat") + F.col("r")).alias("lat2"))
    return boxes_overlap(areas, frames, size).drop(*BOX).withColumnsRenamed({f"r_{c}": c for c in BOX})


def quake_frames(quakes: DataFrame, frames: DataFrame, size: float = 4.0) -> DataFrame:
    """(id, polyid): frames whose box overlaps the area that an earthquake may have moved."""
    return quake_frame_rows(quakes.select("id", "lon", "lat", "magnitude", "depth"), frames.select("polyid", *BOX), size).select("id", "polyid")


def nearest_pixels(points: DataFrame, lon0: float, lat0: float, step_lon: float, step_lat: float) -> DataFrame:
    """Grid row and column nearest to each point of a regular grid, to join on."""
    return points.withColumns({"row": F.round((F.col("lat") - lat0) / step_lat).cast("long"), "col": F.round((F.col("lon") - lon0) / step_lon).cast("long")})


def nearest_of_grid(points: DataFrame, grid: DataFrame, key: str, cell: str, degrees: float) -> DataFrame:
    """(key, cell): the grid point nearest to each point, for grids without regular steps; null beyond ``degrees`` in either axis. Of grid points at one
    place the least counts; each place is searched from once."""
    points = points.select(key, "lon", "lat")
    near = points_within(points.select("lon", "lat").distinct(), grid.groupBy("lon", "lat").agg(F.min(cell).alias(cell)), degrees)
    far = F.pow(F.col("lon") - F.col("r_lon"), 2) + F.pow(F.col("lat") - F.col("r_lat"), 2)
    best = near.groupBy("lon", "lat").agg(F.min(F.struct(far.alias("__far"), cell)).alias("__best"))
    own = points.join(best.hint("merge"), ["lon", "lat"]).groupBy(key).agg(F.min("__best").alias("__best"))
    return points.select(key).join(own.hint("merge"), key, "left").select(key, F.col(f"__best.{cell}").alias(cell))


def counted_within(points: DataFrame, others: DataFrame, key: str, other: str, degrees: float) -> DataFrame:
    """(key, n, other): how many other points lie within ``degrees`` of a point (a square), and the least of them; points without any are left out.
    Places are paired, with the number of points they have."""
    places = others.groupBy("lon", "lat").agg(F.count("*").alias("n"), F.min(other).alias(other))
    seen = points_within(points.select("lon", "lat").distinct(), places, degrees).groupBy("lon", "lat").agg(F.sum("n").alias("n"), F.min(other).alias(other))
    return points.select(key, "lon", "lat").join(seen.hint("merge"), ["lon", "lat"]).groupBy(key).agg(F.sum("n").alias("n"), F.min(other).alias(other))


def matched_points(points: DataFrame, others: DataFrame, key: str, other: str, near: float, wide: float) -> DataFrame:
    """(key, other) of the points with exactly one other point within ``near`` degrees or, where none is, within ``wide``."""
    first = counted_within(points, others, key, other, near)
    rest = points.join(first.select(key).hint("merge"), key, "left_anti")
    return first.unionByName(counted_within(rest, others, key, other, wide)).filter("n = 1").select(key, other)


def adjacent_overlaps(bursts: DataFrame) -> DataFrame:
    """Intersection boxes of bursts that follow each other in a swath of a track."""
    w = Window.partitionBy("relorb", "iw").orderBy("tanx", "bid")
    rows = bursts.withColumns({"next": F.lead("bid").over(w), **{f"n_{c}": F.lead(c).over(w) for c in BOX}})
    box = {"lon1": F.greatest("lon1", "n_lon1"), "lon2": F.least("lon2", "n_lon2"), "lat1": F.greatest("lat1", "n_lat1"), "lat2": F.least("lat2", "n_lat2")}
    return rows.filter("next is not null").withColumns({f"o_{c}": e for c, e in box.items()}).filter("o_lon1 <= o_lon2 and o_lat1 <= o_lat2").select("bid", "next", *[F.col(f"o_{c}").alias(c) for c in BOX])


def not_contained(boxes: DataFrame, others: DataFrame, key: str, other: str, size: float = 1.0) -> DataFrame:
    """Boxes that lie in no other box (of another id, where both tables are the same)."""
    pairs = boxes_overlap(boxes.select(key, *BOX), others.select(F.col(other).alias("__other"), *BOX), size)
    inside = (F.col("lon1") >= F.col("r_lon1")) & (F.col("lon2") <= F.col("r_lon2")) & (F.col("lat1") >= F.col("r_lat1")) & (F.col("lat2") <= F.col("r_lat2"))
    hit = pairs.filter(inside if key != other else inside & (F.col(key) != F.col("__other"))).select(key).distinct()
    return boxes.join(hit, key, "left_anti")
