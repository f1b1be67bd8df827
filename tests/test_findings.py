"""Cases that failed on tables larger than those of the other tests."""

import random
from collections import Counter
from datetime import datetime, timedelta
from math import isnan

import pytest
from pyspark.sql import functions as F

from fringeline import plans
from fringeline.operators import network as N
from fringeline.operators import raster as R
from fringeline.operators import spatial as S
from fringeline.plans.views import view


def _blocks(spark):
    """Two steep blocks of one frame: a phase that follows height, and one that never varies."""
    rows = [("f", r, c, 300.0 + 7 * (r + c) + 13 * (r % 3), 0.01 * (7 * (r + c) + 13 * (r % 3)) if c < 4 else 1.5) for r in range(4) for c in range(8)]
    return spark.createDataFrame([(*x[:3], x[3] * (1 + (x[2] % 4)), x[4] * (1 + (x[2] % 4)) if x[2] < 4 else x[4]) for x in rows], "frame string, row long, col long, hgt double, pha double")


def test_height_correction_with_a_block_of_equal_phases(spark):
    """Such a block has no correlation, and takes part with slope 0."""
    got = R.height_correction(_blocks(spark), ["frame"], 4).first()
    slopes = {r.bcol: r.slope for r in R.height_correlation(_blocks(spark), ["frame"], 4, robust=True).collect()}
    assert set(slopes) == {0, 1} and abs(slopes[1]) < 1e-12 and abs(got.slope - slopes[0] / 2) < 1e-9


def test_correlation_equals_that_of_spark_where_it_has_one(spark):
    rows = [(k, float(i * i % 7 + k), float((i * 5 + k) % 11)) for k in range(3) for i in range(9)] + [(0, None, 4.0), (1, 3.0, None), (7, None, 1.0)]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    for r in df.groupBy("k").agg(R.correlation("x", "y").alias("got"), F.corr("x", "y").alias("want")).collect():
        assert r.got is r.want is None if r.k == 7 else abs(r.got - r.want) < 1e-12
    flat = spark.createDataFrame([(1.0, 2.0), (200.0, 2.0)], "x double, y double")
    assert isnan(flat.agg(R.correlation("x", "y").alias("r")).first().r)


def test_frames_of_five_digits_keep_their_own_names(spark, tmp_path):
    """Four digits of a frame go into a name: 12340 to 12349 share them, and are frames of their own."""
    rows = [(i, datetime(2024, 1, 1 + i // 10, 5), 12340 + i % 10, "purchase", 1.0) for i in range(20)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    got = plans.QUERIES["f08_latest_processing"](spark, str(tmp_path)).collect()
    assert sorted((r["first"], r.frame) for r in got) == [(f"2024-01-0{d}", f) for d in (1, 2) for f in range(12340, 12350)]
    assert {r.prefix for r in got} == {"S1234"}


def test_height_correlation_keeps_steep_blocks_of_equal_phases(spark, tmp_path):
    """As the SQL does: no correlation (NaN), slope 0."""
    rows = [(i, 50 * (i // 3), i % 3, 1, 5.0, 10_000.0 * (i + 1), 0.05, "A", datetime(1995, 3, 1)) for i in range(6)]
    rows += [(10 + i, 50 * (10 + i // 3), i % 3, 1, float(i), 10_000.0 * (i + 1), 0.05, "A", datetime(1995, 3, 1)) for i in range(6)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp"
    spark.createDataFrame(rows, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.brow: (r.r, r.slope) for r in plans.QUERIES["e24_height_correlation"](spark, str(tmp_path)).collect()}
    assert set(got) == {0, 1} and isnan(got[0][0]) and got[0][1] == 0.0 and got[1] == (1.0, 0.01)


def rows_made(df, metric="numOutputRows"):
    """Result rows, and the largest number of rows that a step of the plan made, or another of its numbers."""
    found = df.collect()
    most, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        m = p.metrics().get(metric)
        most = max(most, m.get().value() if m.isDefined() else 0)
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(p.plan())
        else:
            todo += [p.children().apply(i) for i in range(p.children().size())]
    return found, most


def test_covering_files_equal_all_pairs(spark):
    """Short, long and nested files, scenes across several stretches, ties of starts and ends, another satellite without files."""
    r = random.Random(5)
    base = datetime(2024, 1, 5)
    at = lambda: base + timedelta(minutes=r.randrange(0, 2880, 10))
    files = [(i, r.randrange(2), a, a + timedelta(minutes=r.choice([0, 10, 30, 60, 90, 300, 900, 2000]))) for i in range(400) for a in [at()]]
    scenes = [(i, r.randrange(3), a, a + timedelta(minutes=r.choice([0, 1, 10, 45, 150]))) for i in range(300) for a in [at()]] + [(900, 0, None, base)]
    got = N.covering_files(spark.createDataFrame(scenes, "scene long, sat long, start timestamp, stop timestamp"), spark.createDataFrame(files, "file long, sat long, valid_from timestamp, valid_to timestamp"))
    want = {s: max(((b, f) for f, sat2, b, e in files if sat2 == sat and a and b <= a and e >= z), default=(None, None))[1] for s, sat, a, z in scenes}
    assert {x.scene: x.file for x in got.collect()} == want and sum(v is not None for v in want.values()) > 100


def test_covering_orbit_makes_no_pairs(spark, tmp_path):
    """2,000 scenes and 2,000 files of two days: every scene is covered by half of them."""
    t = F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * 43)")
    e = spark.range(4000).select(F.col("id").alias("event_id"), t.alias("ts"), F.when(F.floor(F.col("id") / 2) % 2 == 0, "signup").otherwise("purchase").alias("event_type"))
    e.write.parquet(f"{tmp_path}/events.parquet")
    found, most = rows_made(plans.QUERIES["d23_covering_orbit"](spark, str(tmp_path)))
    # the files are valid a day to both sides: the latest start is that of the file a day ahead, or the last of all
    assert len(found) == 2000 and all(x.file % 2 == x.scene % 2 and x.file % 4 < 2 for x in found)
    assert most < 100_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filled_grids_are_not_broadcast(spark, tmp_path):
    """The size of their file says little: 64 cells a row come from one array."""
    values = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: (F.pmod(F.xxhash64("vec_id", i), F.lit(200)) - 100).cast("float") / 100)
    spark.range(300).select(F.col("id").alias("vec_id"), values.cast("array<float>").alias("embedding")).write.parquet(f"{tmp_path}/embeddings.parquet")
    df = plans.QUERIES["f22_fill_gauss"](spark, str(tmp_path))
    assert "Broadcast" not in plan_of(df) and df.filter("p is not null").count() == 300 * 64


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    """20 copies each of 300 parts, 300 customers, 40 suppliers and 300 errors: places come back after 25,200 keys."""
    path = tmp_path_factory.mktemp("copies")
    k = F.col("id") % 300 * 7 + F.floor(F.col("id") / 300) * 25_200
    spark.range(6000).select(k.alias("p_partkey"), (F.col("id") % 50).cast("int").alias("p_size")).write.parquet(f"{path}/part.parquet")
    spark.range(6000).select((k + 1849).alias("c_custkey"), F.lit("n").alias("c_name"), F.lit("s").alias("c_mktsegment")).write.parquet(f"{path}/customer.parquet")
    spark.range(800).select((F.col("id") % 40 * 11 + F.floor(F.col("id") / 40) * 25_200).alias("s_suppkey")).write.parquet(f"{path}/supplier.parquet")
    spark.range(6000).select(k.alias("event_id"), F.lit(datetime(2024, 1, 3)).alias("ts"), F.lit("error").alias("event_type")).write.parquet(f"{path}/events.parquet")
    return str(path)


def places(spark, path, view_name, key):
    return [(r[0], r.lon, r.lat) for r in view(spark, path, view_name).select(key, "lon", "lat").collect()]


def in_diamonds(points, frames):
    return {(p, f) for p, x, y in points for f, a, b in frames if abs(x - a) / 5 + abs(y - b) / 4 < 1}


def test_corners_of_copies_in_polygons(spark, copies):
    """rows with the same corners are tested once, and nothing is broadcast."""
    bursts, frames = places(spark, copies, "bursts", "bid"), places(spark, copies, "frames", "polyid")
    want = set().union(*[in_diamonds([(k, x + a, y + b) for k, x, y in bursts if k < 25_200], frames) for a, b in ((-0.4, -0.1), (0.4, -0.05), (0.3, 0.1), (-0.3, 0.05))])
    df = plans.QUERIES["d08_corners_in_polygon"](spark, copies)
    got = [(r.bid, r.poly) for r in df.collect()]
    assert "Broadcast" not in plan_of(df) and len(got) == 20 * len(want) and {g for g in got if g[0] < 25_200} == want


def test_unused_corners_and_repeated_keys(spark):
    square = spark.createDataFrame([(9, i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)])], "poly long, seq int, x double, y double")
    rows = [(1, 0.5, 0.5, 5.0, 5.0), (1, 1.5, 1.5, None, None), (2, 5.0, 5.0, None, None), (3, None, None, 1.0, 1.0), (4, None, None, None, None), (5, 0.5, 0.5, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "bid long, corner1_lon double, corner1_lat double, corner2_lon double, corner2_lat double")
    assert sorted(tuple(r) for r in S.corners_in_polygons(df, square, "bid", corners=2).collect()) == [(1, 9), (3, 9), (5, 9)]


def test_nearest_of_copies(spark, copies):
    """places are paired once; the least of the bursts at the nearest place counts."""
    bursts = [b for b in places(spark, copies, "bursts", "bid") if b[0] < 25_200]
    want = {}
    for k, x, y in places(spark, copies, "volcanoes", "volc_id"):
        near = [((x - a) ** 2 + (y - b) ** 2, f) for f, a, b in bursts if abs(x - a) <= 1.5 and abs(y - b) <= 1.5]
        want[k] = min(near)[1] if near else None
    found, most = rows_made(plans.QUERIES["d28_nearest_irregular"](spark, copies))
    assert {r.volc_id: r.bid for r in found} == want and len(found) == 6000 and len(set(want.values())) > 10 and most < 20_000


def test_matches_of_copies(spark, copies, tmp_path):
    """no point has a match of its own among copies; places are paired once. Without copies every point is matched as by all pairs."""
    found, most = rows_made(plans.QUERIES["d34_match_points"](spark, copies))
    assert found == [] and most < 100_000
    r = random.Random(3)
    points, others = ([(i, r.randrange(-400, 400) / 10, r.randrange(-200, 200) / 10) for i in range(n)] for n in (150, 60))
    near = lambda p, d: [v for v, a, b in others if abs(p[1] - a) <= d and abs(p[2] - b) <= d]
    want = {p[0]: hits[0] for p in points for hits in [near(p, 1.0) or near(p, 8.0)] if len(hits) == 1}
    names = "long, lon double, lat double"
    got = S.matched_points(spark.createDataFrame(points, f"id {names}"), spark.createDataFrame(others, f"v {names}"), "id", "v", 1.0, 8.0).collect()
    assert {x.id: x.v for x in got} == want and len(got) == len(want) > 20


def test_points_of_copies_in_polygons(spark, copies):
    """a place is tested once, and nothing is broadcast."""
    want = in_diamonds([b for b in places(spark, copies, "bursts", "bid") if b[0] < 25_200], places(spark, copies, "frames", "polyid"))
    df = plans.QUERIES["d08_point_in_polygon"](spark, copies)
    got = [(r.bid, r.poly) for r in df.collect()]
    assert "Broadcast" not in plan_of(df) and len(got) == 20 * len(want) and {g for g in got if g[0] < 25_200} == want


def test_polygon_counts_of_copies(spark, copies, tmp_path):
    """4,000 customers at each of 30 places are counted by place, without a row for each of them in a polygon."""
    k = F.col("id") % 30 * 11 + F.floor(F.col("id") / 30) * 25_200
    spark.range(120_000).select(k.alias("c_custkey"), F.lit("n").alias("c_name"), F.lit("s").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.read.parquet(f"{copies}/supplier.parquet").write.parquet(f"{tmp_path}/supplier.parquet")
    inside = in_diamonds([v for v in places(spark, str(tmp_path), "volcanoes", "volc_id") if v[0] < 25_200], places(spark, copies, "frames", "polyid"))
    found, most = rows_made(plans.QUERIES["d31_polygon_mask"](spark, str(tmp_path)))
    assert {r.poly: r.pixels for r in found} == {f: 4000 * n for f, n in Counter(f for _, f in inside).items()} and most <= 120_000 < 4000 * len(inside)


def test_event_report_makes_each_pair_once(spark, copies):
    """pairs carry the columns of both sides, and go through no exchange."""
    df = plans.QUERIES["d20_event_report"](spark, copies)
    found, pairs = df.collect(), plans.QUERIES["d21_event_frames"](spark, copies).collect()
    assert sorted((r.id, r.polyid) for r in found) == sorted((r.id, r.polyid) for r in pairs) and len(found) > 5_000
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") == 1


def test_area_files_equal_all_pairs(spark):
    """bursts near each other and far apart, more than once in a file, ids of bursts and frames that occur twice, files without a burst."""
    r = random.Random(11)
    box = lambda w, h: (lambda x, y: (x, x + w, y, y + h))(r.randrange(-300, 300) / 10, r.randrange(-100, 100) / 10)
    bursts = [(i % 190, *box(0.8, 0.2)) for i in range(200)]
    frames = [(i % 55, *box(2.6, 1.8)) for i in range(60)]
    lines = [(f, r.randrange(200)) for f in range(120) for _ in range(r.randrange(6))] + [(500, i) for i in range(200)] + [(501, 3), (501, 3)]
    names = "long, lon1 double, lon2 double, lat1 double, lat2 double"
    over = {(b[0], f[0]) for b in bursts for f in frames if b[2] >= f[1] and f[2] >= b[1] and b[4] >= f[3] and f[4] >= b[3]}
    want = {(p, f) for f, b in lines for b2, p in over if b2 == b}
    got = S.area_files(spark.createDataFrame(bursts, f"bid {names}"), spark.createDataFrame(frames, f"polyid {names}"), spark.createDataFrame(lines, "fid long, bid long"))
    assert sorted(tuple(x) for x in got.collect()) == sorted(want) and len(want) > 100


def test_files_of_one_burst_need_no_distinct(spark, copies, tmp_path):
    """6,000 files of a burst that 20 frames cover; no exchange sees their 120,000 rows."""
    k = F.col("id") % 6 * 77 + F.floor(F.col("id") / 6) % 20 * 25_200
    spark.range(6000).select(F.col("id").alias("l_orderkey"), k.alias("l_partkey"), F.lit(1).alias("l_linenumber")).write.parquet(f"{tmp_path}/lineitem.parquet")
    for t in ("part", "supplier"):
        spark.read.parquet(f"{copies}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    found, most = rows_made(plans.QUERIES["d07_area_files"](spark, str(tmp_path)), "shuffleRecordsWritten")
    assert len(found) == len(set(found)) >= 120_000 and 0 < most < 60_000
