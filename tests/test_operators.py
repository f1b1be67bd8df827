"""Small fixtures with known answers: traps of the semantics, round trips, and operators without a SQL form."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fringeline.functions import scalar as S
from fringeline.operators import catalogue as C
from fringeline.operators import lsq as L
from fringeline.operators import network as N
from fringeline.operators import raster as R
from fringeline.operators import spatial as P

D = dt.date


def day(n):
    return D(2020, 1, 1) + dt.timedelta(days=n)


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()[0]


def test_orbits_and_pairs(spark):
    assert [one(spark, S.relative_orbit(F.col("o")), o=o) for o in (73, 72, 74, 248)] == [1, 175, 2, 1]
    p = one(spark, S.pair_dates(F.col("p")), p="20200101_20200113")
    assert (p.epoch1, p.epoch2, p.btemp) == (D(2020, 1, 1), D(2020, 1, 13), 12)
    assert one(spark, S.pair_dates(F.col("p")), p="rubbish_x").btemp is None


def test_wrap_boundaries(spark):
    assert one(spark, S.wrap(F.col("a")), a=math.pi) == pytest.approx(math.pi)
    assert one(spark, S.wrap_mod(F.col("a")), a=math.pi) == pytest.approx(-math.pi)
    for a in np.linspace(-20, 20, 41):
        assert -math.pi <= one(spark, S.wrap(F.col("a")), a=float(a)) <= math.pi


def test_phase_pdf_integrates_to_one(spark):
    x = spark.range(2000).select(((F.col("id") + 0.5) / 2000 * 2 * F.pi() - F.pi()).alias("x"))
    for density in (S.phase_pdf(F.col("x"), F.lit(0.6)), S.phase_pdf_looks(F.col("x"), F.lit(0.6), 4)):
        assert x.agg(F.sum(density) * 2 * math.pi / 2000).first()[0] == pytest.approx(1.0, abs=2e-3)
    one_look, looks = (x.agg(F.max(f)).first()[0] for f in (S.phase_pdf(F.col("x"), F.lit(0.6)), S.phase_pdf_looks(F.col("x"), F.lit(0.6), 1)))
    assert one_look == pytest.approx(looks, rel=1e-6)


def test_accents(spark):
    assert one(spark, S.strip_accents(F.col("s")), s="Popocatépetl 'Ñ'") == "Popocatepetl N"


def test_criticality(spark):
    bursts = spark.createDataFrame([(i, 1, float(i)) for i in range(5)], "bid long, iw int, tanx double")
    frame = spark.createDataFrame([(1, i) for i in range(5)], "polyid long, bid long")
    got = spark.createDataFrame([(1, "edge", i) for i in (0, 1, 2)] + [(1, "hole", i) for i in (0, 1, 4)] + [(1, "all", i) for i in range(5)], "polyid long, acq_date string, bid long")
    # two files of a date see the same burst
    seen = got.withColumn("fid", F.monotonically_increasing_id())
    seen = seen.unionByName(seen.withColumn("fid", -F.col("fid") - 1))
    rows = {r.acq_date: (r.missing, r.interior_missing) for r in C.completeness(frame, bursts, seen.select("fid", "bid"), seen.select("fid", "acq_date")).collect()}
    assert rows == {"edge": (2, False), "hole": (2, True), "all": (0, False)}


def test_files_near_midnight(spark):
    t = dt.datetime
    files = spark.createDataFrame([(1, 1, t(2020, 1, 1, 23, 59), 0), (1, 2, t(2020, 1, 2, 0, 1), 0), (1, 3, t(2020, 1, 3, 0, 1), 1)], "polyid long, fid long, acq_ts timestamp, sat int")
    ref = spark.createDataFrame([(1, D(2020, 1, 2), 1439)], "polyid long, date date, minute int")
    assert sorted(r.fid for r in C.files_near_midnight(files, ref).collect()) == [1, 2]
    ref = spark.createDataFrame([(1, D(2020, 1, 2), 700)], "polyid long, date date, minute int")
    assert [r.fid for r in C.files_near_midnight(files, ref).collect()] == [2]


def test_left_anti_ignores_nulls(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "x long"), spark.createDataFrame([(1,), (None,)], "x long")
    assert [r.x for r in C.without_match(a, b, ["x"]).collect()] == [2]


def test_insert_numbered(spark):
    t = spark.createDataFrame([(7, "b")], "id long, name string")
    new = spark.createDataFrame([(0, "c"), (0, "a"), (0, "b")], "id long, name string")
    assert sorted(tuple(r) for r in C.insert_numbered(t, new, "name", "id").collect()) == [(7, "b"), (8, "a"), (9, "c")]


def test_clone_frame(spark):
    f, l = spark.createDataFrame([(1, "a"), (4, "b")], "polyid long, polyid_name string"), spark.createDataFrame([(1, 9)], "polyid long, bid long")
    frames, links = C.clone_frame(f, l, 1, "new")
    assert sorted(map(tuple, frames.collect())) == [(1, "a"), (4, "b"), (5, "new")] and sorted(map(tuple, links.collect())) == [(1, 9), (5, 9)]


def test_spatial_joins_have_no_nested_loop(spark):
    b = spark.createDataFrame([(1, 0.0, 1.0, 0.0, 1.0)], "bid long, lon1 double, lon2 double, lat1 double, lat2 double")
    plan = P.boxes_overlap(b, b.withColumnRenamed("bid", "other"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert P.boxes_overlap(b, b.withColumnRenamed("bid", "other")).count() == 1


def test_quake_radius(spark):
    r = lambda m, d: one(spark, S_radius(m, d), m=m)
    S_radius = lambda m, d: P.quake_radius(F.col("m"), F.lit(float(d)))
    k = 360 / 40007.86
    assert r(5.5, 10.0) == pytest.approx(10 * k) and r(5.5, 11.0) is None and r(8.6, 200.0) == pytest.approx(2500 * k) and r(5.4, 1.0) is None


def test_official_burst_takes_nearest_and_wraps_track(spark):
    b = spark.createDataFrame([(1, 1, 175, 100.0, 10.0, 10.0)], "bid long, iw int, relorb int, tanx double, lon double, lat double")
    o = spark.createDataFrame([(5, 1, 1, 101.5, 10.2, 10.0), (6, 1, 175, 99.0, 10.5, 10.0), (7, 1, 173, 100.0, 10.0, 10.0)], "id long, iw int, relorb int, tanx double, lon double, lat double")
    assert [tuple(r) for r in P.official_bursts(b, o).collect()] == [(1, 5)]


def test_gaps_and_islands(spark):
    e = spark.createDataFrame([(1, day(n)) for n in (0, 6, 12, 72, 78, 150)], "frame long, epoch date")
    p = spark.createDataFrame([(1, day(a), day(b)) for a, b in ((0, 6), (6, 12), (12, 72), (72, 78))], "frame long, epoch1 date, epoch2 date")
    gaps = N.network_gaps(e, p).collect()
    assert [(g.start, g.stop) for g in gaps] == [(day(78), day(150))]
    runs = N.cluster_epochs(e, 25).collect()
    assert sorted((r.start, r.n) for r in runs) == [(day(0), 3), (day(72), 2), (day(150), 1)]  # the last one too
    m = N.merge_intervals(spark.createDataFrame([(1, day(0), day(10)), (1, day(40), day(50)), (1, day(200), day(210))], "frame long, start date, stop date"), 25)
    assert sorted((r.start, r.days) for r in m.collect()) == [(day(0), 50), (day(200), 10)]
    assert sorted(map(tuple, N.merge_intervals(m.drop("days"), 25).collect())) == sorted(map(tuple, m.collect()))


def test_repaired_baselines(spark):
    rows = spark.createDataFrame([(1, day(0), 10.0, 1), (1, day(0), 99.0, 2), (1, day(6), 900.0, 3), (1, day(12), 500.0, 4), (1, day(18), None, 5)], "frame long, epoch date, bperp double, seq int")
    alt = spark.createDataFrame([(1, 20.0), (1, 40.0)], "frame long, bperp double")
    assert {r.epoch: r.bperp for r in N.repaired_baselines(rows, alt).collect()} == {day(0): 10.0, day(6): 0.0, day(12): 30.0, day(18): 30.0}


def test_event_pairs_break_ties_by_time(spark):
    t = dt.datetime
    p = spark.createDataFrame([(1, day(0), day(6), t(2020, 1, 1, 5), t(2020, 1, 7, 5))], "frame long, epoch1 date, epoch2 date, ts1 timestamp, ts2 timestamp")
    kinds = []
    for ts in (t(2020, 1, 7, 6), t(2020, 1, 7, 4), t(2020, 1, 1, 4)):
        q = spark.createDataFrame([(1, 1, ts)], "frame long, id long, ts timestamp")
        kinds.append(N.classify_pairs(p, q, 30).first().kind)
    assert kinds == ["pre", "co", "post"]


def test_stack_std_and_compat(spark):
    p = spark.createDataFrame([(0, 0, v) for v in (1.0, 3.0, 0.0, float("nan"))], "row long, col long, coh double")
    r, c = R.stack_stats(p, "coh").first(), R.stack_stats(p, "coh", compat=True).first()
    assert (r.mean, r.n) == (2.0, 2) and r.std == pytest.approx(math.sqrt(2)) and c.std == pytest.approx(math.sqrt(2 + 2 * 4))


def test_multilook_of_constant(spark):
    p = spark.createDataFrame([(1, r, c, 2.0, 1.0, 0.5 if (r, c) != (0, 0) else 0.0) for r in range(7) for c in range(7)], "f long, row long, col long, mag double, pha double, coh double")
    m = {(r.row, r.col): r for r in R.multilook(p, 3, 7, 7, ["f"]).collect()}
    assert len(m) == 4 and m[0, 0].n == 8 and not m[0, 0].masked and all(r.pha == pytest.approx(1.0) for r in m.values())


def test_decompose_round_trip(spark):
    rng, rows, truth = np.random.default_rng(1), [], {}
    for px in range(5):
        u, e, n = rng.normal(size=3).tolist()
        truth[px] = (u, e, n)
        for inc, head in ((34.0, -10.0), (39.0, -170.0), (44.0, -12.0), (30.0, 190.0)):
            i, h = math.radians(inc), math.radians(head)
            rows.append((px, inc, head, u * math.cos(i) - e * math.sin(i) * math.cos(h) + n * math.sin(i) * math.sin(h)))
    look = spark.createDataFrame(rows, "px long, inc double, heading double, vel double")
    for r in L.up_east_north(look, ["px"], 4).collect():
        assert (r.up, r.east, r.north) == pytest.approx(truth[r.px], abs=1e-6)
    assert L.up_east_north(look, ["px"], 5).first().up is None
    same = look.withColumns({"inc": F.lit(30.0), "heading": F.lit(10.0)})
    assert L.up_east(same, ["px"], 4).first().up is None  # singular
    assert all(r.up_dop > 0 for r in L.dilution(look, ["px"]).collect())


def test_surface_deramp_removes_a_surface(spark):
    p = spark.createDataFrame([(r, c, 3.0 + r - 2.0 * c + 0.1 * r * c) for r in range(8) for c in range(8)], "row long, col long, v double")
    assert all(abs(r.deramped) < 1e-6 for r in L.surface_deramp(p.withColumn("g", F.lit(1)), ["g"], "v", 2, 8.0).collect())


def test_invert_network_and_outlier(spark):
    series = [0.0, 1.0, 1.5, -0.5, 2.0]
    rows = [(1, day(6 * i), day(6 * j), series[j] - series[i]) for i in range(5) for j in range(i + 1, min(5, i + 4))]
    bad = [(c, a, b, v + (40.0 if (a, b) == (day(0), day(18)) else 0.0)) for c, a, b, v in rows]
    for data in (rows, bad):
        out = sorted(map(tuple, L.invert_network(spark.createDataFrame(data, "px long, epoch1 date, epoch2 date, value double"), ["px"], 20.0).collect()))
        assert [v for _, _, v in out] == pytest.approx(series, abs=1e-6)
    loose = spark.createDataFrame([(1, day(0), day(6), 1.0), (1, day(12), day(18), 1.0)], "px long, epoch1 date, epoch2 date, value double")
    assert all(r.value is None or math.isnan(r.value) for r in L.invert_network(loose, ["px"]).collect())


def test_seasonal_and_huber(spark):
    rows = []
    for i in range(60):
        t = (D(2018, 1, 1) + dt.timedelta(days=12 * i) - D(2000, 1, 1)).days / 365.25
        rows.append((1, D(2018, 1, 1) + dt.timedelta(days=12 * i), 2 + 3 * t + math.sin(2 * math.pi * t) - 0.5 * math.cos(2 * math.pi * t)))
    r = L.seasonal(spark.createDataFrame(rows, "px long, epoch date, v double"), ["px"], "v").first()
    assert (r.rate, r["sin"], r["cos"]) == pytest.approx((3, 1, -0.5), abs=1e-4)
    pts = [(1, float(x), 2.0 * x + 1 + (500 if x == 3 else 0)) for x in range(30)]
    h = L.huber_slope(spark.createDataFrame(pts, "b long, x double, y double"), ["b"], "x", "y").first()
    assert h.slope == pytest.approx(2.0, abs=0.05)


def test_islands(spark):
    picture = ["##..#", "#..##", "...#.", "##..."]
    p = spark.createDataFrame([(r, c) for r, line in enumerate(picture) for c, x in enumerate(line) if x == "#"], "row long, col long")
    sizes = {(r.label.row, r.label.col): r["size"] for r in R.islands(p, []).collect()}
    assert sizes == {(0, 0): 3, (0, 4): 4, (3, 0): 2}


def test_residues_cancel_in_a_smooth_field(spark):
    p = spark.createDataFrame([(r, c, 0.3 * r + 0.2 * c) for r in range(6) for c in range(6)], "row long, col long, p double")
    assert R.residues(p, [], "p").count() == 0
    vortex = spark.createDataFrame([(r, c, math.atan2(r - 2.5, c - 2.5)) for r in range(6) for c in range(6)], "row long, col long, p double")
    assert R.residues(vortex, [], "p").count() == 1


def test_corners_that_are_null_are_skipped(spark):
    """A frame with four of its twelve corners, one with all, one with none."""
    names = [f"corner{i}_{a}" for i in range(1, 13) for a in ("lon", "lat")]
    four = [0.0, 0.0, 2.0, 0.0, 2.0, 1.0, 0.0, 1.0] + [None] * 16
    twelve = [float(x) for i in range(12) for x in (i, -i)]
    rows = spark.createDataFrame([(1, *four), (2, *twelve), (3, *[None] * 24)], "id int, " + ", ".join(f"{n} double" for n in names))
    assert {(r.id, r.lon1, r.lon2, r.lat1, r.lat2) for r in P.corner_boxes(rows, 12).collect()} == {(1, 0.0, 2.0, 0.0, 1.0), (2, 0.0, 11.0, -11.0, 0.0)}


def test_islands_across_tiles(spark):
    """A winding line over many tiles is one island, also where it passes tile corners; one that keeps its size, and one that goes."""
    line = [(r, c) for r in range(0, 40, 4) for c in range(30)] + [(r, 29 if (r // 4) % 2 == 0 else 0) for r in range(40) if r % 4 and r < 36]
    other = [(50, 50), (51, 50), (53, 53)]
    df = spark.createDataFrame([("f", r, c, 1.0) for r, c in line + other], "frame string, row long, col long, value double")
    for tile in (4, 5, 256):
        sizes = {(r.label.row, r.label.col): r.size for r in R.islands(df, ["frame"], tile).collect()}
        assert sizes == {(0, 0): len(line), (50, 50): 2, (53, 53): 1}
    left = {(r.row, r.col) for r in R.remove_islands(df, ["frame"], "value", 2).filter("value is not null").collect()}
    assert left == set(line) | {(50, 50), (51, 50)}


def test_gauss_fill_goes_on_to_the_nearest(spark):
    """A strip of no-data wider than three rounds reach."""
    rows = [(0, c, 1.5 if c == 0 else None) for c in range(12)]
    out = {r.col: r.p for r in R.fill_gauss(spark.createDataFrame(rows, "row long, col long, p double"), [], "p", 1.0, 1).collect()}
    assert len(out) == 12 and all(abs(p - 1.5) < 1e-9 for p in out.values())


def test_flat_rasters_of_all_kinds(spark, tmp_path):
    a = np.arange(12, dtype="f4").reshape(3, 4)
    for kind, raw in ((">f4", a.astype(">f4").tobytes()), ("<c8", (a + 2j * a).astype("<c8").tobytes()), (">i2c", np.stack([a, 2 * a], axis=-1).astype(">i2").tobytes())):
        folder = tmp_path / kind.strip("<>")
        folder.mkdir()
        (folder / "one.bin").write_bytes(raw)
        from fringeline.sources import readers

        got = {(r.row, r.col): (r.re, r.im) for r in readers.flat_rasters(spark, str(folder), 4, kind).collect()}
        assert got == {(r, c): (a[r, c] or None, (None if kind == ">f4" else 2 * a[r, c] or None)) for r in range(3) for c in range(4)}


def by_group(df, key, *values):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], []).append([float(r[v]) if v != "epoch" else (r[v] - dt.date(2000, 1, 1)).days / 365.25 for v in values])
    return {k: np.array(v).T for k, v in out.items()}


def test_seasonal_query_against_numpy(spark, sf_dir):
    from fringeline.plans import raster as Q

    data = by_group(Q._pix(spark, sf_dir).filter("pha is not null"), "row", "epoch", "pha")
    for r in Q.QUERIES["e30_seasonal"](spark, sf_dir).collect():
        t, y = data[r.row]
        want = np.linalg.lstsq(np.stack([np.ones_like(t), t, np.sin(2 * np.pi * t), np.cos(2 * np.pi * t)], axis=1), y, rcond=None)[0]
        assert np.allclose([r.const, r.rate, r.sin, r.cos], want, atol=1e-3), r


def test_surface_query_against_numpy(spark, sf_dir):
    from fringeline.plans import raster as Q

    data = by_group(Q._pix(spark, sf_dir).groupBy(F.year("epoch").alias("frame"), "row", "col").agg(F.avg("pha").alias("v")), "frame", "row", "col", "v")
    found = by_group(Q.QUERIES["e25_surface_deramp"](spark, sf_dir), "frame", "row", "col", "deramped")
    assert set(found) == set(data)
    for k, (row, col, v) in data.items():
        x, y = row / 40, col / 40
        a = np.stack([x**i * y**j for i in range(3) for j in range(3 - i)], axis=1)
        want = {(r, c): d for r, c, d in zip(row, col, v - a @ np.linalg.lstsq(a, v, rcond=None)[0])}
        assert all(abs(want[r, c] - d) < 1e-3 for r, c, d in found[k].T)


def test_huber_query_against_numpy(spark, sf_dir):
    from fringeline.plans import raster as Q

    data = by_group(Q._pix(spark, sf_dir).select(F.concat_ws(":", "epoch", F.floor(F.col("row") / 10)).alias("k"), (F.col("mag") / 1000).alias("hgt"), "pha"), "k", "hgt", "pha")
    for r in Q.QUERIES["e24_huber_slope"](spark, sf_dir).collect():
        x, y = data[f"{r.epoch}:{r.block}"]
        if len(x) < 8:
            continue
        # at the solution the weighted residuals balance: both sums of the influence function vanish
        rest = y - r.slope * x - r.intercept
        s = np.median(np.abs(rest)) / 0.6745 or 1.0
        psi = np.clip(rest / s, -1.345, 1.345)
        assert abs(psi.sum()) < 0.02 * len(x) and abs((psi * (x - x.mean())).sum()) < 0.02 * len(x) * x.std(), r
