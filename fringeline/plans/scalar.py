"""Scalar expressions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fringeline.functions import scalar as S
from fringeline.plans.registry import Registry
from fringeline.plans.views import table, view

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql
R6 = 6
WAVE = 0.055465763


def _r(column, digits: int = R6):
    """Rounded, without negative zeros."""
    return F.round(column, digits) + F.lit(0.0)


@query("SELECT polyid, polyid_name, regexp_matches(polyid_name, '^[0-9]{3}[AD]_[0-9]{5}_[0-9]{6}$') AS valid, CAST(substr(polyid_name, 1, 3) AS BIGINT) AS track, substr(polyid_name, 4, 1) AS pass FROM @frames")
def b01_frame_id(spark, sf_dir):
    f = F.col("polyid_name")
    return view(spark, sf_dir, "frames").select("polyid", "polyid_name", S.is_frame_id(f).alias("valid"), S.frame_track(f).cast("long").alias("track"), S.frame_pass(f).alias("pass"))


@query("SELECT bid, relorb, iw, CAST(CAST(tanx * 10 AS BIGINT) AS DOUBLE) / 10 AS tanx FROM @bursts")
def b02_burst_id(spark, sf_dir):
    name = F.concat_ws("_", "relorb", F.concat(F.lit("IW"), "iw"), (F.col("tanx") * 10).cast("long"))
    return view(spark, sf_dir, "bursts").select("bid", S.burst_parts(name).alias("p")).select("bid", F.col("p.relorb").cast("long").alias("relorb"), F.col("p.iw").cast("long").alias("iw"), "p.tanx")


@query("""SELECT fid, CASE sat WHEN 0 THEN 'S1A' ELSE 'S1B' END AS sat, 'IW' AS mode, 'DV' AS pol, CAST(acq_date AS VARCHAR) AS start_day, CAST(27 AS BIGINT) AS seconds FROM @files""")
def b03_product_name(spark, sf_dir):
    day = F.date_format("acq_date", "yyyyMMdd")
    name = F.concat(F.when(F.col("sat") == 0, "S1A").otherwise("S1B"), F.lit("_IW_SLC__1SDV_"), day, F.lit("T061509_"), day, F.lit("T061536_006539_0086F8_A1B2"))
    p = view(spark, sf_dir, "files").select("fid", S.product_parts(name).alias("p"))
    return p.select("fid", "p.sat", "p.mode", "p.pol", F.to_date("p.start").cast("string").alias("start_day"), (F.unix_timestamp("p.stop") - F.unix_timestamp("p.start")).alias("seconds"))


@query("SELECT fid, CASE WHEN fid % 175 - 72 <= 0 THEN fid % 175 - 72 + 175 ELSE fid % 175 - 72 END AS relorb FROM @files")
def b04_relative_orbit(spark, sf_dir):
    return view(spark, sf_dir, "files").select("fid", S.relative_orbit(F.col("fid")).alias("relorb"))


@query("""SELECT fid, '/archive/slc/' || CASE WHEN acq_date >= DATE '2019-06-25' THEN 'IPF_v3' ELSE 'IPF_v2' END || '/' || strftime(acq_date, '%Y/%m/%d') || '/' || 'scene' || fid || '.zip' AS path FROM @files""")
def b05_archive_path(spark, sf_dir):
    return view(spark, sf_dir, "files").select("fid", S.archive_path(F.concat(F.lit("scene"), "fid"), F.col("acq_date"), "/archive/slc").alias("path"))


@query("SELECT bid, lpad(CAST(relorb AS VARCHAR), 3, '0') || '_D_' || lpad(CAST(iw AS VARCHAR), 3, '0') AS frame FROM @bursts")
def b06_lband_frame(spark, sf_dir):
    name = F.concat(F.lit("NISAR_L2_PR_GSLC_003_"), F.lpad(F.col("relorb").cast("string"), 3, "0"), F.lit("_D_"), F.lpad(F.col("iw").cast("string"), 3, "0"), F.lit("_2000_SHNA"))
    return view(spark, sf_dir, "bursts").select("bid", S.lband_frame(name).alias("frame"))


@query("SELECT frame, CAST(epoch1 AS VARCHAR) AS epoch1, CAST(epoch2 AS VARCHAR) AS epoch2, CAST(epoch2 - epoch1 AS BIGINT) AS btemp, strftime(epoch1, '%Y%m%d') || '_' || strftime(epoch2, '%Y%m%d') AS pair FROM @pairs")
def b07_pair_dates(spark, sf_dir):
    p = view(spark, sf_dir, "pairs").select("frame", S.pair_name(F.col("epoch1"), F.col("epoch2")).alias("pair"))
    p = p.select("frame", "pair", S.pair_dates(F.col("pair")).alias("d"))
    return p.select("frame", F.col("d.epoch1").cast("string").alias("epoch1"), F.col("d.epoch2").cast("string").alias("epoch2"), F.col("d.btemp").cast("long").alias("btemp"), "pair")


@query("SELECT event_id, CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-10 12:00:00')) / 86400000000.0) AS BIGINT) AS days FROM events")
def b08_whole_days(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", S.whole_days(F.col("ts"), F.lit("2024-01-10 12:00:00").cast("timestamp")).alias("days"))


@query('SELECT "row", col, strftime(epoch, \'%Y-%m-%d\') AS epoch, round(atan2(sin(pha), cos(pha)), 6) + 0.0 AS wrapped, round(atan2(sin(pha), cos(pha)), 6) + 0.0 AS wrapped_mod FROM @pixels')
def b09_wrap(spark, sf_dir):
    day = F.date_format("epoch", "yyyy-MM-dd").alias("epoch")
    return view(spark, sf_dir, "pixels").select("row", "col", day, _r(S.wrap(F.col("pha"))).alias("wrapped"), _r(S.wrap_mod(F.col("pha"))).alias("wrapped_mod"))


@query("SELECT l_orderkey, l_linenumber, round(l_tax * cos(l_quantity), 6) + 0.0 AS re, round(l_tax * sin(l_quantity), 6) + 0.0 AS im, round(l_tax * l_discount * cos(l_quantity - 1), 6) + 0.0 AS pre, round(l_tax * l_discount * sin(l_quantity - 1), 6) + 0.0 AS pim FROM lineitem")
def b10_complex(spark, sf_dir):
    a, b = S.to_complex(F.col("l_tax"), F.col("l_quantity")), S.to_complex(F.col("l_discount"), F.lit(1.0))
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber"), a.alias("a"), b.alias("b"))
    t = t.select("l_orderkey", "l_linenumber", "a", S.conjugate_product(F.col("a.re"), F.col("a.im"), F.col("b.re"), F.col("b.im")).alias("p"))
    return t.select("l_orderkey", "l_linenumber", _r(F.col("a.re")).alias("re"), _r(F.col("a.im")).alias("im"), _r(F.col("p.re")).alias("pre"), _r(F.col("p.im")).alias("pim"))


@query(f"SELECT l_orderkey, l_linenumber, round(-l_quantity * {WAVE} * 1000 / (4 * pi()), 6) AS mm, round(-l_quantity / ({WAVE} * 1000 / (4 * pi())), 6) AS rad FROM lineitem")
def b11_rad_mm(spark, sf_dir):
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(S.rad_to_mm(q, -1, WAVE), 6).alias("mm"), F.round(S.mm_to_rad(q, -1, WAVE), 6).alias("rad"))


@query("SELECT l_orderkey, l_linenumber, CAST(round(l_discount * 255) AS BIGINT) AS byte, round(round(l_discount * 255) / 255, 6) AS coh FROM lineitem")
def b12_coherence_bytes(spark, sf_dir):
    b = S.coherence_to_byte(F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", b.cast("long").alias("byte"), F.round(S.coherence_from_byte(b), 6).alias("coh"))


@query("SELECT l_orderkey, l_linenumber, round(2 * (l_quantity / 50) * (l_quantity / 50) / nullif(1 - (l_quantity / 50) * (l_quantity / 50), 0), 6) AS weight FROM lineitem")
def b13_phase_weight(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(S.phase_weight(F.col("l_quantity") / 50), 6).alias("weight"))


@query("""SELECT p_partkey, round(degrees(sqrt(pi() * pi() / 3 - pi() * asin(c) + asin(c) * asin(c) - s / 2)), 5) AS std_deg, round(degrees(sqrt((1 - c * c) / (2 * c * c))), 5) AS point_deg
    FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) / 60 + 0.05 AS c, (SELECT sum(pow((CAST(p_size AS DOUBLE) / 60 + 0.05) * (CAST(p_size AS DOUBLE) / 60 + 0.05), k) / (k * k)) FROM range(1, 101) t(k)) AS s FROM part)""")
def b14_phase_std(spark, sf_dir):
    c = F.col("p_size").cast("double") / 60 + 0.05
    return table(spark, sf_dir, "part").select("p_partkey", F.round(S.phase_std_deg(c), 5).alias("std_deg"), F.round(S.point_phase_std_deg(c), 5).alias("point_deg"))


@query("""SELECT p_partkey, round((1 - c * c) / (2 * pi()) / (1 - b * b) * (1 + b * acos(-b) / sqrt(1 - b * b)), 6) AS pdf FROM (SELECT p_partkey, c, c * cos(CAST(p_partkey % 63 AS DOUBLE) / 10 - 3.1) AS b FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) / 60 AS c FROM part))""")
def b15_phase_pdf(spark, sf_dir):
    x, c = (F.col("p_partkey") % 63).cast("double") / 10 - 3.1, F.col("p_size").cast("double") / 60
    return table(spark, sf_dir, "part").select("p_partkey", F.round(S.phase_pdf(x, c), 6).alias("pdf"))


@query("""SELECT polyid, round(degrees(atan2(y, x)), 6) AS lon, round(degrees(atan2(z, sqrt(x * x + y * y))), 6) AS lat FROM (SELECT polyid, avg(cos(radians(lat)) * cos(radians(lon))) AS x, avg(cos(radians(lat)) * sin(radians(lon))) AS y,
    avg(sin(radians(lat))) AS z FROM @frame_bursts JOIN @bursts USING (bid) GROUP BY polyid)""")
def b16_mean_centre(spark, sf_dir):
    from fringeline.operators.spatial import mean_centre

    rows = view(spark, sf_dir, "frame_bursts").join(view(spark, sf_dir, "bursts"), "bid")
    return mean_centre(rows, "polyid").select("polyid", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


@query("SELECT bid, CAST(round((tanx * 3 - floor(tanx * 3 / (12.0 * 86400 / 175)) * (CAST(12 * 86400 AS DOUBLE) / 175)) * 10) AS BIGINT) AS anx FROM @bursts")
def b17_anx_id(spark, sf_dir):
    return view(spark, sf_dir, "bursts").select("bid", S.anx_burst_id(F.col("tanx") * 3).alias("anx"))


@query('SELECT frame, "row", col, round(degrees(acos(cos(radians(inc)))), 6) AS inc_back, round(degrees(atan2(sin(radians(inc)) * sin(radians(heading)), sin(radians(inc)) * cos(radians(heading)))), 6) AS heading_back FROM @look')
def b18_los_geometry(spark, sf_dir):
    v = view(spark, sf_dir, "look").select("frame", "row", "col", S.los_enu(F.col("inc"), F.col("heading")).alias("v"))
    return v.select("frame", "row", "col", F.round(S.incidence_deg(F.col("v.e"), F.col("v.u")), 6).alias("inc_back"), F.round(S.heading_deg(F.col("v.e"), F.col("v.n")), 6).alias("heading_back"))


@query('SELECT frame, "row", col, round(sin(radians(heading)), 6) AS e, round(cos(radians(heading)), 6) AS n FROM @look')
def b19_azimuth_enu(spark, sf_dir):
    v = view(spark, sf_dir, "look").select("frame", "row", "col", S.azimuth_enu(F.col("inc"), F.col("heading")).alias("v"))
    return v.select("frame", "row", "col", F.round("v.e", 6).alias("e"), F.round("v.n", 6).alias("n"))


@query("SELECT bid, round(lon, 5) + 0.0 AS lon, round(lat, 5) + 0.0 AS lat, CAST(bid % 5000 AS BIGINT) AS height FROM @bursts")
def b20_geodetic(spark, sf_dir):
    """Geodetic points are turned to ECEF here and back by the operator."""
    a, e2, la, lo, h = S.EARTH_RADIUS_M, S.EARTH_FLATTENING * (2 - S.EARTH_FLATTENING), F.radians("lat"), F.radians("lon"), (F.col("bid") % 5000).cast("double")
    n = a / F.sqrt(1 - e2 * F.sin(la) * F.sin(la))
    p = view(spark, sf_dir, "bursts").select("bid", ((n + h) * F.cos(la) * F.cos(lo)).alias("x"), ((n + h) * F.cos(la) * F.sin(lo)).alias("y"), ((n * (1 - e2) + h) * F.sin(la)).alias("z"))
    p = p.select("bid", S.geodetic(F.col("x"), F.col("y"), F.col("z")).alias("g"))
    return p.select("bid", _r(F.col("g.lon"), 5).alias("lon"), _r(F.col("g.lat"), 5).alias("lat"), F.round("g.height").cast("long").alias("height"))


@query(f"SELECT bid, round({WAVE} * 850000 / 2 * sin(radians(30 + iw * 5)) / nullif(CAST(bid % 400 - 200 AS DOUBLE), 0), 6) AS ha FROM @bursts")
def b21_height_of_ambiguity(spark, sf_dir):
    return view(spark, sf_dir, "bursts").select("bid", F.round(S.height_of_ambiguity((F.col("bid") % 400 - 200).cast("double"), 850000.0, 30 + F.col("iw") * 5, WAVE), 6).alias("ha"))


@query("SELECT bid, round(-2300 + 450000 * x - 7e7 * x * x + 1e10 * x * x * x - 1e12 * x * x * x * x, 6) AS rate FROM (SELECT bid, (tanx - 2950) * 1e-6 AS x FROM @bursts)")
def b22_fm_rate(spark, sf_dir):
    return view(spark, sf_dir, "bursts").select("bid", F.round(S.fm_rate(F.col("tanx") * 1e-6, F.lit(2950 * 1e-6), [-2300.0, 450000.0, -7e7, 1e10, -1e12]), 6).alias("rate"))


@query(f"""SELECT frame, "row", col, round(-4 * pi() * 40.308193 * 1e16 / (299792458.0 * 5.405e9) * vel / sqrt(1 - s * s), 4) AS phase FROM (SELECT *, {S.EARTH_RADIUS_M / 1000} / ({S.EARTH_RADIUS_M / 1000} + 450) * sin(radians(inc)) AS s FROM @look)""")
def b23_iono_phase(spark, sf_dir):
    return view(spark, sf_dir, "look").select("frame", "row", "col", F.round(S.iono_phase(F.col("vel"), F.col("inc")), 4).alias("phase"))


@query(f'SELECT frame, "row", col, round(vel / 1000 / cos(radians(inc)) * 4 * pi() / {WAVE}, 6) AS rad FROM @look')
def b24_slant_delay(spark, sf_dir):
    return view(spark, sf_dir, "look").select("frame", "row", "col", F.round(S.slant_delay_rad(F.col("vel") / 1000, F.cos(F.radians("inc")), WAVE), 6).alias("rad"))


@query("SELECT l_orderkey, l_linenumber, round(l_tax * 14000, 6) AS azimuth_mm, round(l_discount * 2300, 6) AS range_mm FROM lineitem")
def b25_offsets(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.offset_mm(F.col("l_tax"), F.col("l_discount")).alias("o"))
    return t.select("l_orderkey", "l_linenumber", F.round("o.azimuth_mm", 6).alias("azimuth_mm"), F.round("o.range_mm", 6).alias("range_mm"))


@query("SELECT bid, round(lon1, 5) + 0.0 AS lon1, round(lon2, 5) + 0.0 AS lon2, round(lat1, 5) + 0.0 AS lat1, round(lat2, 5) + 0.0 AS lat2, printf('%.5f/%.5f/%.5f/%.5f', round(lon1, 5) + 0.0, round(lon2, 5) + 0.0, round(lat1, 5) + 0.0, round(lat2, 5) + 0.0) AS clip FROM @bursts")
def b26_clip(spark, sf_dir):
    b = view(spark, sf_dir, "bursts")
    swapped = F.concat_ws("/", "lon2", "lon1", "lat1", "lat2")  # the parser puts them in order
    c = b.select("bid", S.clip_parts(swapped).alias("c"))
    box = [_r(F.col(f"c.{n}"), 5) for n in ("lon1", "lon2", "lat1", "lat2")]
    return c.select("bid", *[x.alias(n) for x, n in zip(box, ("lon1", "lon2", "lat1", "lat2"))], S.clip_text(*box).alias("clip"))


@query("SELECT volc_id, round(lon - 25 / 111.0, 6) + 0.0 AS lon1, round(lon + 25 / 111.0, 6) + 0.0 AS lon2, round(lat - 25 / 111.0, 6) + 0.0 AS lat1, round(lat + 25 / 111.0, 6) + 0.0 AS lat2 FROM @volcanoes")
def b27_clip_box(spark, sf_dir):
    v = view(spark, sf_dir, "volcanoes").select("volc_id", S.clip_box(F.col("lon"), F.col("lat"), 25.0, 111.0).alias("b"))
    return v.select("volc_id", *[_r(F.col(f"b.{n}")).alias(n) for n in ("lon1", "lon2", "lat1", "lat2")])


@query("""SELECT bid, round(lon1 - CASE WHEN bid % 2 = 0 THEN 0.5 ELSE 0 END, 6) + 0.0 AS lon1, round(lon2, 6) + 0.0 AS lon2, round(lat1, 6) + 0.0 AS lat1, round(lat2 + CASE WHEN bid % 3 = 0 THEN 0.5 ELSE 0 END, 6) + 0.0 AS lat2 FROM @bursts""")
def b28_enlarge(spark, sf_dir):
    sides = F.concat(F.when(F.col("bid") % 2 == 0, "L").otherwise(""), F.when(F.col("bid") % 3 == 0, "U").otherwise(""))
    b = view(spark, sf_dir, "bursts")
    b = b.select("bid", S.enlarge(F.col("lon1"), F.col("lon2"), F.col("lat1"), F.col("lat2"), sides, 0.5).alias("b"))
    return b.select("bid", *[_r(F.col(f"b.{n}")).alias(n) for n in ("lon1", "lon2", "lat1", "lat2")])


@query("SELECT bid, CAST(round((90 - lat) * 100) AS BIGINT) AS colatitude, round((lon1 + lon2) / 2, 6) + 0.0 AS mid_lon FROM @bursts")
def b29_colatitude(spark, sf_dir):
    return view(spark, sf_dir, "bursts").select("bid", S.colatitude(F.col("lat")).alias("colatitude"), _r((F.col("lon1") + F.col("lon2")) / 2).alias("mid_lon"))


@query("SELECT c_custkey, replace(strip_accents('Volcán ' || c_name || '''s'), '''', '') AS name FROM customer")
def b30_strip_accents(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", S.strip_accents(F.concat(F.lit("Volcán "), "c_name", F.lit("'s"))).alias("name"))


@query("SELECT iw, CAST(round(0.001 * 111132.954, 4) AS DOUBLE) AS lat_m, round(0.001 * 111132.954 * cos(radians(avg(lat))), 4) AS lon_m FROM @bursts GROUP BY iw")
def b31_pixel_metres(spark, sf_dir):
    from fringeline.operators.raster import pixel_metres

    m = pixel_metres(view(spark, sf_dir, "bursts"), "iw", 0.001)
    return m.select("iw", F.round("lat_m", 4).alias("lat_m"), F.round("lon_m", 4).alias("lon_m"))


@query("""SELECT p_partkey, CAST(make_date(y, 1, 1) + CAST(floor(f * (make_date(y + 1, 1, 1) - make_date(y, 1, 1))) AS INTEGER) AS VARCHAR) AS day FROM (SELECT p_partkey, CAST(2014 + p_partkey % 9 AS INTEGER) AS y, CAST(p_size AS DOUBLE) / 64 AS f FROM part)""")
def b32_decimal_year(spark, sf_dir):
    year = 2014 + F.col("p_partkey") % 9 + F.col("p_size").cast("double") / 64
    return table(spark, sf_dir, "part").select("p_partkey", S.decimal_year_date(year).cast("string").alias("day"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def b33_properties(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long").alias("p")).select("event_id", "p.k")


@query('SELECT "row", col, strftime(epoch, \'%Y-%m-%d\') AS epoch, CAST(CASE WHEN round(mag, 4) > 30000 AND round(coh, 6) > 0.3 THEN 1 ELSE 0 END AS BIGINT) AS mask FROM @pixels')
def b34_mask(spark, sf_dir):
    land, coherent = (F.round("mag", 4) > 30000).cast("long"), (F.round("coh", 6) > 0.3).cast("long")
    return view(spark, sf_dir, "pixels").select("row", "col", F.date_format("epoch", "yyyy-MM-dd").alias("epoch"), (land * coherent).alias("mask"))


@query("SELECT polyid, CAST(substr(polyid_name, 12, 2) AS BIGINT) + CAST(substr(polyid_name, 14, 2) AS BIGINT) + CAST(substr(polyid_name, 16, 2) AS BIGINT) AS bursts FROM @frames")
def b35_burst_count(spark, sf_dir):
    return view(spark, sf_dir, "frames").select("polyid", S.frame_burst_count(F.col("polyid_name")).cast("long").alias("bursts"))
