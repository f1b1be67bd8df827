"""Catalogue queries: filters, equi-joins, roll-ups, set operations and table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from fringeline.operators import catalogue as C
from fringeline.plans.registry import Registry
from fringeline.plans.spatial import QUAKE_RADIUS
from fringeline.plans.views import table, view

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql
def _day():
    return F.col("acq_date").cast("string").alias("acq_date")



def _v(spark, sf_dir, *names):
    return [view(spark, sf_dir, n) for n in names]


@query("SELECT bid, iw, relorb, round(tanx, 1) AS tanx FROM @bursts")
def a01_catalogue_scan(spark, sf_dir):
    return view(spark, sf_dir, "bursts").select("bid", "iw", "relorb", F.round("tanx", 1).alias("tanx"))


@query("SELECT bid FROM @bursts b WHERE EXISTS (SELECT 1 FROM @frame_bursts f WHERE f.bid = b.bid)")
def c01_exists(spark, sf_dir):
    b, f = _v(spark, sf_dir, "bursts", "frame_bursts")
    return b.join(f, "bid", "left_semi").select("bid")


@query("SELECT polyid, polyid_name, bid FROM @frames JOIN @frame_bursts USING (polyid) WHERE polyid_name LIKE '00%'")
def c02_key_lookup(spark, sf_dir):
    f, fb = _v(spark, sf_dir, "frames", "frame_bursts")
    return f.filter(F.col("polyid_name").startswith("00")).join(fb, "polyid").select("polyid", "polyid_name", "bid")


@query("SELECT fid, CAST(acq_date AS VARCHAR) AS acq_date, pol FROM @files WHERE acq_date BETWEEN DATE '1996-01-01' AND DATE '1997-06-30' AND pol IN ('VV', 'HH')")
def c03_period_pol(spark, sf_dir):
    return C.co_polarised(view(spark, sf_dir, "files"), "1996-01-01", "1997-06-30").select("fid", _day(), "pol")


@query("SELECT polyid, polyid_name FROM @frames WHERE polyid_name LIKE '004D%' OR polyid_name LIKE '006D%'")
def c04_track_prefix(spark, sf_dir):
    name, prefix = F.col("polyid_name"), lambda t: F.concat(F.lpad(F.lit(t), 3, "0"), F.lit("D"))
    return view(spark, sf_dir, "frames").filter(name.startswith(prefix("4")) | name.startswith(prefix("6"))).select("polyid", "polyid_name")


@query("SELECT volc_id, name FROM @volcanoes WHERE regexp_matches(name, '0[13]$')")
def c05_name_search(spark, sf_dir):
    return view(spark, sf_dir, "volcanoes").filter(F.col("name").rlike("0[13]$")).select("volc_id", "name")


@query("SELECT id FROM @quakes q WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_id = q.id + 1 AND e.event_type = 'error')")
def c06_blacklist(spark, sf_dir):
    q = view(spark, sf_dir, "quakes")
    return q.join(q.select((F.col("id") - 1).alias("id")), "id", "left_anti").select("id")


@query("SELECT fid, CAST(acq_date AS VARCHAR) AS acq_date FROM @files WHERE acq_date >= DATE '1998-01-01' OR strftime(acq_date, '%Y-%m') = '1996-06'")
def c07_date_slice(spark, sf_dir):
    d = F.col("acq_date")
    return view(spark, sf_dir, "files").filter((d >= F.lit("1998-01-01").cast("date")) | (F.date_format(d, "yyyy-MM") == "1996-06")).select("fid", _day())


@query("SELECT l_orderkey, l_linenumber, CASE WHEN abs(l_tax) < 0.06 AND abs(l_discount) < 0.08 THEN l_tax END AS azimuth, CASE WHEN abs(l_tax) < 0.06 AND abs(l_discount) < 0.08 THEN l_discount END AS range_ FROM lineitem")
def c08_outlier_mask(spark, sf_dir):
    ok = (F.abs("l_tax") < 0.06) & (F.abs("l_discount") < 0.08)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.when(ok, F.col("l_tax")).alias("azimuth"), F.when(ok, F.col("l_discount")).alias("range_"))


@query('SELECT "row", col, strftime(epoch, \'%Y-%m-%d\') AS epoch, CASE WHEN round(coh, 6) > 0.6 OR round(mag / 100000, 6) > 0.25 THEN round(pha, 6) END AS pha FROM @pixels')
def c09_coherence_mask(spark, sf_dir):
    keep = (F.round("coh", 6) > 0.6) | (F.round(F.col("mag") / 100000, 6) > 0.25)
    return view(spark, sf_dir, "pixels").select("row", "col", F.date_format("epoch", "yyyy-MM-dd").alias("epoch"), F.when(keep, F.round("pha", 6)).alias("pha"))


@query("SELECT bid FROM @bursts WHERE lon BETWEEN -20 - 10 * 0.1 AND 40 + 10 * 0.1 AND lat BETWEEN -5 - 10 * 0.1 AND 30 + 10 * 0.1")
def c10_area_clip(spark, sf_dir):
    m = 10 * 0.1
    return view(spark, sf_dir, "bursts").filter(F.col("lon").between(-20 - m, 40 + m) & F.col("lat").between(-5 - m, 30 + m)).select("bid")


@query("SELECT volc_id, priority FROM @volcanoes WHERE priority IS NOT NULL AND priority <> 'FURNITURE'")
def c11_priority(spark, sf_dir):
    return view(spark, sf_dir, "volcanoes").filter(F.col("priority").isNotNull() & (F.col("priority") != "FURNITURE")).select("volc_id", "priority")


@query("SELECT DISTINCT polyid, bid, iw, relorb FROM @frames JOIN @frame_bursts USING (polyid) JOIN @bursts USING (bid)")
def d01_frame_bursts(spark, sf_dir):
    f, fb, b = _v(spark, sf_dir, "frames", "frame_bursts", "bursts")
    return C.bursts_of_frames(f.select("polyid"), fb, b.select("bid", "iw", "relorb")).select("polyid", "bid", "iw", "relorb")


@query("SELECT bid, polyid FROM @frame_bursts")
def d02_burst_frames(spark, sf_dir):
    b, fb = _v(spark, sf_dir, "bursts", "frame_bursts")
    return C.frames_of_bursts(b, fb)


@query("SELECT DISTINCT fid, bid, iw FROM @file_bursts JOIN @bursts USING (bid)")
def d02_file_bursts(spark, sf_dir):
    lb, b = _v(spark, sf_dir, "file_bursts", "bursts")
    return C.bursts_of_files(lb.select("fid", "bid"), b.select("bid", "iw"))


@query("SELECT DISTINCT bid, fid, CAST(acq_date AS VARCHAR) AS acq_date FROM @bursts JOIN @file_bursts USING (bid) JOIN @files USING (fid)")
def d02_burst_files(spark, sf_dir):
    b, lb, f = _v(spark, sf_dir, "bursts", "file_bursts", "files")
    return C.files_of_bursts(b, lb, f.select("fid", _day()))


@query("SELECT bid, arg_min(CASE WHEN sat = 0 THEN 'A' ELSE 'D' END, fid) AS orbit_dir FROM @file_bursts JOIN @files USING (fid) WHERE pol <> 'VH' GROUP BY bid")
def d02_burst_pass(spark, sf_dir):
    lb, f = _v(spark, sf_dir, "file_bursts", "files")
    return C.pass_of_bursts(lb, f.select("fid", F.when(F.col("pol") != "VH", F.when(F.col("sat") == 0, "A").otherwise("D")).alias("orbit_dir")), "orbit_dir")


@query("SELECT DISTINCT polyid, fid, CAST(acq_date AS VARCHAR) AS acq_date FROM @frame_bursts JOIN @file_bursts USING (bid) JOIN @files USING (fid) WHERE acq_date BETWEEN DATE '1996-01-01' AND DATE '1996-03-31' AND pol IN ('VV', 'HH')")
def d03_frame_files(spark, sf_dir):
    fb, lb, fi = _v(spark, sf_dir, "frame_bursts", "file_bursts", "files")
    return C.frame_files(fb, lb, C.co_polarised(fi, "1996-01-01", "1996-03-31")).select("polyid", "fid", _day())


@query("""WITH f AS (SELECT user_id AS polyid, event_id AS fid, ts AS acq_ts, event_id % 2 AS sat FROM events),
    r AS (SELECT user_id AS polyid, CAST(ts AS DATE) AS d, min(hour(ts) * 60 + minute(ts)) AS m FROM events WHERE event_type = 'purchase' GROUP BY 1, 2),
    j AS (SELECT r.polyid, d, fid, sat, CAST(acq_ts AS DATE) AS day FROM f JOIN r ON f.polyid = r.polyid WHERE abs(CAST(acq_ts AS DATE) - d) <= CASE WHEN m < 30 OR m >= 1410 THEN 1 ELSE 0 END)
    SELECT DISTINCT polyid, CAST(d AS VARCHAR) AS date, fid FROM j WHERE EXISTS (SELECT 1 FROM j k WHERE k.polyid = j.polyid AND k.d = j.d AND k.sat = j.sat AND k.day = k.d)""")
def d04_files_near_midnight(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    files = e.select(F.col("user_id").alias("polyid"), F.col("event_id").alias("fid"), F.col("ts").alias("acq_ts"), (F.col("event_id") % 2).alias("sat"))
    ref = e.filter("event_type = 'purchase'").groupBy(F.col("user_id").alias("polyid"), F.to_date("ts").alias("date")).agg(F.min(F.hour("ts") * 60 + F.minute("ts")).alias("minute"))
    return C.files_near_midnight(files, ref).select("polyid", F.col("date").cast("string").alias("date"), "fid")


@query("SELECT DISTINCT polyid, CAST(acq_date AS VARCHAR) AS acq_date, bid FROM @frame_bursts JOIN @file_bursts USING (bid) JOIN @files USING (fid)")
def d05_acquired_bursts(spark, sf_dir):
    return C.acquired_bursts(*_v(spark, sf_dir, "frame_bursts", "file_bursts", "files")).select("polyid", _day(), "bid")


@query("""WITH a AS (SELECT DISTINCT polyid, acq_date, bid FROM @frame_bursts JOIN @file_bursts USING (bid) JOIN @files USING (fid)),
    r AS (SELECT polyid, bid, iw, row_number() OVER (PARTITION BY polyid, iw ORDER BY tanx, bid) AS n FROM @frame_bursts JOIN @bursts USING (bid)),
    s AS (SELECT d.polyid, d.acq_date, r.iw, count(*) AS expected, count(a.bid) AS acquired, coalesce(max(CASE WHEN a.bid IS NOT NULL THEN n END) - min(CASE WHEN a.bid IS NOT NULL THEN n END) + 1 > count(a.bid), false) AS hole
      FROM (SELECT DISTINCT polyid, acq_date FROM a) d JOIN r ON r.polyid = d.polyid LEFT JOIN a ON a.polyid = d.polyid AND a.acq_date = d.acq_date AND a.bid = r.bid GROUP BY 1, 2, 3)
    SELECT polyid, CAST(acq_date AS VARCHAR) AS acq_date, CAST(sum(expected) AS BIGINT) AS expected, CAST(sum(acquired) AS BIGINT) AS acquired, CAST(sum(expected) - sum(acquired) AS BIGINT) AS missing, bool_or(hole) AS interior_missing FROM s GROUP BY 1, 2""")
def d14_missing_bursts(spark, sf_dir):
    fb, lb, fi, b = _v(spark, sf_dir, "frame_bursts", "file_bursts", "files", "bursts")
    return C.completeness(fb, b, lb, fi).select("polyid", _day(), "expected", "acquired", "missing", "interior_missing")


@query("""WITH k AS (SELECT DISTINCT bid FROM @frame_bursts WHERE bid % 3 <> 1) SELECT b.bid, CASE WHEN EXISTS (SELECT 1 FROM k WHERE k.bid = b.bid) THEN b.bid WHEN EXISTS (SELECT 1 FROM k WHERE k.bid = b.bid + 1) THEN b.bid + 1 ELSE b.bid - 1 END AS matched
    FROM @bursts b WHERE EXISTS (SELECT 1 FROM k WHERE k.bid BETWEEN b.bid - 1 AND b.bid + 1)""")
def d13_tolerant_match(spark, sf_dir):
    b, fb = _v(spark, sf_dir, "bursts", "frame_bursts")
    return C.tolerant_match(b, fb.filter("bid % 3 <> 1"), "bid")


@query("SELECT bid FROM @bursts WHERE bid NOT IN (SELECT bid FROM @frame_bursts)")
def d15_unlinked_bursts(spark, sf_dir):
    b, fb = _v(spark, sf_dir, "bursts", "frame_bursts")
    return C.without_match(b, fb, ["bid"]).select("bid")


@query("""SELECT fid FROM @files f WHERE EXISTS (SELECT 1 FROM @file_bursts b JOIN @frame_bursts g USING (bid) JOIN @frames h USING (polyid) WHERE b.fid = f.fid AND h.polyid_name LIKE '___D%') OR NOT EXISTS (SELECT 1 FROM @file_bursts b WHERE b.fid = f.fid)""")
def d16_related_files(spark, sf_dir):
    """Files that see a frame of a descending pass, or nothing known."""
    fi, lb, fb, f = _v(spark, sf_dir, "files", "file_bursts", "frame_bursts", "frames")
    return C.related_files(fi, lb, fb.join(f.filter("polyid_name like '___D%'"), "polyid", "left_semi")).select("fid")


@query("SELECT fid, fid % 3 = 0 AS on_disk FROM @files")
def d17_inventory(spark, sf_dir):
    fi = view(spark, sf_dir, "files").select("fid", F.concat(F.lit("S1_"), "fid", F.when(F.col("fid") % 2 == 0, ".metadata_only").otherwise("")).alias("name"))
    return C.split_by_inventory(fi, fi.filter("fid % 3 = 0").select(F.concat(F.lit("S1_"), "fid").alias("name")), "name").select("fid", "on_disk")


@query("SELECT frame, CAST(epoch AS VARCHAR) AS epoch FROM @epochs e WHERE NOT EXISTS (SELECT 1 FROM @pairs p WHERE p.frame = e.frame AND e.epoch IN (p.epoch1, p.epoch2)) AND day(epoch) % 5 <> 0")
def d18_unprocessed(spark, sf_dir):
    e, p = _v(spark, sf_dir, "epochs", "pairs")
    done = p.select("frame", F.explode(F.array("epoch1", "epoch2")).alias("epoch"))
    no_overlap = e.filter(F.dayofmonth("epoch") % 5 == 0)
    left = C.without_match(C.without_match(e, done, ["frame", "epoch"]), no_overlap, ["frame", "epoch"])
    return left.select("frame", F.col("epoch").cast("string").alias("epoch"))


@query("""SELECT p.frame AS polyid, a.id AS id1, b.id AS id2, CAST(p.epoch2 - p.epoch1 AS BIGINT) AS date_gap, CAST(0 AS BIGINT) AS status FROM @pairs p
    JOIN (SELECT frame, epoch, frame * 100000 + dayofyear(epoch) AS id FROM @epochs) a ON a.frame = p.frame AND a.epoch = p.epoch1 JOIN (SELECT frame, epoch, frame * 100000 + dayofyear(epoch) AS id FROM @epochs) b ON b.frame = p.frame AND b.epoch = p.epoch2""")
def d19_register_products(spark, sf_dir):
    e, p = _v(spark, sf_dir, "epochs", "pairs")
    products = e.select(F.col("frame").alias("polyid"), "epoch", (F.col("frame") * 100000 + F.dayofyear("epoch")).alias("id"))
    done = C.register_pairs(p.withColumnRenamed("frame", "polyid"), products)
    return done.select("polyid", "id1", "id2", F.col("date_gap").cast("long").alias("date_gap"), F.col("status").cast("long").alias("status"))


@query(f"""SELECT q.id, f.polyid, f.polyid_name, CAST(substr(f.polyid_name, 1, 3) AS BIGINT) AS track, CAST(CAST(substr(f.polyid_name, 1, 3) AS BIGINT) AS VARCHAR) || '/' || f.polyid_name AS link, CAST(CAST(q.ts AS DATE) + 6 AS VARCHAR) AS next_possible, round(f.lon1, 3) AS lon1, round(f.lat1, 3) AS lat1
    FROM (SELECT *, {QUAKE_RADIUS} AS r FROM @quakes) q JOIN @frames f ON q.lon + r >= f.lon1 AND f.lon2 >= q.lon - r AND q.lat + r >= f.lat1 AND f.lat2 >= q.lat - r""")
def d20_event_report(spark, sf_dir):
    from fringeline.operators.spatial import BOX, quake_frame_rows

    q, f = _v(spark, sf_dir, "quakes", "frames")
    q = q.select("id", "lon", "lat", "magnitude", "depth", F.to_date("ts").alias("post_acq"))
    r = C.event_report(quake_frame_rows(q, f.select("polyid", "polyid_name", *BOX)))
    return r.select("id", "polyid", "polyid_name", "track", "link", F.to_date("next_acq").cast("string").alias("next_possible"), F.round("lon1", 3).alias("lon1"), F.round("lat1", 3).alias("lat1"))


def _no_event_frames(spark):
    return spark.createDataFrame([], "id long, polyid long, post_acq date, next_acq date, last_acq date")


@query("SELECT DISTINCT n.n_nationkey AS clip, v.volc_id FROM @volcanoes v JOIN customer c ON c.c_custkey = v.volc_id JOIN nation n ON n.n_nationkey = c.c_nationkey")
def d26_volcano_clips(spark, sf_dir):
    v, c, n = view(spark, sf_dir, "volcanoes"), table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    links = c.select(F.col("c_nationkey").alias("vid"), F.col("c_custkey").alias("volc_id"))
    return C.volcano_clips(v, links, n.select(F.col("n_nationkey").alias("vid"))).select(F.col("vid").alias("clip"), "volc_id")


@query("SELECT DISTINCT CAST(acq_date AS VARCHAR) AS acq_date FROM @files UNION SELECT DISTINCT CAST(epoch AS VARCHAR) FROM @epochs")
def e01_distinct_epochs(spark, sf_dir):
    f, e = _v(spark, sf_dir, "files", "epochs")
    return f.select(_day()).union(e.select(F.col("epoch").cast("string"))).distinct()


@query("SELECT polyid, round(min(lon1), 3) + 0.0 AS lon1, round(max(lon2), 3) + 0.0 AS lon2, round(min(lat1), 3) + 0.0 AS lat1, round(max(lat2), 3) + 0.0 AS lat2 FROM @frame_bursts JOIN @bursts USING (bid) GROUP BY polyid")
def e02_bounding_box(spark, sf_dir):
    from fringeline.operators.spatial import bounding_box

    fb, b = _v(spark, sf_dir, "frame_bursts", "bursts")
    box = bounding_box(fb.join(b, "bid"), ["polyid"])
    return box.select("polyid", *[(F.round(c, 3) + F.lit(0.0)).alias(c) for c in ("lon1", "lon2", "lat1", "lat2")])


@query("SELECT job, CAST(CASE WHEN count(CASE WHEN failed THEN 1 END) = 0 THEN 3 WHEN count(CASE WHEN failed THEN 1 END) < count(*) THEN 4 ELSE 5 END AS BIGINT) AS status, count(*) AS requests, count(CASE WHEN failed THEN 1 END) AS failures FROM @jobs GROUP BY job")
def e15_job_status(spark, sf_dir):
    return C.job_status(view(spark, sf_dir, "jobs")).withColumn("status", F.col("status").cast("long"))


@query("SELECT v.volc_id, e.frame AS vid, day(e.epoch) % 2 AS subframe, min(CAST(e.epoch AS VARCHAR)) AS sourceframe, count(DISTINCT e.epoch) - 1 AS epochs FROM @volcanoes v JOIN @epochs e ON e.frame = v.volc_id % 60 GROUP BY 1, 2, 3")
def e16_clip_status(spark, sf_dir):
    v, e = _v(spark, sf_dir, "volcanoes", "epochs")
    rows = e.select(F.col("frame").alias("vid"), (F.dayofmonth("epoch") % 2).cast("long").alias("subframe"), F.col("epoch").cast("string").alias("sourceframe"), "epoch")
    return C.clip_status(v.select("volc_id", (F.col("volc_id") % 60).alias("vid")), rows).select("volc_id", "vid", "subframe", "sourceframe", "epochs")


@query("SELECT frame, CAST(epoch AS VARCHAR) AS epoch, count(*) AS flags FROM (SELECT frame, epoch1 AS epoch FROM @pairs UNION ALL SELECT frame, epoch2 FROM @pairs) GROUP BY frame, epoch HAVING count(*) > 2")
def e17_bad_epochs(spark, sf_dir):
    from fringeline.operators.network import voted_epochs

    return voted_epochs(view(spark, sf_dir, "pairs"), 2).select("frame", F.col("epoch").cast("string").alias("epoch"), "flags")


@query("""SELECT e.frame, count(*) AS epochs, count(CASE WHEN day(epoch) % 3 > 0 THEN 1 END) AS corrected, 2 * count(CASE WHEN day(epoch) % 3 > 0 THEN 1 END) >= count(*) AS half, CAST(CASE WHEN max(p.n) >= 5 THEN 6 ELSE 12 END AS BIGINT) AS step
    FROM @epochs e LEFT JOIN (SELECT frame, count(*) AS n FROM @pairs WHERE epoch2 - epoch1 = 6 GROUP BY frame) p ON p.frame = e.frame GROUP BY e.frame""")
def e18_availability(spark, sf_dir):
    e, p = _v(spark, sf_dir, "epochs", "pairs")
    six = p.filter(F.datediff("epoch2", "epoch1") == 6).groupBy("frame").agg(F.count("*").alias("n"))
    has = F.dayofmonth("epoch") % 3 > 0
    gate = e.groupBy("frame").agg(F.count("*").alias("epochs"), F.count_if(has).alias("corrected")).withColumn("half", 2 * F.col("corrected") >= F.col("epochs"))
    return gate.join(six, "frame", "left").select("frame", "epochs", "corrected", "half", F.when(F.col("n") >= 5, 6).otherwise(12).cast("long").alias("step"))


@query("""WITH b AS (SELECT l_suppkey AS frame, l_shipdate AS epoch, l_quantity * 20 - 100 AS bperp, row_number() OVER (PARTITION BY l_suppkey, l_shipdate ORDER BY l_orderkey, l_linenumber) AS n FROM lineitem),
    alt AS (SELECT l_suppkey AS frame, avg(l_tax * 100) AS alt FROM lineitem GROUP BY 1)
    SELECT frame, CAST(CAST(epoch AS DATE) AS VARCHAR) AS epoch, round(CASE WHEN abs(bperp) > 800 THEN 0 WHEN abs(bperp) > 400 THEN coalesce(alt, bperp) ELSE bperp END, 6) AS bperp FROM b LEFT JOIN alt USING (frame) WHERE n = 1""")
def e19_baseline_repair(spark, sf_dir):
    from fringeline.operators.network import repaired_baselines

    t = table(spark, sf_dir, "lineitem")
    b = t.select(F.col("l_suppkey").alias("frame"), F.to_date("l_shipdate").alias("epoch"), (F.col("l_quantity") * 20 - 100).alias("bperp"), F.struct("l_orderkey", "l_linenumber").alias("seq"))
    alt = t.select(F.col("l_suppkey").alias("frame"), (F.col("l_tax") * 100).alias("bperp"))
    return repaired_baselines(b, alt).select("frame", F.col("epoch").cast("string").alias("epoch"), F.round("bperp", 6).alias("bperp"))


@query("SELECT relorb, min(bid) AS bid, count(*) AS n FROM @bursts GROUP BY relorb")
def e22_one_per_track(spark, sf_dir):
    b = view(spark, sf_dir, "bursts")
    first = C.keep_first(b, ["relorb"], [F.col("bid")]).select("relorb", "bid")
    return first.join(b.groupBy("relorb").agg(F.count("*").alias("n")), "relorb")


@query("""WITH s AS (SELECT series AS frame, acq_date AS epoch, sum(size % 7) AS size FROM @files GROUP BY 1, 2), r AS (SELECT frame, arg_min(size, epoch) AS ref FROM s GROUP BY 1)
    SELECT frame, CAST(epoch AS VARCHAR) AS epoch, CAST(size AS BIGINT) AS size, size = ref AS complete FROM s JOIN r USING (frame)""")
def e23_complete_epochs(spark, sf_dir):
    """A frame's first epoch is its reference."""
    f = view(spark, sf_dir, "files").select(F.col("series").alias("frame"), F.col("acq_date").alias("epoch"), (F.col("size") % 7).alias("size"), "fid")
    first = f.groupBy("frame").agg(F.min("epoch").alias("epoch"))
    return C.complete_epochs(f, f.join(first, ["frame", "epoch"], "left_semi")).select("frame", F.col("epoch").cast("string").alias("epoch"), "size", "complete")


@query("SELECT e.frame, CAST(min(epoch) AS VARCHAR) AS first, CAST(max(epoch) AS VARCHAR) AS last, count(DISTINCT epoch) AS epochs, coalesce(max(p.n), 0) AS pairs FROM @epochs e LEFT JOIN (SELECT frame, count(*) AS n FROM @pairs GROUP BY frame) p ON p.frame = e.frame GROUP BY e.frame")
def e35_summary(spark, sf_dir):
    e, p = _v(spark, sf_dir, "epochs", "pairs")
    n = p.groupBy("frame").agg(F.count("*").alias("pairs"))
    s = e.groupBy("frame").agg(F.min("epoch").cast("string").alias("first"), F.max("epoch").cast("string").alias("last"), F.count_distinct("epoch").alias("epochs"))
    return s.join(n, "frame", "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)))


@query("SELECT frame, CAST(epoch AS VARCHAR) AS epoch FROM (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY epoch DESC) AS n FROM @epochs) WHERE n <= 2")
def g01_last_n(spark, sf_dir):
    from fringeline.operators.network import last_epochs

    return last_epochs(view(spark, sf_dir, "epochs"), 2).select("frame", F.col("epoch").cast("string").alias("epoch"))


@query("SELECT frame, array_to_string(list(CAST(epoch AS VARCHAR) ORDER BY epoch), ',') AS epochs FROM @epochs GROUP BY frame")
def g02_sorted_lists(spark, sf_dir):
    e = view(spark, sf_dir, "epochs").groupBy("frame").agg(F.array_sort(F.collect_set("epoch")).alias("e"))
    return e.select("frame", F.array_join(F.transform("e", lambda d: d.cast("string")), ",").alias("epochs"))


@query("SELECT fid FROM @files WHERE pol = 'VV' UNION SELECT fid FROM @file_bursts WHERE burst_no > 3")
def g03_union(spark, sf_dir):
    f, b = _v(spark, sf_dir, "files", "file_bursts")
    return f.filter("pol = 'VV'").select("fid").union(b.filter("burst_no > 3").select("fid")).distinct()


@query("(SELECT DISTINCT CAST(epoch AS VARCHAR) AS epoch FROM @epochs WHERE frame % 2 = 0 INTERSECT SELECT CAST(epoch AS VARCHAR) FROM @epochs WHERE frame % 2 = 1) EXCEPT SELECT CAST(epoch AS VARCHAR) FROM @epochs WHERE frame = 3")
def g04_intersect(spark, sf_dir):
    e = view(spark, sf_dir, "epochs").select("frame", F.col("epoch").cast("string").alias("epoch"))
    both = e.filter("frame % 2 = 0").select("epoch").intersect(e.filter("frame % 2 = 1").select("epoch"))
    return both.join(e.filter("frame = 3").select("epoch").distinct(), "epoch", "left_anti")


@query("SELECT polyid FROM @frames WHERE polyid_name LIKE '___D%' UNION SELECT polyid FROM @frame_bursts JOIN @bursts USING (bid) WHERE iw = 3 GROUP BY polyid HAVING count(*) > 20")
def g05_custom_frames(spark, sf_dir):
    """Frames of descending passes, and those found to have more than twenty bursts in the third swath."""
    f, fb, b = _v(spark, sf_dir, "frames", "frame_bursts", "bursts")
    found = fb.join(b.filter("iw = 3"), "bid").groupBy("polyid").count().filter("count > 20")
    return f.filter("polyid_name like '___D%'").select("polyid").union(found.select("polyid")).distinct()


@query("SELECT DISTINCT strftime(a.epoch1, '%Y%m%d') || '_' || strftime(a.epoch2, '%Y%m%d') AS pair FROM @pairs a JOIN @pairs b ON a.epoch1 = b.epoch1 AND a.epoch2 = b.epoch2 WHERE a.frame % 2 = 0 AND b.frame % 2 = 1 AND day(a.epoch1) <> 5")
def g06_shared_pairs(spark, sf_dir):
    from fringeline.functions.scalar import pair_name

    p = view(spark, sf_dir, "pairs").select("frame", "epoch1", pair_name(F.col("epoch1"), F.col("epoch2")).alias("pair"))
    merged = p.filter(F.dayofmonth("epoch1") == 5).select("pair").distinct()
    return p.filter("frame % 2 = 0").select("pair").intersect(p.filter("frame % 2 = 1").select("pair")).join(merged, "pair", "left_anti")


@query("SELECT b.bid, (SELECT count(*) FROM @frame_bursts f WHERE f.bid = b.bid) = 0 AND b.bid % 2 = 0 AS deleted FROM @bursts b")
def h01_delete(spark, sf_dir):
    b, fb = _v(spark, sf_dir, "bursts", "frame_bursts")
    left = C.delete_keys(b, C.deletable_bursts(b.filter("bid % 2 = 0"), fb), ["bid"]).select("bid", F.lit(False).alias("deleted"))
    return b.select("bid").join(left, "bid", "left").withColumn("deleted", F.coalesce("deleted", F.lit(True)))


_DOOMED = "(SELECT b.bid FROM @bursts b WHERE b.bid % 2 = 0 AND NOT EXISTS (SELECT 1 FROM @frame_bursts f WHERE f.bid = b.bid AND f.polyid % 3 = 0))"
_LOST = f"(SELECT DISTINCT fid FROM @file_bursts JOIN {_DOOMED} USING (bid))"


@query(f"""SELECT 'bursts' AS "table", bid AS id FROM @bursts WHERE bid NOT IN (SELECT bid FROM {_DOOMED}) UNION ALL SELECT 'files', fid FROM @files WHERE fid NOT IN (SELECT fid FROM {_LOST})
    UNION ALL SELECT DISTINCT 'file_bursts', fid FROM @file_bursts WHERE fid NOT IN (SELECT fid FROM {_LOST}) UNION ALL SELECT 'file_jobs', fid FROM @files WHERE fid NOT IN (SELECT fid FROM {_LOST}) UNION ALL SELECT 'offsets', bid FROM @bursts WHERE bid NOT IN (SELECT bid FROM {_DOOMED})""")
def h01_cascade(spark, sf_dir):
    """Bursts with an even number go, but for those in a third of the frames, and their files with all that hangs on them."""
    b, fb, f, lb = _v(spark, sf_dir, "bursts", "frame_bursts", "files", "file_bursts")
    tables = {"bursts": b, "frame_bursts": fb.filter("polyid % 3 = 0"), "files": f, "file_bursts": lb, "file_jobs": f.select("fid"), "offsets": b.select("bid")}
    left = C.delete_bursts(tables, b.filter("bid % 2 = 0"))
    rows = [left[t].select(F.lit(t).alias("table"), F.col(k).alias("id")).distinct() for t, k in (("bursts", "bid"), ("files", "fid"), ("file_bursts", "fid"), ("file_jobs", "fid"), ("offsets", "bid"))]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3]).union(rows[4])


@query("""SELECT 'files' AS "table", fid, count(*) AS n FROM @files WHERE pol <> 'VH' GROUP BY fid UNION ALL SELECT 'file_bursts', fid, count(*) FROM @file_bursts WHERE fid NOT IN (SELECT fid FROM @files WHERE pol = 'VH') GROUP BY fid""")
def h01_delete_files(spark, sf_dir):
    f, lb = _v(spark, sf_dir, "files", "file_bursts")
    left = C.delete_files({"files": f, "file_bursts": lb, "file_jobs": f.select("fid")}, f.filter("pol = 'VH'"))
    return left["files"].groupBy(F.lit("files").alias("table"), "fid").agg(F.count("*").alias("n")).union(left["file_bursts"].groupBy(F.lit("file_bursts").alias("table"), "fid").agg(F.count("*").alias("n")))


@query("SELECT polyid, bid FROM @frame_bursts UNION ALL SELECT (SELECT max(polyid) + 1 FROM @frames), bid FROM @frame_bursts WHERE polyid = 2")
def h02_clone_frame(spark, sf_dir):
    f, fb = _v(spark, sf_dir, "frames", "frame_bursts")
    return C.clone_frame(f, fb, 2, "copy")[1]


@query("SELECT polyid, CASE WHEN polyid = 3 THEN '003X_00000_000000' ELSE polyid_name END AS polyid_name FROM @frames")
def h03_update(spark, sf_dir):
    f = view(spark, sf_dir, "frames").select("polyid", "polyid_name")
    return C.update_where(f, F.col("polyid") == 3, {"polyid_name": F.lit("003X_00000_000000")})


@query("""WITH o AS (SELECT o_orderkey AS id, o_totalprice AS v FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1e-9 ELSE o_totalprice + 1 END AS v FROM orders WHERE o_orderkey % 5 <> 0)
    SELECT coalesce(o.id, n.id) AS id, round(CASE WHEN n.id IS NOT NULL AND (o.id IS NULL OR round(o.v, 6) <> round(n.v, 6)) THEN n.v ELSE o.v END, 4) AS v FROM o FULL JOIN n ON o.id = n.id""")
def h04_upsert(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    old = o.filter(k % 3 != 0).select(k.alias("id"), F.col("o_totalprice").alias("v"))
    new = o.filter(k % 5 != 0).select(k.alias("id"), F.when(k % 2 == 0, F.col("o_totalprice") + 1e-9).otherwise(F.col("o_totalprice") + 1).alias("v"))
    return C.upsert_offsets(old, new, ["id"], ["v"]).select("id", F.round("v", 4).alias("v"))


@query("""WITH t AS (SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 3 = 0) SELECT id, name FROM t UNION ALL SELECT (SELECT max(id) FROM t) + row_number() OVER (ORDER BY c_name), c_name FROM customer WHERE c_custkey % 3 <> 0""")
def h05_insert_absent(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return C.insert_numbered(c.filter("id % 3 = 0"), c, "name", "id")


@query("""WITH n AS (SELECT DISTINCT q.id, q.id % 25 AS polyid, CASE WHEN q.depth < 40 THEN CAST(q.ts AS DATE) END AS post_acq FROM @quakes q)
    SELECT id, polyid, CAST(CASE WHEN id % 4 = 0 THEN NULL ELSE post_acq END AS VARCHAR) AS post_acq, CAST(CASE WHEN id % 4 = 0 THEN NULL ELSE post_acq + 6 END AS VARCHAR) AS next_acq, CAST(CASE WHEN id % 4 = 0 THEN NULL ELSE post_acq + 24 END AS VARCHAR) AS last_acq FROM n""")
def h05_event_frames(spark, sf_dir):
    """A quarter of the events is known already, without an acquisition."""
    q = view(spark, sf_dir, "quakes").select("id", (F.col("id") % 25).alias("polyid"), F.when(F.col("depth") < 40, F.to_date("ts")).alias("post_acq"))
    old = C.insert_event_frames(_no_event_frames(spark), q.filter("id % 4 = 0").withColumn("post_acq", F.lit(None).cast("date")))
    return C.insert_event_frames(old, q).select("id", "polyid", *[F.to_date(c).cast("string").alias(c) for c in ("post_acq", "next_acq", "last_acq")])


_CLIPS = "(SELECT volc_id AS vid, lon - 0.1 AS lon1, lon + 0.1 AS lon2, lat - 0.1 AS lat1, lat + 0.1 AS lat2 FROM @volcanoes)"


def _clips(spark, sf_dir, *half):
    v = view(spark, sf_dir, "volcanoes")
    return v.select(F.col("volc_id").alias("vid"), *[(F.col(c[:3]) + s * half[0]).alias(c) for c, s in (("lon1", -1), ("lon2", 1), ("lat1", -1), ("lat2", 1))])


@query("SELECT volc_id AS vid, round(lon - CASE WHEN volc_id % 3 = 0 THEN 0.2 ELSE 0.1 END, 4) AS lon1, round(lat + CASE WHEN volc_id % 3 = 0 THEN 0.2 ELSE 0.1 END, 4) AS lat2 FROM @volcanoes")
def h06_replace_clips(spark, sf_dir):
    """Larger areas for each third volcano, smaller ones, which are refused, for the next."""
    old, large, small = (_clips(spark, sf_dir, h) for h in (0.1, 0.2, 0.05))
    new = large.filter("vid % 3 = 0").unionByName(small.filter("vid % 3 = 1"))
    return C.replace_clips(old, new).select("vid", F.round("lon1", 4).alias("lon1"), F.round("lat2", 4).alias("lat2"))


@query(f"SELECT c.vid, v.volc_id FROM {_CLIPS} c JOIN @volcanoes v ON v.lon BETWEEN c.lon1 AND c.lon2 AND v.lat BETWEEN c.lat1 AND c.lat2 WHERE c.vid % 5 <> 0 UNION SELECT volc_id, volc_id FROM @volcanoes WHERE volc_id % 2 = 0 AND volc_id % 5 <> 0")
def h06_link_clips(spark, sf_dir):
    """Volcanoes are linked to the clips that they lie in; each fifth clip is then deleted with its links."""
    from fringeline.operators.spatial import points_in_boxes

    v, clips = view(spark, sf_dir, "volcanoes"), _clips(spark, sf_dir, 0.1)
    inside = points_in_boxes(v.select("volc_id", "lon", "lat"), clips).select("vid", "volc_id")
    links = C.link_clips(v.filter("volc_id % 2 = 0").select(F.col("volc_id").alias("vid"), "volc_id"), inside)
    return C.delete_clips(clips, links, clips.filter("vid % 5 = 0"))[1]


@query("SELECT volc_id, lon, lat FROM @volcanoes WHERE volc_id % 2 = 0 UNION ALL SELECT volc_id, lon, lat FROM @volcanoes v WHERE volc_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM @volcanoes o WHERE o.volc_id % 2 = 0 AND abs(o.lon - v.lon) <= 2 AND abs(o.lat - v.lat) <= 2)")
def h06_add_clips(spark, sf_dir):
    """A clip is added only where no clip lies within two degrees."""
    from fringeline.operators.spatial import points_within

    v = view(spark, sf_dir, "volcanoes").select("volc_id", "lon", "lat")
    old, new = v.filter("volc_id % 2 = 0"), v.filter("volc_id % 2 = 1")
    near = points_within(new, old.select(F.col("volc_id").alias("old_id"), "lon", "lat"), 2.0).select("volc_id").distinct()
    return old.unionByName(new.join(near, "volc_id", "left_anti"))


@query("SELECT frame, CAST(epoch AS VARCHAR) AS epoch FROM @epochs")
def h07_append_epochs(spark, sf_dir):
    e = view(spark, sf_dir, "epochs").select("frame", F.col("epoch").cast("string").alias("epoch"))
    return C.insert_absent(e.filter("frame % 2 = 0"), e, ["frame", "epoch"])


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def h08_latest_state(spark, sf_dir):
    return C.latest_state(table(spark, sf_dir, "events"), "user_id", "event_type", ["ts", "event_id"])
