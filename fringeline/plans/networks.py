"""Network and time queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fringeline.operators import network as N
from fringeline.plans.registry import Registry
from fringeline.plans.views import table, view

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _days(df, *cols):
    """Dates as text, which both engines print alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def _e(spark, sf_dir):
    return view(spark, sf_dir, "epochs")


def _p(spark, sf_dir):
    return view(spark, sf_dir, "pairs")


def _s(*cols):
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)


_N = "(SELECT *, row_number() OVER (PARTITION BY frame ORDER BY epoch) AS n FROM @epochs)"


@query(f"SELECT a.frame, CAST(a.epoch AS VARCHAR) AS epoch1, CAST(b.epoch AS VARCHAR) AS epoch2 FROM {_N} a JOIN {_N} b ON a.frame = b.frame AND b.n BETWEEN a.n + 1 AND a.n + 3")
def f01_nearest_network(spark, sf_dir):
    return _days(N.nearest_later(_e(spark, sf_dir), 3), "epoch1", "epoch2")


@query(f"SELECT a.frame, CAST(a.epoch AS VARCHAR) AS epoch1, CAST(b.epoch AS VARCHAR) AS epoch2 FROM {_N} a JOIN {_N} b ON a.frame = b.frame AND b.n BETWEEN a.n + 1 AND a.n + 2")
def f02_triplet_network(spark, sf_dir):
    return _days(N.nearest_later(_e(spark, sf_dir), 2), "epoch1", "epoch2")


@query("SELECT e.frame, CAST(least(epoch, r) AS VARCHAR) AS epoch1, CAST(greatest(epoch, r) AS VARCHAR) AS epoch2 FROM @epochs e JOIN (SELECT frame, max(epoch) AS r FROM @epochs WHERE day(epoch) <= 15 GROUP BY frame) x ON x.frame = e.frame WHERE epoch <> r")
def f03_single_reference(spark, sf_dir):
    e = _e(spark, sf_dir)
    ref = e.filter(F.dayofmonth("epoch") <= 15).groupBy("frame").agg(F.max("epoch").alias("reference"))
    return _days(N.single_reference(e, ref), "epoch1", "epoch2")


_GAPS = "(SELECT frame, epoch AS start, nxt AS stop FROM (SELECT frame, epoch, lead(epoch) OVER (PARTITION BY frame ORDER BY epoch) AS nxt FROM @epochs) c WHERE nxt IS NOT NULL AND NOT EXISTS (SELECT 1 FROM @pairs p WHERE p.frame = c.frame AND p.epoch1 <= c.epoch AND p.epoch2 >= c.nxt))"


@query(f"SELECT frame, {_s('start', 'stop')} FROM {_GAPS} g")
def f04_network_gaps(spark, sf_dir):
    return _days(N.network_gaps(_e(spark, sf_dir), _p(spark, sf_dir)), "start", "stop")


@query(f"""WITH g AS (SELECT *, max(stop) OVER (PARTITION BY frame ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM {_GAPS}),
    i AS (SELECT *, sum(CASE WHEN prev IS NULL OR start - prev > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY frame ORDER BY start, stop) AS island FROM g)
    SELECT frame, CAST(min(start) AS VARCHAR) AS start, CAST(max(stop) AS VARCHAR) AS stop, CAST(max(stop) - min(start) AS BIGINT) AS days FROM i GROUP BY frame, island""")
def f05_gap_merge(spark, sf_dir):
    m = N.merge_intervals(N.network_gaps(_e(spark, sf_dir), _p(spark, sf_dir)), 1)
    return _days(m, "start", "stop").withColumn("days", F.col("days").cast("long"))


@query(f"""WITH o AS (SELECT * FROM @epochs e WHERE NOT EXISTS (SELECT 1 FROM {_GAPS} g WHERE g.frame = e.frame AND e.epoch BETWEEN g.start AND g.stop)),
    r AS (SELECT *, sum(CASE WHEN prev IS NULL OR epoch - prev > 2 THEN 1 ELSE 0 END) OVER (PARTITION BY frame ORDER BY epoch) AS run FROM (SELECT *, lag(epoch) OVER (PARTITION BY frame ORDER BY epoch) AS prev FROM o))
    SELECT frame, CAST(min(epoch) AS VARCHAR) AS start, CAST(max(epoch) AS VARCHAR) AS stop, count(*) AS n FROM r GROUP BY frame, run""")
def f06_missed_clusters(spark, sf_dir):
    e = _e(spark, sf_dir)
    return _days(N.cluster_epochs(N.outside_intervals(e, N.network_gaps(e, _p(spark, sf_dir))), 2), "start", "stop")


@query("SELECT CAST(min(epoch) AS VARCHAR) AS first, frame, substr(name, 1, 5) AS prefix, min(name) AS name FROM (SELECT frame, epoch, 'S' || lpad(CAST(frame AS VARCHAR), 4, '0') || lpad(CAST(dayofyear(epoch) * 7919 % 1000 AS VARCHAR), 9, '0') AS name FROM @epochs) GROUP BY frame, substr(name, 1, 5), epoch")
def f08_latest_processing(spark, sf_dir):
    e = _e(spark, sf_dir)
    name = F.concat(F.lit("S"), F.lpad(F.col("frame").cast("string"), 4, "0"), F.lpad((F.dayofyear("epoch") * 7919 % 1000).cast("string"), 9, "0"))
    f = N.latest_processing(e.select("frame", F.col("epoch").alias("date"), name.alias("name")), by=("frame",))
    return f.select(F.col("date").cast("string").alias("first"), "frame", F.substring("name", 1, 5).alias("prefix"), "name")


@query("""WITH g AS (SELECT frame, epoch, epoch - lag(epoch) OVER (PARTITION BY frame ORDER BY epoch) AS gap, row_number() OVER (PARTITION BY frame ORDER BY epoch DESC) AS n FROM @epochs), s AS (SELECT frame, max(epoch) AS last, max(gap) AS worst FROM g WHERE n <= 5 GROUP BY frame)
    SELECT frame, CAST(last AS VARCHAR) AS last, CAST(worst AS BIGINT) AS worst, CAST(last + 6 AS VARCHAR) AS next_possible, CAST(last + CAST(coalesce(worst, 6) AS INTEGER) AS VARCHAR) AS next_expected,
    CAST(last + CAST(greatest(ceil((DATE '2024-03-01' - last) / 6.0), 1) * 6 AS INTEGER) AS VARCHAR) AS after_event FROM s""")
def f09_revisit_forecast(spark, sf_dir):
    f = N.revisit_forecast(_e(spark, sf_dir), F.lit("2024-03-01").cast("date"))
    return _days(f, "last", "next_possible", "next_expected", "after_event").withColumn("worst", F.col("worst").cast("long"))


@query("""WITH b AS (SELECT frame, epoch, epoch1, d FROM (SELECT e.frame, e.epoch, p.epoch AS epoch1, abs(p.epoch - e.epoch) AS d FROM @epochs e JOIN @epochs p ON p.frame = e.frame AND p.epoch <> e.epoch AND day(p.epoch) % 2 = 0 AND (day(p.epoch) % 3 >= day(e.epoch) % 3)
    AND abs(p.epoch - e.epoch) < abs(DATE '2024-01-15' - e.epoch) AND abs(p.epoch - e.epoch) <= 181))
    SELECT e.frame, CAST(e.epoch AS VARCHAR) AS epoch, CAST(x.epoch1 AS VARCHAR) AS aux FROM @epochs e LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY frame, epoch ORDER BY d, epoch1) AS n FROM b) x ON x.frame = e.frame AND x.epoch = e.epoch AND x.n = 1""")
def f10_auxiliary_epoch(spark, sf_dir):
    """Epochs hold bursts 0 .. day % 3."""
    e = _e(spark, sf_dir).select("frame", "epoch", F.sequence(F.lit(0), F.dayofmonth("epoch") % 3).alias("bursts"))
    done = e.filter(F.dayofmonth("epoch") % 2 == 0).select("frame", F.col("epoch").alias("aux"), F.col("bursts").alias("aux_bursts"))
    out = N.auxiliary_epochs(e.withColumn("reference", F.lit("2024-01-15").cast("date")), done)
    return _days(out, "epoch", "aux").select("frame", "epoch", "aux")


@query("SELECT frame, CAST(epoch AS VARCHAR) AS epoch, row_number() OVER (PARTITION BY frame ORDER BY abs(epoch - DATE '2024-01-15'), epoch) AS place FROM @epochs")
def f11_processing_order(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("frame").orderBy(F.abs(F.datediff("epoch", F.lit("2024-01-15").cast("date"))), "epoch")
    return _days(_e(spark, sf_dir).select("frame", "epoch", F.row_number().over(w).cast("long").alias("place")), "epoch")


_TIMED = "(SELECT p.*, a.acq_ts AS ts1, b.acq_ts AS ts2 FROM @pairs p JOIN @epochs a ON a.frame = p.frame AND a.epoch = p.epoch1 JOIN @epochs b ON b.frame = p.frame AND b.epoch = p.epoch2)"
_EVENTS = "(SELECT id, ts, id % 15 AS frame FROM @quakes)"
_KIND = f"(SELECT t.frame, q.id, epoch1, epoch2, CASE WHEN ts2 <= q.ts THEN 'pre' WHEN ts1 > q.ts THEN 'post' ELSE 'co' END AS kind FROM {_TIMED} t JOIN {_EVENTS} q ON q.frame = t.frame AND q.ts <= ts2 + INTERVAL 10 DAY AND q.ts >= ts1 - INTERVAL 10 DAY)"


def _classified(spark, sf_dir):
    e, q = _e(spark, sf_dir), view(spark, sf_dir, "quakes")
    t = _p(spark, sf_dir)
    for i in (1, 2):
        t = t.join(e.select("frame", F.col("epoch").alias(f"epoch{i}"), F.col("acq_ts").alias(f"ts{i}")), ["frame", f"epoch{i}"])
    return N.classify_pairs(t, q.select((F.col("id") % 15).alias("frame"), "id", "ts"), 10)


@query(f"SELECT frame, id, {_s('epoch1', 'epoch2')}, kind FROM {_KIND} k")
def d22_event_pairs(spark, sf_dir):
    return _days(_classified(spark, sf_dir).select("frame", "id", "epoch1", "epoch2", "kind"), "epoch1", "epoch2")


@query(f"SELECT frame, id, {_s('epoch1', 'epoch2')} FROM (SELECT *, row_number() OVER (PARTITION BY frame, id ORDER BY epoch2 - epoch1, epoch1) AS n FROM {_KIND} k WHERE kind = 'co') WHERE n = 1")
def f12_shortest_coseismic(spark, sf_dir):
    return _days(N.shortest_coseismic(_classified(spark, sf_dir)), "epoch1", "epoch2")


@query(f"SELECT DISTINCT q.frame, q.id FROM {_EVENTS} q WHERE NOT EXISTS (SELECT 1 FROM {_KIND} k WHERE k.id = q.id AND kind = 'co' AND epoch2 - epoch1 <= 30)")
def d32_events_without_pair(spark, sf_dir):
    q = view(spark, sf_dir, "quakes").select((F.col("id") % 15).alias("frame"), "id")
    have = _classified(spark, sf_dir).filter((F.col("kind") == "co") & (F.datediff("epoch2", "epoch1") <= 30)).select("frame", "id").distinct()
    return q.join(have, ["frame", "id"], "left_anti")


@query("""WITH o AS (SELECT event_id AS file, event_id % 2 AS sat, ts - INTERVAL 1 DAY AS f, ts + INTERVAL 1 DAY AS t FROM events WHERE event_type = 'signup'), s AS (SELECT event_id AS scene, event_id % 2 AS sat, ts AS a, ts + INTERVAL 30 SECOND AS b FROM events WHERE event_type = 'purchase')
    SELECT s.scene, o.file FROM s LEFT JOIN LATERAL (SELECT file FROM o WHERE o.sat = s.sat AND o.f <= s.a AND o.t >= s.b ORDER BY o.f DESC, file DESC LIMIT 1) o ON true""")
def d23_covering_orbit(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("sat", F.col("event_id") % 2)
    day, sec = F.expr("interval 1 day"), F.expr("interval 30 seconds")
    files = e.filter("event_type = 'signup'").select(F.col("event_id").alias("file"), "sat", (F.col("ts") - day).alias("valid_from"), (F.col("ts") + day).alias("valid_to"))
    scenes = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("scene"), "sat", F.col("ts").alias("start"), (F.col("ts") + sec).alias("stop"))
    return N.covering_files(scenes, files).select("scene", "file")


@query("""WITH b AS (SELECT frame, epoch, CAST(dayofyear(epoch) * 37 % 400 - 200 AS DOUBLE) AS b FROM @epochs WHERE day(epoch) % 4 <> 0)
    SELECT p.frame, CAST(epoch1 AS VARCHAR) AS epoch1, CAST(epoch2 AS VARCHAR) AS epoch2, coalesce(y.b, 0) - coalesce(x.b, 0) AS bperp FROM @pairs p LEFT JOIN b x ON x.frame = p.frame AND x.epoch = epoch1 LEFT JOIN b y ON y.frame = p.frame AND y.epoch = epoch2""")
def d25_pair_baselines(spark, sf_dir):
    b = _e(spark, sf_dir).filter(F.dayofmonth("epoch") % 4 != 0).select("frame", "epoch", (F.dayofyear("epoch") * 37 % 400 - 200).cast("double").alias("bperp"))
    return _days(N.pair_baselines(_p(spark, sf_dir), b), "epoch1", "epoch2")


_SERIES = "(SELECT user_id AS frame, CAST(ts AS DATE) AS epoch, avg(value) AS value FROM events WHERE event_type = 'signup' GROUP BY 1, 2)"


def _series(spark, sf_dir):
    e = table(spark, sf_dir, "events").filter("event_type = 'signup'")
    return e.groupBy(F.col("user_id").alias("frame"), F.to_date("ts").alias("epoch")).agg(F.avg("value").alias("value"))


@query(f"""SELECT e.frame, CAST(e.epoch AS VARCHAR) AS epoch, round(x.value, 6) AS value FROM (SELECT frame, epoch FROM @epochs) e LEFT JOIN
    (SELECT e.frame, e.epoch, s.value, row_number() OVER (PARTITION BY e.frame, e.epoch ORDER BY abs(s.epoch - e.epoch), s.epoch) AS n FROM @epochs e JOIN {_SERIES} s ON s.frame = e.frame AND abs(s.epoch - e.epoch) <= 2) x ON x.frame = e.frame AND x.epoch = e.epoch AND x.n = 1""")
def d27_nearest_in_time(spark, sf_dir):
    out = N.nearest_in_time(_e(spark, sf_dir).select("frame", "epoch"), _series(spark, sf_dir), 2)
    return _days(out, "epoch").withColumn("value", F.round("value", 6))


@query(f"""SELECT e.frame, CAST(e.epoch AS VARCHAR) AS epoch, round(CASE WHEN a.epoch = b.epoch THEN a.value ELSE a.value + (e.epoch - a.epoch) / CAST(b.epoch - a.epoch AS DOUBLE) * (b.value - a.value) END, 6) AS value FROM (SELECT frame, epoch FROM @epochs) e
    LEFT JOIN LATERAL (SELECT epoch, value FROM {_SERIES} s WHERE s.frame = e.frame AND s.epoch <= e.epoch ORDER BY s.epoch DESC LIMIT 1) a ON true LEFT JOIN LATERAL (SELECT epoch, value FROM {_SERIES} s WHERE s.frame = e.frame AND s.epoch >= e.epoch ORDER BY s.epoch LIMIT 1) b ON true""")
def d27_linear_in_time(spark, sf_dir):
    out = N.linear_in_time(_e(spark, sf_dir).select("frame", "epoch"), _series(spark, sf_dir))
    return _days(out, "epoch").withColumn("value", F.round("value", 6))


@query("SELECT frame, CAST(epoch AS VARCHAR) AS epoch FROM @epochs e WHERE NOT EXISTS (SELECT 1 FROM events s WHERE s.event_type = 'signup' AND s.user_id = e.frame AND CAST(s.ts AS DATE) = e.epoch) AND DATE '2024-01-25' - epoch >= 3")
def d33_uncorrected_epochs(spark, sf_dir):
    e = _e(spark, sf_dir)
    late = e.filter(F.datediff(F.lit("2024-01-25").cast("date"), "epoch") >= 3)
    return _days(late.join(_series(spark, sf_dir), ["frame", "epoch"], "left_anti").select("frame", "epoch"), "epoch")


@query("""WITH m AS (SELECT o_custkey % 8 AS frame, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, avg(CAST(round(o_totalprice * 100) AS BIGINT)) / 100017e0 AS mean, coalesce(stddev_samp(CAST(round(o_totalprice * 100) AS BIGINT)), 0) / 100017e0 AS std FROM orders WHERE month(o_orderdate) <> 7 GROUP BY 1, 2),
    c AS (SELECT frame, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM m GROUP BY frame) SELECT c.frame, CAST(c.month AS VARCHAR) AS month, round(mean, 6) AS mean, round(std, 6) AS std FROM c LEFT JOIN m ON m.frame = c.frame AND m.month = c.month""")
def e14_monthly(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter(F.month("o_orderdate") != 7)
    m = N.monthly(o.select((F.col("o_custkey") % 8).alias("frame"), F.to_date("o_orderdate").alias("epoch"), F.round(F.col("o_totalprice") * 100).cast("long").alias("value")))
    # whole cents are summed alike in any order
    return _days(m, "month").select("frame", "month", *[F.round(F.col(c) / 100017.0, 6).alias(c) for c in ("mean", "std")])


@query("SELECT bid, row_number() OVER (PARTITION BY relorb, iw ORDER BY tanx, bid) - 1 AS place FROM @bursts")
def f13_burst_place(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("relorb", "iw").orderBy("tanx", "bid")
    return view(spark, sf_dir, "bursts").select("bid", (F.row_number().over(w) - 1).cast("long").alias("place"))


@query("SELECT f.polyid AS frame, CAST(coalesce(e.epoch - 1, DATE '2024-02-01' - 90) AS VARCHAR) AS start FROM @frames f LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY epoch DESC) AS n FROM @epochs) e ON e.frame = f.polyid AND e.n = 3")
def f14_start_dates(spark, sf_dir):
    f = view(spark, sf_dir, "frames").select(F.col("polyid").alias("frame"))
    return _days(N.start_dates(f, _e(spark, sf_dir), 3, F.lit("2024-02-01").cast("date")), "start")


@query(f"SELECT s.frame, CAST(s.epoch AS VARCHAR) AS epoch, round(s.value - coalesce(b.v, a.v), 6) + 0.0 AS value FROM {_SERIES} s JOIN (SELECT frame, arg_min(value, epoch) AS v FROM {_SERIES} x GROUP BY frame) a ON a.frame = s.frame LEFT JOIN (SELECT frame, arg_max(value, epoch) AS v FROM {_SERIES} y WHERE epoch < DATE '2024-01-10' GROUP BY frame) b ON b.frame = s.frame")
def f15_rereference(spark, sf_dir):
    s = N.rereference(_series(spark, sf_dir), F.lit("2024-01-10").cast("date"))
    return _days(s, "epoch").select("frame", "epoch", (F.round("value", 6) + F.lit(0.0)).alias("value"))


@query("SELECT id, CAST(6 * CASE WHEN round(magnitude, 1) < 6 THEN 3 WHEN round(magnitude, 1) < 6.5 THEN 5 WHEN round(magnitude, 1) < 7 THEN 7 WHEN round(magnitude, 1) < 7.5 THEN 9 WHEN round(magnitude, 1) < 8 THEN 5 ELSE 13 END AS BIGINT) AS days FROM @quakes")
def f09_max_post_days(spark, sf_dir):
    return view(spark, sf_dir, "quakes").select("id", N.max_post_days(F.round("magnitude", 1), F.lit(6)).cast("long").alias("days"))


@query("SELECT frame, CAST(DATE '2024-03-01' - max(epoch) AS BIGINT) AS days FROM @epochs GROUP BY frame")
def f09_days_since_last(spark, sf_dir):
    return N.days_since_last(_e(spark, sf_dir), F.lit("2024-03-01").cast("date")).withColumn("days", F.col("days").cast("long"))
