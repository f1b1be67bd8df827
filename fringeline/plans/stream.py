"""Streaming queries: the events table replayed as a stream, against the batch form as oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from fringeline.plans.registry import Registry
from fringeline.plans.spatial import QUAKE_RADIUS
from fringeline.plans.views import view
from fringeline.streaming import operators as K

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _events(spark, sf_dir):
    return K.replay(spark, f"{sf_dir}/events.parquet")


def _quakes(spark, sf_dir):
    e, k = _events(spark, sf_dir).filter("event_type = 'error'"), F.col("event_id")
    place = lambda a, n, o: ((k * a) % n).cast("double") / 10 - o
    return e.select(k.alias("id"), ((55 + k % 31).cast("double") / 10).alias("magnitude"), (k % 60).cast("double").alias("depth"), "ts", place(41, 3600, 180).alias("lon"), place(59, 1400, 70).alias("lat"))


def _s(c, alias=None):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(alias or c)


_T = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


@query("SELECT id, round(magnitude, 1) AS magnitude, ts > TIMESTAMP '2024-01-31' - INTERVAL 10 DAY AS active FROM @quakes WHERE magnitude >= 6")
def k01_event_feed(spark, sf_dir):
    """The feed repeats every event."""
    q = _quakes(spark, sf_dir)
    return K.run_to_end(K.event_feed(q.unionByName(_quakes(spark, sf_dir)), "id", F.col("magnitude") >= 6, "40 days", F.lit("2024-01-31").cast("timestamp"))).select("id", F.round("magnitude", 1).alias("magnitude"), "active")


@query(f"SELECT q.id, f.polyid FROM (SELECT *, {QUAKE_RADIUS} AS r FROM @quakes) q JOIN @frames f ON q.lon + r >= f.lon1 AND f.lon2 >= q.lon - r AND q.lat + r >= f.lat1 AND f.lat2 >= q.lat - r")
def k02_events_with_frames(spark, sf_dir):
    return K.run_to_end(K.events_with_frames(_quakes(spark, sf_dir), view(spark, sf_dir, "frames")))


@query(f"SELECT q.frame, q.id, {_T.format('q.ts')} AS ts, {_T.format('a.ts')} AS acq_ts FROM (SELECT id, id % 15 AS frame, ts FROM @quakes) q JOIN events a ON a.event_type = 'purchase' AND a.user_id = q.frame AND a.ts > q.ts AND a.ts <= q.ts + INTERVAL 3 DAY")
def k03_coseismic_triggers(spark, sf_dir):
    q = _quakes(spark, sf_dir).withColumn("frame", F.col("id") % 15)
    a = _events(spark, sf_dir).filter("event_type = 'purchase'").select(F.col("user_id").alias("frame"), F.col("ts").alias("acq_ts"))
    return K.run_to_end(K.coseismic_triggers(q, a, "3 days", "40 days")).select("frame", "id", _s("ts"), _s("acq_ts"))


_N = "(SELECT *, row_number() OVER (PARTITION BY frame ORDER BY epoch) AS n FROM @epochs)"


@query(f"SELECT a.frame, CAST(a.epoch AS VARCHAR) AS epoch1, CAST(b.epoch AS VARCHAR) AS epoch2 FROM {_N} a JOIN {_N} b ON a.frame = b.frame AND b.n BETWEEN a.n + 1 AND a.n + 3")
def k04_incremental_network(spark, sf_dir):
    e = _events(spark, sf_dir).filter("event_type = 'purchase'").select(F.col("user_id").alias("frame"), F.to_date("ts").alias("epoch"), "ts")
    return K.run_to_end(K.incremental_network(e, "40 days")).select("frame", F.col("epoch1").cast("string").alias("epoch1"), F.col("epoch2").cast("string").alias("epoch2"))


@query(f"""WITH a AS (SELECT user_id AS frame, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events WHERE event_type = 'purchase'), r AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts > prev + INTERVAL 2 DAY THEN 1 ELSE 0 END) OVER (PARTITION BY frame ORDER BY ts) AS run FROM a)
    SELECT frame, {_T.format('min(ts)')} AS start, {_T.format('max(ts) + INTERVAL 2 DAY')} AS stop, count(*) AS n FROM r GROUP BY frame, run HAVING max(ts) + INTERVAL 2 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events WHERE event_type = 'purchase')""")
def k05_acquisition_runs(spark, sf_dir):
    a = _events(spark, sf_dir).filter("event_type = 'purchase'").select(F.col("user_id").alias("frame"), "ts")
    return K.run_to_end(K.acquisition_runs(a, "2 days", "1 hour")).select("frame", _s("start"), _s("stop"), "n")


@query(f"""WITH w AS (SELECT user_id, time_bucket(INTERVAL 3 DAY, ts, TIMESTAMP '1970-01-01') AS start, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2) SELECT user_id, {_T.format('start')} AS start, n, round(total, 4) AS total FROM w WHERE start + INTERVAL 3 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def k06_tumbling(spark, sf_dir):
    return K.run_to_end(K.tumbling(_events(spark, sf_dir), "user_id", "3 days", "1 hour", "value")).select("user_id", _s("start"), "n", F.round("total", 4).alias("total"))


