"""Pixel-stack, neighbourhood and least-squares queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from fringeline.operators import lsq as L
from fringeline.operators import raster as R
from fringeline.plans.registry import Registry
from fringeline.plans.views import table, view

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql


def _pix(spark, sf_dir):
    return view(spark, sf_dir, "pixels").withColumn("epoch", F.to_date("epoch"))


def _grid(spark, sf_dir):
    """v_grid: embeddings as two grids side by side, in thousandths so that both engines add the same integers. Their columns go on, so that pixels of
    the two would be neighbours if frames were mixed."""
    e = table(spark, sf_dir, "embeddings")
    g = e.select(F.col("vec_id").alias("row"), F.posexplode("embedding").alias("col", "v"))
    return g.select(F.floor(F.col("col") / 32).alias("frame"), "row", F.col("col").cast("long").alias("col"), F.round(F.col("v").cast("double") * 1000).cast("long").alias("value"))


_GRID = """(SELECT CAST((i - 1) // 32 AS BIGINT) AS frame, vec_id AS "row", CAST(i - 1 AS BIGINT) AS col, CAST(round(CAST(embedding[i] AS DOUBLE) * 1000) AS BIGINT) AS value FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings))"""
#: Sum of a kernel of sigma 1 over 5 x 5 cells.
_KERNEL = repr(sum(R.gauss(1.0, 2)) ** 2)
_PX = "(SELECT \"row\", col, CAST(epoch AS DATE) AS epoch, nullif(coh, 0) AS coh, pha, mag FROM @pixels)"


def _r(df, *cols, digits=6):
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in cols})


@query(f"""SELECT "row", col, round(avg(coh), 6) AS mean, round(stddev_samp(coh), 6) AS std, count(coh) AS n, round(CASE WHEN 1 - stddev_samp(coh) / avg(coh) <= 0 THEN 1e-5 ELSE 1 - stddev_samp(coh) / avg(coh) END, 6) AS stability FROM {_PX} p GROUP BY 1, 2""")
def e03_stack_stats(spark, sf_dir):
    return _r(R.stack_stats(_pix(spark, sf_dir), "coh"), "mean", "std", "stability")


@query(f"""SELECT "row", col, round(s, 6) AS std, round(CASE WHEN 1 - s / m <= 0 THEN 1e-5 ELSE 1 - s / m END, 6) AS stability FROM (SELECT "row", col, avg(coh) AS m, sqrt((pow(stddev_samp(coh), 2) * (count(coh) - 1) + (count(*) - count(coh)) * pow(avg(coh), 2)) / nullif(count(coh) - 1, 0)) AS s FROM {_PX} p GROUP BY 1, 2)""")
def e04_stack_std_compat(spark, sf_dir):
    return _r(R.stack_stats(_pix(spark, sf_dir), "coh", compat=True).select("row", "col", "std", "stability"), "std", "stability")


@query(f"""SELECT "row", col, CAST(least(floor((e2 - e1) / 10.0), 9) AS BIGINT) AS "class", CASE WHEN month(e1 + CAST(floor((e2 - e1) / 2.0) AS INTEGER)) BETWEEN 4 AND 9 THEN 'summer' ELSE 'winter' END AS season, round(avg(coh), 6) AS mean, count(DISTINCT e1) AS pairs
    FROM (SELECT "row", col, epoch AS e1, epoch + CAST(6 * (1 + month(epoch) % 4) AS INTEGER) AS e2, coh FROM {_PX} p) GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT e1) > 1""")
def e06_seasonal_coherence(spark, sf_dir):
    p = _pix(spark, sf_dir).withColumnRenamed("epoch", "epoch1").withColumn("epoch2", F.date_add("epoch1", (6 * (1 + F.month("epoch1") % 4)).cast("int")))
    return _r(R.seasonal_coherence(p), "mean")


@query(f"""SELECT month(epoch) AS m, "row", col, round(avg(coh), 6) AS mean FROM {_PX} p GROUP BY 1, 2, 3""")
def e07_monthly_coherence(spark, sf_dir):
    return _r(_pix(spark, sf_dir).groupBy(F.month("epoch").cast("long").alias("m"), "row", "col").agg(F.avg(R.valid("coh")).alias("mean")), "mean")


@query(f"""SELECT "row", col, round(median(mag), 6) AS median, count(mag) AS n FROM {_PX} p GROUP BY 1, 2""")
def e08_stack_median(spark, sf_dir):
    return _r(_pix(spark, sf_dir).groupBy("row", "col").agg(F.median(R.valid("mag")).alias("median"), F.count(R.valid("mag")).alias("n")), "median")


@query(f"""SELECT CAST(epoch AS VARCHAR) AS epoch, CAST("row" // 3 AS BIGINT) AS "row", CAST(col // 3 AS BIGINT) AS col, round(avg(re), 4) AS re, round(avg(im), 4) AS im, round(avg(CASE WHEN coh IS NOT NULL THEN coh END), 6) AS coh, count(re) AS n, count(re) < 7.2 AS masked, round(avg(CAST(floor(mag / 100) AS BIGINT)), 6) AS hgt, max(CASE WHEN mag > 40000 THEN 1 ELSE 0 END) AS water
    FROM (SELECT *, CASE WHEN coh IS NOT NULL THEN mag * cos(pha) END AS re, CASE WHEN coh IS NOT NULL THEN mag * sin(pha) END AS im FROM {_PX} p) WHERE "row" // 3 < (SELECT (max("row") + 1) // 3 FROM @pixels) AND col < 24 GROUP BY 1, 2, 3""")
def e09_multilook(spark, sf_dir):
    """With a cell's mean height and the largest value of a mask."""
    p = _pix(spark, sf_dir).withColumns({"hgt": F.floor(F.col("mag") / 100), "water": (F.col("mag") > 40_000).cast("int")})
    m = R.multilook(p, 3, None, 25, ["epoch"], also=(F.avg("hgt").alias("hgt"), F.max("water").alias("water")))
    return _r(_r(m.select(F.col("epoch").cast("string").alias("epoch"), "row", "col", "re", "im", "coh", "n", "masked", "hgt", "water"), "re", "im", digits=4), "coh", "hgt")


@query("""WITH s AS (SELECT "row", col, avg(mag) AS mag, avg(pha) AS pha, min(coh) AS k FROM @pixels GROUP BY 1, 2), z AS (SELECT "row", col, mag * cos(pha) AS a, mag * sin(pha) AS b, mag / 2 * cos(pha + k) AS c, mag / 2 * sin(pha + k) AS d FROM s)
    SELECT CAST("row" // 4 AS BIGINT) AS "row", CAST(col // 4 AS BIGINT) AS col, round(sqrt(pow(sum(a * c + b * d), 2) + pow(sum(b * c - a * d), 2)) / sum(sqrt(pow(a * c + b * d, 2) + pow(b * c - a * d, 2))), 6) AS coh FROM z GROUP BY 1, 2""")
def e10_pair_coherence(spark, sf_dir):
    s = _pix(spark, sf_dir).groupBy("row", "col").agg(F.avg("mag").alias("mag"), F.avg("pha").alias("pha"), F.min("coh").alias("k"))
    a = s.select("row", "col", (F.col("mag") * F.cos("pha")).alias("re"), (F.col("mag") * F.sin("pha")).alias("im"))
    b = s.select("row", "col", (F.col("mag") / 2 * F.cos(F.col("pha") + F.col("k"))).alias("re"), (F.col("mag") / 2 * F.sin(F.col("pha") + F.col("k"))).alias("im"))
    return _r(R.pair_coherence(a, b, 4).select("row", "col", "coh"), "coh")


_QUALITY = """(SELECT CAST(epoch AS DATE) AS epoch, count(CASE WHEN abs(coh) > 0 THEN 1 END) / CAST(count(*) AS DOUBLE) AS with_data, count(CASE WHEN abs(pha - 25) > 5 THEN 1 END) / CAST(count(*) AS DOUBLE) AS unwrapped, avg(coh) AS mean, stddev_pop(coh) AS std, min(coh) AS mn, max(coh) AS mx FROM @pixels GROUP BY 1)"""


def _quality(spark, sf_dir):
    p = _pix(spark, sf_dir).withColumn("unw", F.when(F.abs(F.col("pha") - 25) > 5, F.col("pha")).otherwise(0.0))
    return R.pair_quality(p, ["epoch"], "unw", "coh")


@query(f"SELECT CAST(epoch AS VARCHAR) AS epoch, round(with_data, 6) AS with_data, round(unwrapped, 6) AS unwrapped, round(mean, 6) AS mean, round(std, 6) AS std, round(mn, 6) AS min, round(mx, 6) AS max FROM {_QUALITY} q")
def e11_pair_quality(spark, sf_dir):
    return _r(_quality(spark, sf_dir).withColumn("epoch", F.col("epoch").cast("string")), "with_data", "unwrapped", "mean", "std", "min", "max")


@query(f"SELECT CAST(epoch AS VARCHAR) AS epoch, mean < 0.8 * max(mean) OVER (PARTITION BY year(epoch)) OR unwrapped < 0.8 * max(unwrapped) OVER (PARTITION BY year(epoch)) AS bad FROM {_QUALITY} q")
def e12_bad_pairs(spark, sf_dir):
    q = _quality(spark, sf_dir).withColumn("frame", F.year("epoch"))
    return R.bad_pairs(q, "frame", 0.8).select(F.col("epoch").cast("string").alias("epoch"), "bad")


@query("""WITH p AS (SELECT CAST(floor((CAST((l_partkey * 37) % 3600 AS DOUBLE) / 10 - 180) / 20) * 20 AS BIGINT) AS lon, CAST(floor((CAST((l_partkey * 53) % 1400 AS DOUBLE) / 10 - 70) / 20) * 20 AS BIGINT) AS lat, CAST(date_trunc('year', l_shipdate) AS DATE) AS epoch, median(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3)
    SELECT lon, lat, CAST(epoch AS VARCHAR) AS epoch, round(v - first_value(v) OVER (PARTITION BY lon, lat ORDER BY epoch), 6) + 0.0 AS value FROM p""")
def e13_grid_points(spark, sf_dir):
    t, k = table(spark, sf_dir, "lineitem"), F.col("l_partkey")
    p = t.select((((k * 37) % 3600).cast("double") / 10 - 180).alias("lon"), (((k * 53) % 1400).cast("double") / 10 - 70).alias("lat"), F.to_date(F.date_trunc("year", "l_shipdate")).alias("epoch"), F.col("l_quantity").alias("value"))
    g = R.grid_points(p, 20.0)
    return _r(g.select(F.col("lon").cast("long").alias("lon"), F.col("lat").cast("long").alias("lat"), F.col("epoch").cast("string").alias("epoch"), "value"), "value")


@query(f"""SELECT "row", col, CAST(p.epoch AS VARCHAR) AS epoch, round(pha - m, 6) + 0.0 AS pha FROM {_PX} p JOIN (SELECT CAST(epoch AS DATE) AS epoch, median(nullif(pha, 0)) AS m FROM @pixels GROUP BY 1) q ON q.epoch = p.epoch""")
def e20_remove_median(spark, sf_dir):
    p = R.remove_median(_pix(spark, sf_dir), ["epoch"], "pha")
    return _r(p.select("row", "col", F.col("epoch").cast("string").alias("epoch"), "pha"), "pha")


@query(f"""WITH s AS (SELECT CAST(year(epoch) AS BIGINT) AS place, "row", col, avg(pha) AS v FROM {_PX} p GROUP BY 1, 2, 3), d AS (SELECT b.place, median(a.v - b.v) AS step FROM s a JOIN s b ON b.place = a.place + 1 AND a."row" = b."row" AND a.col = b.col GROUP BY 1)
    SELECT p.place, round(sum(coalesce(step, 0)) OVER (ORDER BY p.place), 6) + 0.0 AS "offset" FROM (SELECT DISTINCT place FROM s) p LEFT JOIN d ON d.place = p.place""")
def e21_overlap_offsets(spark, sf_dir):
    s = _pix(spark, sf_dir).groupBy(F.year("epoch").cast("long").alias("place"), "row", "col").agg(F.avg("pha").alias("value"))
    return _r(R.overlap_offsets(s), "offset")


@query(f"""SELECT CAST(epoch AS VARCHAR) AS epoch, CAST("row" // 10 AS BIGINT) AS brow, CAST(col // 10 AS BIGINT) AS bcol, round(corr(hgt, pha), 6) AS r, round(regr_slope(pha, hgt), 6) AS slope FROM (SELECT *, mag / 100 AS hgt FROM {_PX} p) GROUP BY 1, 2, 3 HAVING abs(corr(hgt, pha)) > 0.3 AND max(hgt) - min(hgt) >= 100""")
def e24_height_correlation(spark, sf_dir):
    p = _pix(spark, sf_dir).withColumn("hgt", F.col("mag") / 100)
    h = R.height_correlation(p, ["epoch"], 10)
    return _r(h.select(F.col("epoch").cast("string").alias("epoch"), "brow", "bcol", "r", "slope"), "r", "slope")


@query(f"""SELECT CAST(epoch AS VARCHAR) AS epoch, round(stddev_pop(pha), 6) AS std_before, round(stddev_pop(pha - mag / 2000), 6) AS std_after, round(100 * (1 - stddev_pop(pha - mag / 2000) / nullif(stddev_pop(pha), 0)), 4) AS reduction FROM {_PX} p GROUP BY 1""")
def e31_correction_benefit(spark, sf_dir):
    p = _pix(spark, sf_dir).withColumn("after", F.col("pha") - F.col("mag") / 2000)
    b = R.correction_benefit(p, ["epoch"], "pha", "after").withColumn("epoch", F.col("epoch").cast("string"))
    return _r(_r(b, "std_before", "std_after"), "reduction", digits=4)


@query(f"""SELECT "row", col, CAST(epoch AS VARCHAR) AS epoch, round(2 + (pha - lo) * 3 / nullif(hi - lo, 0), 6) AS norm FROM (SELECT *, min(pha) OVER (PARTITION BY epoch) AS lo, max(pha) OVER (PARTITION BY epoch) AS hi FROM {_PX} p)""")
def e32_normalise(spark, sf_dir):
    n = R.normalise(_pix(spark, sf_dir), ["epoch"], "pha", 2.0, 5.0)
    return _r(n.select("row", "col", F.col("epoch").cast("string").alias("epoch"), "norm"), "norm")


@query(f"""WITH p AS (SELECT "row", col, epoch AS e1, CAST(epoch + INTERVAL 1 MONTH AS DATE) AS e2, pha FROM {_PX} x) SELECT p."row", p.col, CAST(e1 AS VARCHAR) AS epoch1, round(p.pha - (b.mag - a.mag) / 1017, 6) + 0.0 AS pha FROM p JOIN {_PX} a ON a."row" = p."row" AND a.col = p.col AND a.epoch = e1 JOIN {_PX} b ON b."row" = p."row" AND b.col = p.col AND b.epoch = e2""")
def d24_correct_pairs(spark, sf_dir):
    x = _pix(spark, sf_dir)
    p = x.select("row", "col", F.col("epoch").alias("epoch1"), F.add_months("epoch", 1).alias("epoch2"), "pha")
    c = R.correct_pairs(p, x.select("row", "col", "epoch", (F.col("mag") / 1017).alias("value")))
    return _r(c.select("row", "col", F.col("epoch1").cast("string").alias("epoch1"), "pha"), "pha")


@query("""WITH a AS (SELECT "row", col, avg(coh) AS v FROM @pixels WHERE month(epoch) < 4 GROUP BY 1, 2), b AS (SELECT "row", col, avg(pha) AS v FROM @pixels WHERE month(epoch) > 8 GROUP BY 1, 2)
    SELECT coalesce(a."row", b."row") AS "row", coalesce(a.col, b.col) AS col, round(coalesce(nullif(a.v, 0), nullif(b.v, 0)), 6) AS v FROM a FULL JOIN b ON a."row" = b."row" AND a.col = b.col""")
def d30_priority_fill(spark, sf_dir):
    p = _pix(spark, sf_dir)
    a = p.filter(F.month("epoch") < 4).groupBy("row", "col").agg(R.exact_mean("coh").alias("v"))
    b = p.filter(F.month("epoch") > 8).groupBy("row", "col").agg(R.exact_mean("pha").alias("v"))
    return _r(R.fill_from(a, b, ["row", "col"], "v"), "v")


@query(f"""SELECT g."row", g.col, round((a.d * a.d + b.d * b.d) ** 0.5, 6) AS gradient FROM {_GRID} g
    JOIN (SELECT "row", col, (coalesce(lead(value) OVER w, value) - coalesce(lag(value) OVER w, value)) / CASE WHEN lead(value) OVER w IS NULL OR lag(value) OVER w IS NULL THEN 1.0 ELSE 2.0 END AS d FROM {_GRID} x WINDOW w AS (PARTITION BY col ORDER BY "row")) a ON a."row" = g."row" AND a.col = g.col
    JOIN (SELECT "row", col, (coalesce(lead(value) OVER w, value) - coalesce(lag(value) OVER w, value)) / CASE WHEN lead(value) OVER w IS NULL OR lag(value) OVER w IS NULL THEN 1.0 ELSE 2.0 END AS d FROM {_GRID} x WINDOW w AS (PARTITION BY frame, "row" ORDER BY col)) b ON b."row" = g."row" AND b.col = g.col""")
def f16_gradient(spark, sf_dir):
    return _r(R.gradient(_grid(spark, sf_dir), ["frame"], "value").select("row", "col", "gradient"), "gradient")


_W = "atan2(sin({0}), cos({0}))"


@query(f"""WITH g AS (SELECT frame, "row", col, value / 50.0 AS p FROM {_GRID} x), l AS (SELECT a."row", a.col, {_W.format('b.p - a.p')} + {_W.format('c.p - b.p')} + {_W.format('d.p - c.p')} + {_W.format('a.p - d.p')} AS s FROM g a JOIN g b ON b.frame = a.frame AND b."row" = a."row" AND b.col = a.col + 1 JOIN g c ON c.frame = a.frame AND c."row" = a."row" + 1 AND c.col = a.col + 1 JOIN g d ON d.frame = a.frame AND d."row" = a."row" + 1 AND d.col = a.col)
    SELECT "row", col, CAST(round(s / (2 * pi())) AS BIGINT) AS charge FROM l WHERE round(s / (2 * pi())) <> 0""")
def f17_residues(spark, sf_dir):
    g = _grid(spark, sf_dir).select("frame", "row", "col", (F.col("value") / 50.0).alias("p"))
    return R.residues(g, ["frame"], "p").drop("frame").withColumn("charge", F.col("charge").cast("long"))


def _around(agg: str, reach: str, h: int = 1) -> str:
    return f"""SELECT a."row", a.col, {agg} FROM {_GRID} a JOIN {_GRID} b ON b.frame = a.frame AND b."row" BETWEEN a."row" - {h} AND a."row" + {h} AND b.col BETWEEN a.col - {h} AND a.col + {h} {reach} GROUP BY 1, 2"""


@query(f"SELECT \"row\", col, round(sqrt(greatest(1 - (vc + vs), 0)), 6) AS coh FROM ({_around('var_pop(cos(b.value / 100.0)) AS vc, var_pop(sin(b.value / 100.0)) AS vs', '')})")
def f18_variance_coherence(spark, sf_dir):
    g = _grid(spark, sf_dir).select("frame", "row", "col", (F.col("value") / 100.0).alias("p"))
    return _r(R.phase_variance_coherence(g, ["frame"], "p", 3).select("row", "col", "coh"), "coh")


@query(_around("median(b.value) AS median, count(*) AS n", ""))
def f19_moving_median(spark, sf_dir):
    return R.moving(_grid(spark, sf_dir), ["frame"], "value", "median", 3).drop("frame")


@query(_around("median(b.value) AS median", "", 4))
def f19_block_median(spark, sf_dir):
    """A larger window over small blocks, so that most of them have all neighbours."""
    return R.moving(_grid(spark, sf_dir), ["frame"], "value", "median", 9, block=16).select("row", "col", "median")


@query(f"""WITH s AS (SELECT a."row", a.col, b.value AS v, CAST(floor(b.value / 40.0) AS BIGINT) AS k FROM {_GRID} a JOIN {_GRID} b ON b.frame = a.frame AND b."row" BETWEEN a."row" - 1 AND a."row" + 1 AND b.col BETWEEN a.col - 1 AND a.col + 1 AND abs(a."row" - b."row") + abs(a.col - b.col) <= 1), c AS (SELECT "row", col, k, count(*) AS n FROM s GROUP BY 1, 2, 3),
    t AS (SELECT "row", col, k FROM (SELECT *, row_number() OVER (PARTITION BY "row", col ORDER BY n DESC, k) AS z FROM c) WHERE z = 1) SELECT s."row", s.col, median(s.v) AS value FROM s JOIN t ON t."row" = s."row" AND t.col = s.col AND abs(s.k - t.k) <= 1 GROUP BY 1, 2""")
def f20_mode_median(spark, sf_dir):
    return R.mode_median(_grid(spark, sf_dir), ["frame"], "value", 1, 40.0).drop("frame")


@query(f"""SELECT a."row", a.col, round(sum(exp(-(pow(a."row" - b."row", 2) + pow(a.col - b.col, 2)) / 2) * b.value) / sum(exp(-(pow(a."row" - b."row", 2) + pow(a.col - b.col, 2)) / 2)), 6) + 0.0 AS smooth FROM {_GRID} a JOIN {_GRID} b ON b.frame = a.frame AND b."row" BETWEEN a."row" - 1 AND a."row" + 1 AND b.col BETWEEN a.col - 1 AND a.col + 1 WHERE a.value <> 0 AND b.value <> 0 GROUP BY 1, 2""")
def f21_gauss_smooth(spark, sf_dir):
    return _r(R.gauss_smooth(_grid(spark, sf_dir), ["frame"], "value", 1.0, 1).select("row", "col", "smooth"), "smooth")


@query(f"""WITH g AS (SELECT frame, "row", col, CASE WHEN value % 3 <> 0 THEN value END AS value FROM {_GRID} x), n AS (SELECT a."row", a.col, b.value, row_number() OVER (PARTITION BY a."row", a.col ORDER BY pow(a."row" - b."row", 2) + pow(a.col - b.col, 2), b."row", b.col) AS z FROM g a JOIN g b ON b.frame = a.frame AND b."row" BETWEEN a."row" - 5 AND a."row" + 5 AND b.col BETWEEN a.col - 5 AND a.col + 5 WHERE a.value IS NULL AND b.value IS NOT NULL) SELECT g."row", g.col, coalesce(g.value, n.value) AS value FROM g LEFT JOIN n ON n."row" = g."row" AND n.col = g.col AND n.z = 1""")
def f22_fill_nearest(spark, sf_dir):
    g = _grid(spark, sf_dir).withColumn("value", F.when(F.col("value") % 3 != 0, F.col("value")))
    return R.fill_nearest(g, ["frame"], "value").select("row", "col", "value")


@query(f"""WITH RECURSIVE g AS (SELECT "row", col FROM {_GRID} x WHERE value > 0), r AS (SELECT "row", col, "row" AS r2, col AS c2 FROM g UNION SELECT r."row", r.col, h."row", h.col FROM r JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) d(a, b) ON true JOIN g h ON h."row" = r.r2 + d.a AND h.col = r.c2 + d.b)
    SELECT "row", col, CAST(min(r2 * 64 + c2) // 64 AS BIGINT) AS label_row, CAST(min(r2 * 64 + c2) % 64 AS BIGINT) AS label_col, count(*) AS size FROM r GROUP BY 1, 2""")
def f23_islands(spark, sf_dir):
    """Islands of the whole grid: its two frames together."""
    g = _grid(spark, sf_dir).filter("value > 0").drop("frame")
    return R.islands(g, []).select("row", "col", F.col("label.row").alias("label_row"), F.col("label.col").alias("label_col"), "size")


@query(f"""SELECT g."row", g.col, g.value, round(c.m, 6) AS mean FROM {_GRID} g JOIN (SELECT "row" // 4 AS r, col // 4 AS k, avg(value) AS m FROM {_GRID} x GROUP BY 1, 2) c ON c.r = g."row" // 4 AND c.k = g.col // 4""")
def f24_resample(spark, sf_dir):
    g = _grid(spark, sf_dir)
    c = g.groupBy("frame", F.floor(F.col("row") / 4).alias("row"), F.floor(F.col("col") / 4).alias("col")).agg(F.avg("value").alias("mean"))
    return _r(R.resample(c, g, ["frame"], 4).select("row", "col", "value", "mean"), "mean")


_FILLED = """(SELECT frame, "row", col, CASE WHEN value % 3 <> 0 THEN value / 100.0 END AS p FROM {0} x)"""


@query(f"""WITH g AS {_FILLED.format(_GRID)}, s AS (SELECT a."row", a.col, atan2(sum(exp(-(pow(a."row" - b."row", 2) + pow(a.col - b.col, 2)) / 2) * sin(b.p)), sum(exp(-(pow(a."row" - b."row", 2) + pow(a.col - b.col, 2)) / 2) * cos(b.p))) AS p
    FROM g a JOIN g b ON b.frame = a.frame AND b."row" BETWEEN a."row" - 2 AND a."row" + 2 AND b.col BETWEEN a.col - 2 AND a.col + 2 WHERE a.p IS NULL AND b.p IS NOT NULL GROUP BY 1, 2) SELECT g."row", g.col, round(coalesce(g.p, s.p), 6) + 0.0 AS p FROM g LEFT JOIN s ON s."row" = g."row" AND s.col = g.col""")
def f22_fill_gauss(spark, sf_dir):
    g = _grid(spark, sf_dir).select("frame", "row", "col", F.when(F.col("value") % 3 != 0, F.col("value") / 100.0).alias("p"))
    return _r(R.fill_gauss(g, ["frame"], "p", 1.0, 2).select("row", "col", "p"), "p")


@query(f"""WITH g AS {_FILLED.format(_GRID)}, s AS (SELECT a."row", a.col, a.p, sum(exp(-(pow(a."row" - b."row", 2) + pow(a.col - b.col, 2)) / 2) * cos(b.p)) AS re, sum(exp(-(pow(a."row" - b."row", 2) + pow(a.col - b.col, 2)) / 2) * sin(b.p)) AS im, sum(exp(-(pow(a."row" - b."row", 2) + pow(a.col - b.col, 2)) / 2)) AS w
    FROM g a JOIN g b ON b.frame = a.frame AND b."row" BETWEEN a."row" - 2 AND a."row" + 2 AND b.col BETWEEN a.col - 2 AND a.col + 2 WHERE a.p IS NOT NULL AND b.p IS NOT NULL GROUP BY 1, 2, 3), t AS (SELECT "row", col, re / {_KERNEL} + (1 - w / {_KERNEL}) * cos(p) AS re, im / {_KERNEL} + (1 - w / {_KERNEL}) * sin(p) AS im FROM s)
    SELECT "row", col, round(atan2(im, re), 6) + 0.0 AS gauss_pha, round(sqrt(re * re + im * im), 6) AS gauss_coh FROM t""")
def f21_gauss_phase(spark, sf_dir):
    g = _grid(spark, sf_dir).select("frame", "row", "col", F.when(F.col("value") % 3 != 0, F.col("value") / 100.0).alias("p"))
    return _r(R.gauss_phase(g, ["frame"], "p", 1.0, 2).drop("frame"), "gauss_pha", "gauss_coh")


@query(f"""SELECT "row", col, median + CASE WHEN abs(value - median) < 50 THEN value - median ELSE 0 END AS filtered FROM (SELECT a."row", a.col, a.value, median(b.value) AS median FROM {_GRID} a JOIN {_GRID} b ON b.frame = a.frame AND b."row" BETWEEN a."row" - 1 AND a."row" + 1 AND b.col BETWEEN a.col - 1 AND a.col + 1 GROUP BY 1, 2, 3)""")
def f19_despiked(spark, sf_dir):
    return R.despiked(_grid(spark, sf_dir), ["frame"], "value", 3, 50.0).select("row", "col", "filtered")


@query(f"""WITH c AS (SELECT a."row", a.col, CAST(floor(b.value / 40.0) AS BIGINT) AS k, count(*) AS n FROM {_GRID} a JOIN {_GRID} b ON b.frame = a.frame AND b."row" BETWEEN a."row" - 1 AND a."row" + 1 AND b.col BETWEEN a.col - 1 AND a.col + 1 GROUP BY 1, 2, 3)
    SELECT "row", col, k AS mode FROM (SELECT *, row_number() OVER (PARTITION BY "row", col ORDER BY n DESC, k) AS z FROM c) WHERE z = 1""")
def f19_moving_mode(spark, sf_dir):
    g = _grid(spark, sf_dir).withColumn("value", F.floor(F.col("value") / 40.0))
    return R.moving(g, ["frame"], "value", "mode", 3).select("row", "col", F.col("mode").cast("long").alias("mode"))


@query(f"""WITH RECURSIVE g AS (SELECT frame, "row", col, value FROM {_GRID} x WHERE value > 0), r AS (SELECT frame, "row", col, "row" AS r2, col AS c2 FROM g UNION SELECT r.frame, r."row", r.col, h."row", h.col FROM r JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) d(a, b) ON true JOIN g h ON h.frame = r.frame AND h."row" = r.r2 + d.a AND h.col = r.c2 + d.b),
    n AS (SELECT "row", col, count(*) AS size FROM r GROUP BY 1, 2) SELECT x."row", x.col, CASE WHEN n.size >= 9 THEN x.value END AS value FROM {_GRID} x LEFT JOIN n ON n."row" = x."row" AND n.col = x.col""")
def f23_remove_islands(spark, sf_dir):
    g = _grid(spark, sf_dir).withColumn("value", F.when(F.col("value") > 0, F.col("value")))
    return R.remove_islands(g, ["frame"], "value", R.island_pixels(2_300)).select("row", "col", "value")


def _huber_sql(rows: str, key: str, rounds: int = 12) -> str:
    """Text of (key, slope, intercept) of rows (key, x, y): a subquery for each round of weights."""
    over = f"OVER (PARTITION BY {key})"
    t = f"(SELECT {key}, mx, my, x - mx AS x, y - my AS y, 1e0 AS w FROM (SELECT {key}, x, y, avg(x) {over} AS mx, avg(y) {over} AS my FROM {rows}))"
    for i in range(rounds):
        t = f"(SELECT *, sum(w) {over} AS s, sum(w * x) {over} AS sx, sum(w * y) {over} AS sy, sum(w * x * x) {over} AS xx, sum(w * x * y) {over} AS xy FROM {t})"
        t = f"(SELECT {key}, mx, my, x, y, s, sx, sy, CASE WHEN s * xx - sx * sx > 1e-12 * s * xx THEN (s * xy - sx * sy) / (s * xx - sx * sx) END AS slope FROM {t})"
        t = f"(SELECT *, (sy - slope * sx) / s AS c FROM {t})"
        if i + 1 < rounds:
            t = f"(SELECT *, abs(y - c - slope * x) AS r FROM {t})"
            t = f"(SELECT *, median(r) {over} / 0.6745 AS m FROM {t})"
            t = f"(SELECT {key}, mx, my, x, y, least(1e0, 1.345 * CASE WHEN m > 0 THEN m ELSE 1e0 END / greatest(r, 1e-12)) AS w FROM {t})"
    return f"(SELECT {key}, any_value(slope) AS slope, any_value(my + c - slope * mx) AS intercept FROM {t} GROUP BY {key})"


@query(f"""WITH p AS (SELECT *, CAST(epoch AS DATE) AS day, mag / 100 AS hgt, "row" // 10 AS br, col // 10 AS bc FROM @pixels), u AS (SELECT day, br, bc, hgt AS x, pha AS y FROM p WHERE hgt > 250 AND coh > 0.03),
    b AS (SELECT day, br, bc FROM u GROUP BY 1, 2, 3 HAVING abs(corr(x, y)) > 0.3 AND max(x) - min(x) >= 100), h AS {_huber_sql("u", "day, br, bc")},
    m AS (SELECT day, median(slope) AS s FROM b JOIN h USING (day, br, bc) GROUP BY 1),
    q AS (SELECT day, s, stddev_pop(pha) AS before, stddev_pop(atan2(sin(pha - s * hgt), cos(pha - s * hgt))) AS after FROM p JOIN m USING (day) GROUP BY 1, 2)
    SELECT CAST(day AS VARCHAR) AS epoch, round(s, 6) AS slope, round(before, 5) AS std_before, round(after, 5) AS std_after, abs(s) >= 0.001 AND after < before AS kept FROM q""")
def e24_height_correction(spark, sf_dir):
    p = _pix(spark, sf_dir).withColumn("hgt", F.col("mag") / 100)
    h = R.height_correction(p, ["epoch"], 10, min_height=250.0, min_coh=0.03, coh="coh").withColumn("epoch", F.col("epoch").cast("string"))
    return _r(_r(h, "slope"), "std_before", "std_after", digits=5)


_YEARS = range(1992, 1999)


def _mosaic_sql() -> str:
    """One step of the mosaic for each year."""
    steps = [f"""WITH s AS (SELECT year(epoch) AS place, "row", col, avg(pha) AS v FROM {_PX} p GROUP BY 1, 2, 3), m{_YEARS[0]} AS (SELECT "row", col, v, place FROM s WHERE place = {_YEARS[0]})"""]
    for y in _YEARS[1:]:
        steps.append(f"""d{y} AS (SELECT coalesce(median(m.v - s.v), 0) AS d FROM m{y - 1} m JOIN s ON s."row" = m."row" AND s.col = m.col AND s.place = {y}),
            m{y} AS (SELECT coalesce(s."row", m."row") AS "row", coalesce(s.col, m.col) AS col, coalesce(s.v + (SELECT d FROM d{y}), m.v) AS v, CASE WHEN s.v IS NULL THEN m.place ELSE {y} END AS place FROM (SELECT * FROM s WHERE place = {y}) s FULL JOIN m{y - 1} m ON s."row" = m."row" AND s.col = m.col)""")
    return ", ".join(steps) + f""" SELECT "row", col, round(v, 5) AS value, CAST(place AS BIGINT) AS place FROM m{_YEARS[-1]}"""


@query(_mosaic_sql())
def e21_mosaic(spark, sf_dir):
    s = _pix(spark, sf_dir).groupBy(F.year("epoch").cast("long").alias("place"), "row", "col").agg(F.avg("pha").alias("value"))
    return _r(R.grow_mosaic(s, list(_YEARS)).withColumn("place", F.col("place").cast("long")), "value", digits=5)


@query("""SELECT b.bid AS point, CAST(CAST(p.epoch AS DATE) AS VARCHAR) AS epoch, round(p.pha, 6) AS pha FROM @bursts b JOIN @pixels p ON p."row" = CAST(floor(b.bid / 50e0) AS BIGINT) AND p.col = b.bid % 25""")
def d28_point_series(spark, sf_dir):
    points = view(spark, sf_dir, "bursts").select(F.col("bid").alias("point"), F.floor(F.col("bid") / 50).alias("row"), (F.col("bid") % 25).alias("col"))
    return _r(R.point_series(_pix(spark, sf_dir), points).select("point", F.col("epoch").cast("string").alias("epoch"), "pha"), "pha")


# Least squares


@query(f"""WITH p AS (SELECT year(epoch) AS frame, "row", col, avg(pha) AS v FROM {_PX} x GROUP BY 1, 2, 3), m AS (SELECT frame, avg("row") AS mr, avg(col) AS mc, avg(v) AS mv FROM p GROUP BY 1),
    s AS (SELECT p.frame, mr, mc, mv, sum(("row" - mr) * ("row" - mr)) AS rr, sum((col - mc) * (col - mc)) AS cc, sum(("row" - mr) * (col - mc)) AS rc, sum(("row" - mr) * (v - mv)) AS rv, sum((col - mc) * (v - mv)) AS cv FROM p JOIN m ON m.frame = p.frame GROUP BY 1, 2, 3, 4)
    SELECT CAST(p.frame AS BIGINT) AS frame, "row", col, round(v - mv - (rv * cc - cv * rc) / (rr * cc - rc * rc) * ("row" - mr) - (cv * rr - rv * rc) / (rr * cc - rc * rc) * (col - mc), 5) + 0.0 AS deramped FROM p JOIN s ON s.frame = p.frame""")
def e25_deramp(spark, sf_dir):
    p = _pix(spark, sf_dir).groupBy(F.year("epoch").cast("long").alias("frame"), "row", "col").agg(F.avg("pha").alias("v"))
    return _r(L.deramp(p, ["frame"], "v").select("frame", "row", "col", "deramped"), "deramped", digits=5)


@query()
def e25_surface_deramp(spark, sf_dir):
    p = _pix(spark, sf_dir).groupBy(F.year("epoch").cast("long").alias("frame"), "row", "col").agg(F.avg("pha").alias("v"))
    return _r(L.surface_deramp(p, ["frame"], "v", 2, 40.0).select("frame", "row", "col", "deramped"), "deramped", digits=5)


@query()
def e25_cubic_deramp(spark, sf_dir):
    p = _pix(spark, sf_dir).groupBy(F.year("epoch").cast("long").alias("frame"), "row", "col").agg(F.avg("pha").alias("v"))
    return _r(L.surface_deramp(p, ["frame"], "v", 3, 40.0).select("frame", "row", "col", "deramped"), "deramped", digits=5)


@query("""WITH g AS (SELECT "row", col, vel, cos(radians(inc)) AS u, -sin(radians(inc)) * cos(radians(heading)) AS e FROM @look), s AS (SELECT "row", col, sum(u * u) AS a, sum(u * e) AS b, sum(e * e) AS c, sum(u * vel) AS p, sum(e * vel) AS q, count(*) AS n FROM g GROUP BY 1, 2)
    SELECT "row", col, CASE WHEN n >= 3 THEN round((p * c - q * b) / (a * c - b * b), 5) END AS up, CASE WHEN n >= 3 THEN round((q * a - p * b) / (a * c - b * b), 5) END AS east, CASE WHEN n >= 3 THEN round(sqrt(c / (a * c - b * b)), 5) END AS up_std, CASE WHEN n >= 3 THEN round(sqrt(a / (a * c - b * b)), 5) END AS east_std, n FROM s""")
def e26_up_east(spark, sf_dir):
    return _r(L.up_east(view(spark, sf_dir, "look"), ["row", "col"], 3), "up", "east", "up_std", "east_std", digits=5)


#: Normal equations of three unknowns, and their determinant.
_LOOK3 = """WITH g AS (SELECT "row", col, vel, cos(radians(inc)) AS u, -sin(radians(inc)) * cos(radians(heading)) AS e, sin(radians(inc)) * sin(radians(heading)) AS h FROM @look),
    s AS (SELECT "row", col, sum(u * u) AS a, sum(u * e) AS b, sum(u * h) AS c, sum(e * e) AS d, sum(e * h) AS f, sum(h * h) AS k, sum(u * vel) AS p, sum(e * vel) AS q, sum(h * vel) AS r, count(*) AS n FROM g GROUP BY 1, 2),
    t AS (SELECT *, a * (d * k - f * f) - b * (b * k - f * c) + c * (b * f - d * c) AS det FROM s)"""
_SOUND = "abs(det) > 1e-12 * a * d * k"


@query(_LOOK3 + f""" SELECT "row", col, CASE WHEN n >= 3 AND {_SOUND} THEN round((p * (d * k - f * f) - b * (q * k - f * r) + c * (q * f - d * r)) / det, 2) + 0.0 END AS up,
    CASE WHEN n >= 3 AND {_SOUND} THEN round((a * (q * k - f * r) - p * (b * k - f * c) + c * (b * r - q * c)) / det, 2) + 0.0 END AS east,
    CASE WHEN n >= 3 AND {_SOUND} THEN round((a * (d * r - q * f) - b * (b * r - q * c) + p * (b * f - d * c)) / det, 2) + 0.0 END AS north, n FROM t""")
def e26_up_east_north(spark, sf_dir):
    found = L.up_east_north(view(spark, sf_dir, "look"), ["row", "col"], 3)
    return _r(found.select("row", "col", "up", "east", "north", "n"), "up", "east", "north", digits=2)


@query(f"""WITH s AS (SELECT "row" % 4 AS frame, "row", col, epoch, pha FROM {_PX} x), y AS (SELECT year(epoch) AS yr FROM s GROUP BY 1 HAVING count(DISTINCT frame) = (SELECT count(DISTINCT frame) FROM s))
    SELECT "row", col, frame, CAST(year(epoch) AS BIGINT) AS "year", round(regr_slope(pha, (epoch - DATE '2000-01-01') / 365.25), 4) AS vel, count(pha) AS n FROM s WHERE year(epoch) IN (SELECT yr FROM y) GROUP BY 1, 2, 3, 4""")
def e27_annual_velocity(spark, sf_dir):
    p = _pix(spark, sf_dir).withColumn("frame", F.col("row") % 4)
    v = L.annual_velocity(p, ["row", "col"], "frame", "pha")
    return _r(v.select("row", "col", "frame", F.col("year").cast("long").alias("year"), "vel", "n"), "vel", digits=4)


@query(f"""WITH s AS (SELECT "row" % 4 AS frame, "row", col, epoch, pha FROM {_PX} x), y AS (SELECT year(epoch) AS yr FROM s GROUP BY 1 HAVING count(DISTINCT frame) = (SELECT count(DISTINCT frame) FROM s)),
    b AS (SELECT *, unnest(list_distinct([year(epoch - 45), year(epoch), year(epoch + 45)])) AS yr FROM s)
    SELECT "row", col, frame, CAST(yr AS BIGINT) AS "year", round(regr_slope(pha, (epoch - DATE '2000-01-01') / 365.25), 4) AS vel, count(pha) AS n FROM b WHERE yr IN (SELECT yr FROM y) GROUP BY 1, 2, 3, 4""")
def e27_buffered_velocity(spark, sf_dir):
    """A year's velocity from its own epochs and those of 45 days on both sides."""
    p = _pix(spark, sf_dir).withColumn("frame", F.col("row") % 4)
    v = L.annual_velocity(p, ["row", "col"], "frame", "pha", buffer_days=45)
    return _r(v.select("row", "col", "frame", F.col("year").cast("long").alias("year"), "vel", "n"), "vel", digits=4)


@query(f"""WITH p AS (SELECT "row", col, epoch, pha FROM {_PX} x), r AS (SELECT a."row", a.col, a.epoch AS e1, b.epoch AS e2 FROM p a JOIN p b ON b."row" = a."row" AND b.col = a.col AND b.epoch = CAST(a.epoch + INTERVAL 1 MONTH AS DATE)),
    e AS (SELECT "row", col, e1 AS epoch FROM r UNION SELECT "row", col, e2 FROM r), n AS (SELECT "row", col, count(*) AS pairs FROM r GROUP BY 1, 2), m AS (SELECT "row", col, count(*) AS epochs, min(epoch) AS first FROM e GROUP BY 1, 2)
    SELECT e."row", e.col, CAST(e.epoch AS VARCHAR) AS epoch, CASE WHEN epochs - 1 = pairs THEN round(p.pha - f.pha, 6) + 0.0 END AS value FROM e JOIN n ON n."row" = e."row" AND n.col = e.col JOIN m ON m."row" = e."row" AND m.col = e.col
    JOIN p ON p."row" = e."row" AND p.col = e.col AND p.epoch = e.epoch JOIN p f ON f."row" = e."row" AND f.col = e.col AND f.epoch = m.first""")
def e28_invert_network(spark, sf_dir):
    """Pairs of successive months: without a gap they tie all epochs, and the series is the phase itself less its first value."""
    p = _pix(spark, sf_dir).select("row", "col", F.col("epoch").alias("epoch1"), "pha")
    nxt = p.select("row", "col", F.add_months("epoch1", -1).alias("epoch1"), F.col("pha").alias("later"))
    pairs = p.join(nxt, ["row", "col", "epoch1"]).select("row", "col", "epoch1", F.add_months("epoch1", 1).alias("epoch2"), (F.col("later") - F.col("pha")).alias("value"))
    out = L.invert_network(pairs, ["row", "col"])
    return _r(out.select("row", "col", F.col("epoch").cast("string").alias("epoch"), "value"), "value")


@query(_LOOK3 + f""" SELECT "row", col, CASE WHEN {_SOUND} THEN round(sqrt((d * k - f * f) / det), 3) END AS up_dop, CASE WHEN {_SOUND} THEN round(sqrt((a * k - c * c) / det), 3) END AS east_dop,
    CASE WHEN {_SOUND} THEN round(sqrt((a * d - b * b) / det), 3) END AS north_dop, n FROM t""")
def e29_dilution(spark, sf_dir):
    return _r(L.dilution(view(spark, sf_dir, "look"), ["row", "col"]), "up_dop", "east_dop", "north_dop", digits=3)


@query()
def e30_seasonal(spark, sf_dir):
    p = _pix(spark, sf_dir)
    return _r(L.seasonal(p, ["row"], "pha"), "const", "rate", "sin", "cos", digits=4)


@query(f"""SELECT CAST(epoch AS VARCHAR) AS epoch, round(regr_slope(pha, mag / 1000), 6) AS slope, round(regr_intercept(pha, mag / 1000), 6) AS intercept FROM {_PX} p GROUP BY 1""")
def e33_electron_slope(spark, sf_dir):
    x = F.col("mag") / 1000
    s = _pix(spark, sf_dir).groupBy("epoch").agg(F.regr_slope("pha", x).alias("slope"), F.regr_intercept("pha", x).alias("intercept"))
    return _r(s.withColumn("epoch", F.col("epoch").cast("string")), "slope", "intercept")


@query(f"""WITH u AS (SELECT epoch, "row" // 10 AS block, mag / 1000 AS x, pha AS y FROM {_PX} p), h AS {_huber_sql("u", "epoch, block")}
    SELECT CAST(epoch AS VARCHAR) AS epoch, CAST(block AS BIGINT) AS block, round(slope, 4) + 0.0 AS slope, round(intercept, 4) + 0.0 AS intercept FROM h""")
def e24_huber_slope(spark, sf_dir):
    p = _pix(spark, sf_dir).select("epoch", F.floor(F.col("row") / 10).alias("block"), (F.col("mag") / 1000).alias("hgt"), "pha")
    return _r(L.huber_slope(p, ["epoch", "block"], "hgt", "pha").drop("n").withColumn("epoch", F.col("epoch").cast("string")), "slope", "intercept", digits=4)


@query(f"""WITH t AS (SELECT * FROM (VALUES ('a', DATE '1995-03-10', DATE '1996-08-20'), ('b', DATE '1996-01-01', DATE '1998-12-31')) v(period, start, stop))
    SELECT "row", period, round(regr_slope(pha, (epoch - DATE '2000-01-01') / 365.25), 4) AS vel, count(pha) AS n FROM {_PX} p JOIN t ON p.epoch BETWEEN t.start AND t.stop GROUP BY 1, 2""")
def e27_period_velocity(spark, sf_dir):
    t = spark.createDataFrame([("a", "1995-03-10", "1996-08-20"), ("b", "1996-01-01", "1998-12-31")], "period string, start string, stop string")
    t = t.select("period", F.to_date("start").alias("start"), F.to_date("stop").alias("stop"))
    v = L.period_velocity(_pix(spark, sf_dir), t, ["row"], "pha")
    return _r(v.select("row", "period", "vel", "n"), "vel", digits=4)
