"""Cases in which queries once did less than their whole job."""

import pytest
from pyspark.sql import functions as F

from fringeline import plans
from fringeline.operators import raster as R

GRID = ["f16_gradient", "f17_residues", "f18_variance_coherence", "f19_moving_median", "f19_block_median", "f20_mode_median", "f21_gauss_smooth", "f22_fill_nearest", "f23_islands", "f24_resample"]


@pytest.fixture(scope="module")
def tall(spark, tmp_path_factory):
    """Embeddings whose ids go beyond 500."""
    path = tmp_path_factory.mktemp("tall")
    values = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: (F.pmod(F.xxhash64("vec_id", i), F.lit(200)) - 100).cast("double") / 100)
    spark.range(480, 560).select(F.col("id").alias("vec_id"), values.alias("embedding")).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


@pytest.mark.parametrize("name", GRID)
def test_grid_queries_read_every_row(spark, tall, name):
    rows = plans.QUERIES[name](spark, tall).select("row").distinct().count()
    assert rows == 80 or name == "f17_residues" and rows > 20  # only rows with a residue; 20 lie below 500


def test_moving_median_beyond_the_first_rows(spark, tall):
    grid = {(r.vec_id, i): round(v * 1000) for r in spark.read.parquet(f"{tall}/embeddings.parquet").collect() for i, v in enumerate(r.embedding)}
    for r in plans.QUERIES["f19_moving_median"](spark, tall).collect():
        near = sorted(grid[k] for i in (-1, 0, 1) for j in (-1, 0, 1) if (k := (r.row + i, r.col + j)) in grid)
        assert r.n == len(near) and r.median == (near[len(near) // 2] + near[(len(near) - 1) // 2]) / 2


def test_wide_holes_are_filled_by_the_nearest(spark):
    ok = {(0, 0): 1, (0, 11): 2, (9, 4): 3}
    cells = [("f", r, c, ok.get((r, c))) for r in range(10) for c in range(12)] + [("empty", 0, 0, None)]
    out = R.fill_nearest(spark.createDataFrame(cells, "frame string, row long, col long, value long"), ["frame"], "value").collect()
    assert len(out) == len(cells)
    for r in out:
        want = min((((r.row - a) ** 2 + (r.col - b) ** 2, a, b), v) for (a, b), v in ok.items())[1]
        assert r.value == (want if r.frame == "f" else None)


def test_islands_cross_the_middle_of_the_grid(spark, tmp_path):
    """A bar over all 64 columns is one island; a pixel right of the middle belongs to the island left of it."""
    rows = [(0, [0.5] * 64), (1, [-0.5] * 64), (2, [0.5 if c in (31, 32) else -0.5 for c in range(64)]), (3, [-0.5] * 64), (4, [0.5 if c in (30, 40) else -0.5 for c in range(64)])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r.row, r.col): (r.label_row, r.label_col, r.size) for r in plans.QUERIES["f23_islands"](spark, str(tmp_path)).collect()}
    assert got == {(0, c): (0, 0, 64) for c in range(64)} | {(2, 31): (2, 31, 2), (2, 32): (2, 31, 2), (4, 30): (4, 30, 1), (4, 40): (4, 40, 1)}


def test_means_do_not_depend_on_the_order_of_rows(spark):
    """0.4703125 exactly, which sums of doubles reach in some orders only; thirds, whose digits end."""
    values = [1.0, 0.3, 0.6, 0.6, 0.0, 0.275, 0.6, 0.65, 0.7, 1.0, 0.35, 0.1, 0.55, 0.0, 0.5, 0.3]
    orders = [sorted(values), sorted(values, reverse=True), values, values[::-1], *[values[i:] + values[:i] for i in range(1, 16)]]
    rows = [(k, v) for k, order in enumerate(orders) for v in order] + [(-1, v) for v in (1 / 3, 2 / 3, 2 / 3, 1 / 3)] + [(-2, None)]
    df = spark.createDataFrame(rows, "k long, v double").coalesce(1)
    got = dict(df.groupBy("k").agg(F.round(R.exact_mean("v"), 6)).collect())
    assert got == {k: 0.470313 for k in range(len(orders))} | {-1: 0.5, -2: None}
    assert len({r[1] for r in df.filter("k >= 0").groupBy("k").agg(F.round(F.avg("v"), 6)).collect()}) == 2


def test_priority_fill_rounds_exact_means(spark):
    """Against fractions of the items' own integers."""
    import duckdb
    from fractions import Fraction

    rows = duckdb.sql("""SELECT l_partkey // 50, l_suppkey % 25, date_trunc('month', l_shipdate), sum(CAST(round(l_discount * 100) AS BIGINT)), sum(CAST(round(l_quantity) AS BIGINT)), count(*)
        FROM '/root/testdata/sf0.01/lineitem.parquet' GROUP BY 1, 2, 3""").fetchall()
    spring, autumn = {}, {}
    for row, col, month, discount, quantity, n in rows:
        spring.setdefault((row, col), []).extend([Fraction(int(discount), 10 * n)] if month.month < 4 else [])
        autumn.setdefault((row, col), []).extend([Fraction(int(quantity), n)] if month.month > 8 else [])
    want = {}
    for k in spring:
        if spring[k] or autumn[k]:
            a, b = (sum(x) / len(x) if x else 0 for x in (spring[k], autumn[k]))
            v = a or b
            want[k] = float(Fraction((v * 10**6 + Fraction(1, 2)).__floor__(), 10**6)) if v else None
    got = {(r.row, r.col): r.v for r in plans.QUERIES["d30_priority_fill"](spark, "/root/testdata/sf0.01").collect()}
    assert got == want
