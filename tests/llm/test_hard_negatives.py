"""Hard negatives against all scores."""

import math

import numpy as np
import pytest

pytest.importorskip("fringeline.llm")
from fringeline.llm import hard_negatives  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int, search string, v int"


def plain(rows, every=100, positives=5, negatives=5, percent=80):
    took = {(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, label in rows if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)}
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, label, v in took:
        if a % every:
            continue
        others = sorted((-score(v, w), i, m) for i, m, w in took if i != a)
        for ps, p in [(-s, i) for s, i, m in others if m == label][:positives]:
            fits = [(-s, i) for s, i, m in others if m != label and percent * ps <= 100 * -s <= 100 * ps][:negatives]
            out += [(a, p, k + 1, i, ps, s) for k, (s, i) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **how):
    return sorted(map(tuple, hard_negatives.mine(spark.createDataFrame([(i, v, m, "x", 0) for i, v, m in rows], SCHEMA), **how).collect()))


@pytest.mark.parametrize("blocks", [(50, 3), (hard_negatives.ROW_BLOCK, hard_negatives.ANCHOR_BLOCK)])
def test_against_all_scores(spark, blocks):
    rnd = np.random.default_rng(8)
    rows = [(i, (rnd.normal(size=20) + (i % 4 == 0) * 2).tolist(), int(rnd.integers(3))) for i in range(700)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(120)] + [(2000 + i, rows[3][1], 2) for i in range(120)]  # copies, anchors among them
    rows += [rows[5], rows[100], (300, None, 1), (301, rows[7][1], None), (None, rows[7][1], 1), (400, [*rows[1][1][:19], None], 1), (500, [math.nan] * 20, 1), (600, [math.inf] * 20, 0)]
    rows += [(5000, [], 1), (5001, [0.0] * 20, 2), (5002, [0.5] * 7, 2), (5100, [1.0] * 20, 9), (5200, [1e5] * 20, 0), (5203, [1e5] * 20, 1), (5204, [9e4] * 20, 0)]
    assert mined(spark, rows, row_block=blocks[0], anchor_block=blocks[1]) == plain(rows)


def test_few_and_none(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 1.5], 1), (2, [1.0, 1.5], 2), (3, [-1.0, -1.0], 1)]
    assert mined(spark, rows) == plain(rows) == [(0, 1, 1, 2, 262144, 262144)]
    assert mined(spark, rows[:1]) == [] and mined(spark, rows[1:]) == [] and mined(spark, []) == []


def test_bounds_hold_and_prune():
    """Summaries bound every score; on vectors that differ in their segments' means they leave few pairs."""
    rnd = np.random.default_rng(9)
    x = np.floor(256 * (rnd.normal(size=(300, 64)) * 0.05 + np.repeat(rnd.normal(size=(300, 16)), 4, axis=1)))
    score = x @ x.T
    for s in hard_negatives.LEVELS:
        mean, dev = hard_negatives.summaries(x, s)
        slack = hard_negatives.SLACK * (x**2).sum(axis=1).max() + 1
        assert (np.abs(score - mean @ mean.T) <= dev @ dev.T + slack).all()
    best = np.sort(score, axis=1)[:, -6]
    assert (mean @ mean.T + dev @ dev.T + slack >= best[:, None]).mean() < 0.05
