"""The divergence audit against plain counting, in exact integers."""

import re
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("fringeline.llm")
from fringeline.llm import divergence  # noqa: E402

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def plain(rows, least, top):
    """rows (lang, source, text)."""
    lower = {c: c + 32 for c in range(65, 91)}
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(lower))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        have = Counter(t for _, _, words in own for t in set(words))
        keep = sorted(t for t, n in have.items() if n >= least)
        groups = {s: Counter(t for _, x, words in own if x == s for t in words if have[t] >= least) for s in {d[1] for d in own}}
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(keep))  # noqa: E731, B023
        whole = sum(groups.values(), Counter())
        for s, c in groups.items():
            pairs = [(o, sum(abs(share(c, t) - share(d, t)) for t in keep)) for o, d in groups.items() if o != s]
            terms = [(t, share(c, t) - share(whole, t)) for t in keep if c[t] and share(c, t) > share(whole, t)]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, n + 1) for n, (i, v) in enumerate(found[:limit])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, *r, "other") for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string, term string")


@pytest.mark.parametrize("cells", [1, 64, divergence.CELLS])
def test_against_plain(spark, cells):
    rnd = np.random.default_rng(4)
    words = ["Wald", "see", "\u00fcber", "\u6f22\u5b57", "\U0001f600", "a1b", "x-y", *[f"w{chr(97 + i)}" for i in range(26)]]
    rows = [(("en", "de", None, "")[i % 4], ("s1", "s2", "s3", None)[rnd.integers(4)], " ".join(rnd.choice(words, rnd.integers(0, 30)))) for i in range(400)]
    rows += [("en", "hot", "wald " * 3000)] * 40 + [("xx", "s1", "only here"), ("xx", "s2", ""), ("xx", None, None), ("yy", "alone", None), ("en", "bare", "123 !?")]
    found = divergence.audit(frame(spark, rows), 30, 5, cells)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == plain(rows, 30, 5)


def test_empty(spark):
    assert divergence.audit(frame(spark, [("en", "s", "x")]).limit(0)).count() == 0


def test_equal_subtrees_are_one_node():
    counts = np.zeros((3, 1024), np.int64)
    counts[1, 5] = 7
    trees = divergence.Trees(counts)
    assert [len(c) for c in trees.children] == [2] * 10  # all zeros, and the one that has the 7
    assert trees.roots[0] == trees.roots[2] != trees.roots[1]
    which, a, b, many = trees.pairs(np.array([0, 0]), np.array([1, 2]))
    assert sorted(zip(which.tolist(), trees.leaves[a].tolist(), trees.leaves[b].tolist(), many.tolist())) == [(0, 0, 0, 1023), (0, 0, 7, 1), (1, 0, 0, 1024)]


def test_large_counts_stay_exact():
    counts = np.array([-1, 0, 3 * 10**10, 10**11])
    n, v = 10**12, 7
    assert divergence.shares(counts, n, v).tolist() == [0, *[1 + 10**9 * (c + 5) // (n + 5 * v) for c in counts.tolist()[1:]]]
