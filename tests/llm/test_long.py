"""Very long texts of one thing: time and rows follow the length."""

import time

import pytest

pytest.importorskip("fringeline.llm")
from pyspark.sql import functions as F  # noqa: E402

from fringeline.llm import decontaminate, pii  # noqa: E402
from tests.llm import brute  # noqa: E402


def one(spark, unit, n, key="doc_id"):
    return spark.createDataFrame([(1,)], f"{key} long").select(key, F.repeat(F.lit(unit), n).alias("text"))


@pytest.mark.parametrize("unit, valid", [("12, ", 0), ("a@b.cc ", 1), ("+49 30 1234567, ", 1)])
def test_spans_of_many_matches(spark, unit, valid):
    def took(n):
        began = time.perf_counter()
        found = one(spark, unit, n).select(F.size(pii.spans_of(F.col("text"))).alias("n")).first().n
        assert found == valid * n
        return time.perf_counter() - began

    took(100)
    # ten times the text: far below a hundred times the time
    assert took(100_000) < 30 * max(1.0, took(10_000))


def test_long_and_short_scans_agree(spark):
    text = "x 10.0.0.1 a@b.cc +4930123456789 4111 1111 1111 1111; " * 300
    counts, digest, _ = brute.pii(text)
    row = pii.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert ([row.n_email, row.n_ip, row.n_card, row.n_phone], row.base_sha256) == (counts, digest)
    said = pii.sanitised(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
    assert said.count("[EMAIL]") == 300 and said.count("[IP]") == 300 and "a@b.cc" not in said


def test_one_word_many_times(spark):
    """A document and an item of one word: the item has one window to search for, and every place is found."""
    doc, item = one(spark, "la ", 300_000), one(spark, "la ", 1000, "item_id")
    began = time.perf_counter()
    r = decontaminate.report(doc, item).first()
    assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (300_000, 300_000, 1, True)
    assert time.perf_counter() - began < 90


def test_repeating_items_against_plain(spark):
    docs = [(1, "la " * 50 + "lo " + "la " * 9), (2, "a b " * 30), (3, "b a " * 4), (4, "x " + "a b " * 6 + "a"), (5, None)]
    items = [("r", "la " * 30), ("s", "a b " * 20), ("t", "b a " * 5), ("u", "la " * 9)]
    got = decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")).drop("n_near")
    assert sorted(map(tuple, got.collect())) == brute.decontaminate(docs, items)
