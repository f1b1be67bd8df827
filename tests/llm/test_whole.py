"""Cases in which the document operators once did less than their whole job."""

import random

import pytest

pytest.importorskip("fringeline.llm")
from fringeline.llm import license_scan, simhash, toxicity  # noqa: E402
from fringeline.llm.common import written  # noqa: E402


@pytest.mark.parametrize("tile_rows", [2_000, 1])
def test_near_copies_by_five_word_similarity(spark, tile_rows):
    """Pairs at a similarity of 0.8 to 0.95, about ten bits apart, and pairs just below."""
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(150):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows.append((2 * i, " ".join(words)))
        for at in rng.sample(range(0, 200, 6), rng.randint(1, 6)):
            words[at] = "edited"
        rows.append((2 * i + 1, " ".join(words)))
        a, b = ({tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (r[1].split() for r in rows[-2:]))
        want[2 * i + 1] = len(a & b) / len(a | b)
    assert min(want.values()) < 0.78 and sum(0.8 <= j <= 0.95 for j in want.values()) > 50
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bands = written(df.select("doc_id", simhash.banded_udf("text").alias("s")).select("doc_id", "s.*"))
    sets = written(df.select(simhash.shingled_udf("text").alias("s")).select("s.*"))
    of = {r.fp: r.doc_id for r in bands.collect()}
    links = simhash.similar_links(bands, lambda wanted: sets.join(wanted, "fp", "left_semi"), tile_rows)
    found = {max(of[r.a], of[r.b]) for r in links.collect()}
    assert found == {d for d, j in want.items() if j >= 0.8}
    assert {d for d, in df.select("doc_id").collect()} - {r.doc_id for r in simhash.keep_one(df).collect()} == found


@pytest.mark.parametrize("tile_rows", [2_000, 1])
def test_near_copies_by_deletion_variants(spark, tile_rows):
    """Without any band, the stage finds all near copies whose fingerprints share a one-wildcard variant within its bits, and no other texts."""
    import xxhash
    from pyspark.sql import functions as F

    rng = random.Random(6)
    rows, prints, sets = [], {}, {}
    for i in range(120):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice((3, 60, 200)))]
        for k in range(3):
            rows.append((3 * i + k, " ".join(words)))
            words[rng.randrange(len(words))] = f"edit{i % 7}"
    for d, text in rows:
        w = text.split()
        sets[d] = {" ".join(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sets[d]]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    masks = [((1 << n) - 1) << a for a, n in ((0, 22), (22, 21), (43, 21))]
    want, similar = list(range(len(rows))), list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                similar = [similar[b] if g == similar[a] else g for g in similar]
                x = prints[a] ^ prints[b]
                if x.bit_count() <= 8 and any((x & m).bit_count() <= 1 for m in masks):
                    want = [want[b] if g == want[a] else g for g in want]
    assert len(set(want)) < len(rows) - 60
    df = spark.createDataFrame(rows, "doc_id long, text string")
    none = written(df.select("doc_id", simhash.banded_udf("text").alias("s")).select("doc_id", "s.*").withColumn("bands", F.expr("filter(bands, x -> false)")))
    shingles = written(df.select(simhash.shingled_udf("text").alias("s")).select("s.*").dropDuplicates(["fp"]))
    of = {}
    for r in none.collect():
        of.setdefault(r.fp, []).append(r.doc_id)
    got = list(range(len(rows)))
    same = [(d, ids[0]) for ids in of.values() for d in ids]
    links = simhash.similar_links(none, lambda wanted: shingles.join(wanted, "fp", "left_semi"), tile_rows)
    for a, b in same + [(of[r.a][0], of[r.b][0]) for r in links.collect()]:
        got = [got[b] if g == got[a] else g for g in got]
    # texts of a cluster are all compared, so more of the similar ones may come together
    assert all(got[a] == got[want[a]] and similar[a] == similar[got[a]] for a in range(len(rows)))


def test_license_occurrences_beside_a_better_one():
    text = "mozila public license mozilla public license mozilla publik licence and mozilla public license"
    found = [(m["start"], m["end"], m["edits"]) for m in license_scan.scan(text)[-1] if m["label"] == "mpl"]
    assert found == [(0, 21, 1), (22, 44, 0), (45, 67, 2), (72, 94, 0)]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def plain_notices(text):
    """(label, first word, end word, edits): every stretch of words within the edits of a notice, by the rules of the scan."""
    words, out = text.split(), []
    for notice, label, errors, exact in license_scan.NOTICES:
        own, taken = [], []
        for i in range(len(words)):
            for j in range(i + 1, min(len(words), i + len(notice.split()) + errors) + 1):
                stretch = " ".join(words[i:j])
                if abs(len(stretch) - len(notice)) <= errors and (n := edits(stretch, notice)) <= errors and (not exact or exact in words[i:j]):
                    own.append((n, i, j))
        for n, i, j in sorted(own):
            if all(j <= a or b <= i for a, b in taken):
                taken.append((i, j))
                out.append((i, -j, n, label))
    kept = []
    for i, j, n, label in sorted(out):
        if all(-j > b for _, _, b, _ in kept):
            kept.append((label, i, -j, n))
    return sorted(kept)


def test_license_spans_as_by_brute_force():
    rng = random.Random(8)
    notices = [n for n, *_ in license_scan.NOTICES]
    for _ in range(150):
        words = []
        while len(words) < 40:
            text = rng.choice(notices) if rng.random() < 0.6 else "some words between"
            for _ in range(rng.choice((0, 0, 1, 2))):
                at = rng.randrange(len(text))
                text = text[:at] + rng.choice(("", "z", text[at] + "z")) + text[at + 1 :]
            words += text.split()
        text = " ".join(words)
        assert sorted((m["label"], m["first_word"], m["end_word"], m["edits"]) for m in license_scan.scan(text)[-1]) == plain_notices(text), text


@pytest.mark.parametrize(
    "text, labels",
    [
        ("apache license version 1.1", "apache-1"), ("under the mpl license", ""), ("creative commons attribution noncommercial", "cc-by-nc"), ("Creative Commons Attribution-ShareAlike", "cc-by-sa"),
        ("gnu lesser general public license", "lgpl"), ("under teh MIT license; under the MIT license", "mit"), ("cc by nc", "cc-by-nc"),
    ],
)
def test_license_names_are_told_apart(text, labels):
    assert license_scan.scan(text)[5] == labels


def test_long_texts_take_time_in_proportion():
    import time

    began = time.perf_counter()
    assert license_scan.scan("cc by nc " * 300_000)[1:4] == (300_000, 0, 899_997)
    assert len(license_scan.scan("gnu general public licence and " * 30_000)[-1]) == 30_000
    assert time.perf_counter() - began < 30


def test_toxic_passage_scores_alike_wherever_it_stands():
    import numpy as np

    logit = np.zeros(toxicity.BUCKETS, np.float32)
    for b in {b for w in (b"utter", b"blockhead", b"dolt") for b in toxicity.subwords(w)}:
        logit[b] = 40
    scorer = toxicity.Scorer(logit, -4.0)
    alone = scorer.score(b"utter blockhead dolt")
    texts = [" ".join(["0"] * k + ["utter", "blockhead", "dolt"] + ["0"] * (60 - k)).encode() for k in range(61)]
    scores = [scorer.score(t) for t in texts]
    assert max(scores) - min(scores) < 1e-9 and 0.5 < max(scores) <= alone


def test_rolling_windows_are_of_distinct_words():
    import numpy as np

    rng = random.Random(7)
    scorer = toxicity.Scorer(np.random.default_rng(1).normal(0, 1, toxicity.BUCKETS), 0.1)
    for n in (1, 5, 23, 24, 25, 80):
        words = [rng.choice("abcdefghijklmnop").encode() * 3 for _ in range(n)]
        got = scorer.score(b" ".join(words))
        best = max(sum(scorer.kept[w] for w in set(words[i : i + 24])) for i in range(max(1, n - 23))) / min(24, n)
        assert abs(got - 1 / (1 + np.exp(-0.1 - best))) < 1e-9


def test_long_rows_do_not_use_up_the_training_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "SAMPLE", 5)
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: seen.append((len(texts), sum(labels))))
    rows = [(i, ("long " * 4000 if i % 4 else "short") + str(i), i % 2 if i % 4 else i // 4 % 2) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    toxicity.fit(docs.drop("toxic"), docs.drop("text"))
    assert seen == [(10, 5)]
