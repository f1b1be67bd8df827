"""Nulls, empty and long texts, ties, repeated rows, empty tables and extra columns."""

import pytest
from pyspark.sql import functions as F

from tests.llm import brute

pytest.importorskip("fringeline.llm")
from fringeline.llm import chat, decontaminate, exact_dedup, license_scan, mixing, pii, sharding, simhash, token_count, toxicity  # noqa: E402

LONG = "the quick brown fox " * 5000 + "mail bob@example.com now"
ROWS = [
    (1, "a b c d e f g h", "en", "s1", 15), (2, None, None, None, None), (3, "", "en", "s1", 0), (4, "a b c d e f g h", "en", None, 15), (4, "a b c d e f g h", "en", None, 15),
    (5, LONG, "en", "s2", 9), (6, "  \n\t ", "en", "s2", 5), (None, "no id here 10.1.2.3", "en", "s1", 3), (7, "ärger Ünder the MIT license + cc BY nc", "de", "s3", 1), (8, "+44 20 7946 0958 and 4111 1111 1111 1111", "en", "s1", 2),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({"d": F.lit(1), "print": F.lit("x"), "shard": F.lit(9), "Digest": F.lit("y"), "size": F.lit(3), "key": F.lit(0)})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=lambda x: (x is None, x))


ALL = sorted((r[0] for r in ROWS), key=lambda x: (x is None, x))


def test_simhash(spark, docs, empty):
    out = simhash.near_duplicates(docs)
    assert ids(out) == ALL
    got = {r.doc_id: r for r in out.collect()}
    assert got[2].fp == got[3].fp == got[6].fp == 0 and got[3].component_id == got[6].component_id == 2
    assert got[4].component_id == 1
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and ids(kept) == [1, 2, 5, 7, 8, None]
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_simhash_large_buckets_are_tiled(spark):
    import random

    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = {b for b in base} | {b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 5))) for b in base for _ in range(12)}
    prints |= {(base[0] & ((1 << 22) - 1)) | (rng.getrandbits(42) << 22) for _ in range(300)}  # one hot segment value
    df = spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long")
    want, parent = set(), {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted(prints)
    for i, a in enumerate(order):
        for b in order[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    groups = {}
    for p in prints:
        groups.setdefault(root(p), set()).add(p)
    want = {frozenset(g) for g in groups.values() if len(g) > 1}
    for rows in (100_000, 64):
        found = {}
        for r in simhash.components(simhash.links(df, rows)).collect():
            found.setdefault(r.root, {r.root % 2**64}).add(r.node % 2**64)
        assert {frozenset(g) for g in found.values()} == want


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    out = {r.node: r.root for r in simhash.components(edges).collect()}
    assert out == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_pii(spark, docs, empty):
    out = pii.report(docs)
    assert ids(out) == ALL and pii.report(empty).count() == 0
    for r in out.collect():
        counts, digest, _ = brute.pii({x[0]: x[1] for x in ROWS}[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == digest
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    # in these few texts "and" stands beside the two numbers only, so it tells of them
    assert clean[8] == "[PHONE]  [CARD]" and clean[2] is None and clean[1] == "a b c d e f g h" and "bob@" not in clean[5]
    assert pii.sanitised(docs).columns == docs.columns
    clash = docs.withColumns({"p": F.lit(4), "row": F.lit(5), "spans": F.lit(6), "terms": F.lit(7), "__new": F.lit("n")})
    assert {(r.p, r.row, r.spans, r.terms, r["__new"]) for r in pii.sanitised(clash).collect()} == {(4, 5, 6, 7, "n")}


def test_pii_classes(spark):
    """A term that is nearly as telling as a name is replaced by a class of terms with its prefix; long words, gaps and borders keep their places."""
    rows = [(0, "Waldheim wrote from me@x.org"), (1, "Waldheim is a village"), *((i, f"{w} {i % 9} and more") for i, w in enumerate(["waldrand", "waldweg", "waldsee", "waldhaus"] * 12, 2))]
    rows += [(100, "ab" * 128 + "q" * 700 + " Zerbel 😀 Zerbel"), (101, "x" * 250 + " Zerbel z@x.org" + " and more" * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.pii_terms(rows[:-2] + [(100, "ab" * 128 + "q" * 512 + "1" * 188 + rows[-2][1][956:]), rows[-1]])
    found = {r.d: r for r in pii.found_spans(df).collect()}
    assert {d: [(t.start, t.end, t.put) for t in r.terms] for d, r in found.items() if r.terms} == {d: t for d, t in want.items() if t}
    clean = {r.doc_id: r.text for r in pii.sanitised(df).collect()}
    for d, text in rows:
        cuts = sorted([(a, b, put) for a, b, put in want[d]] + [(a, b, f"[{k.upper()}]") for k, a, b in brute.pii(text)[2]], reverse=True)
        for a, b, put in cuts:
            text = text[:a] + put + text[b:]
        assert clean[d] == text
    assert any(put.endswith("*") for t in want.values() for *_, put in t)


def test_pii_patterns_agree_with_the_plain_ones(spark):
    texts = ["x@y.z@a.b", "a@b.c.d_e@f.g", "..@..a@b.c", "1.2.3.4.5.6.7.8", "256.1.1.1 01.02.003.0004 0.0.0.0", "1 2-3 4", "+1 (2) 3.4-5+6 7 8 9 0 1 2 3 4 5", "4111-1111-1111-1111 4111111111111112", "ü 😀 a@b.co 😀 +49 30 1234567", "a" * 30000 + "@", "1" * 30000, "1." * 5000, "+1" + " " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in df.select("doc_id", pii.spans_of(F.col("text")).alias("s")).collect():
        assert [(s.kind, s.start, s.end) for s in r.s] == brute.pii(texts[r.doc_id])[2], texts[r.doc_id][:60]


def test_pii_terms_that_disclose(spark):
    """A name that always stands by one address discloses it; common words don't."""
    rows = [(i, f"word{i % 7} contact Zorblax at zorblax@mail.org about item number {i}") for i in range(6)] + [(100 + i, f"please contact us about item number {i} word{i % 7}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in pii.report(df).collect()}
    at = rows[0][1].index("Zorblax")
    assert f"term:{at}:{at + 7}" in out[0].spans.split(",") and out[0].n_email == 1 and out[100].spans == ""
    assert "contact" in {r.doc_id: r.text for r in pii.sanitised(df).collect()}[0] and "Zorblax" not in {r.doc_id: r.text for r in pii.sanitised(df).collect()}[0]


def long_runs():
    import random

    rng = random.Random(2)
    return [" " * 30_001, "=" * 20_000, "a " * 5_000, "ab" * 9_999 + "  " * 700, *("".join(rng.choice(" a-=\t") * rng.randint(1, 90) for _ in range(200)) for _ in range(5)), *("".join(rng.choice("aeinrst ") for _ in range(3000)) for _ in range(5))]


def test_runs_take_time_in_proportion():
    import time

    import public_tokenizers

    m = token_count.RankMerger(public_tokenizers.path("piece_bpe_32k.model"))
    began = time.perf_counter()
    m.count_texts([" " * 1_000_000, "- " * 300_000, "=" * 500_000])
    assert time.perf_counter() - began < 30


def test_token_counts(spark, docs, empty):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", " ", "a  b", "   ", " " * 200, "x" + " " * 37 + "y", "the the", "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "日本語のテキスト" * 40, "<s></s><unk><0x41>", "▁▁x▁", "é́​\x00\t\n", "ab" * 900, "https://a.b/c?d=e&f=" + "q1w2" * 300, "…" * 50, "mañana über straße" * 3, LONG, *long_runs()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.n_tokens for r in token_count.token_counts(df, path).orderBy("doc_id").collect()] == [len(sp.encode(t)) for t in texts]
    assert ids(token_count.token_counts(docs, path)) == ALL and token_count.token_counts(empty, path).count() == 0


def test_decontaminate(spark, docs, empty):
    bench = [("b1", "x y a b c d e f g h i j k"), ("b2", "no id here"), ("b3", None), ("b4", ""), ("b5", "g h"), (None, "quick brown fox the"), ("b2", "no id here")]
    b = spark.createDataFrame(bench, "item_id string, text string")
    out = decontaminate.report(docs, b)
    assert ids(out) == ALL
    texts = {r[0]: r[1] for r in ROWS}
    want = {d: w for d, *w in brute.decontaminate_any(list(texts.items()), [(i or "", t) for i, t in bench])}
    for r in out.collect():
        assert [r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated] == want[r.doc_id], r
    assert decontaminate.report(empty, b).count() == 0 and decontaminate.report(docs, b.filter("false")).filter("contaminated").count() == 0
    assert decontaminate.clean(docs, b).columns == docs.columns
    small = decontaminate.matches(docs, b, block_bytes=40).filter("exact")  # many blocks
    assert sorted(map(str, small.collect())) == sorted(map(str, decontaminate.matches(docs, b).filter("exact").collect()))


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    d = spark.createDataFrame([(1, item), (2, item.replace("delta", "delta filler words")), (3, "alpha kappa")], "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {(r.doc_id, r.exact) for r in decontaminate.matches(d, b).collect()} == {(1, True), (2, False)}


def test_mixing(spark, docs, empty):
    rows = mixing.report(docs).collect()
    assert sorted((r.doc_id for r in rows), key=lambda x: (x is None, x)) == ALL and all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)
    assert mixing.report(empty).count() == 0 and mixing.mixed(empty).count() == 0
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and sum(r["size"] * 0 + 1 for r in out.filter("doc_id = 3").collect()) == 1
    same = spark.createDataFrame([(i, "one two three", "hot") for i in range(3000)] + [(9000 + i, "w " * (i % 50 + 1), "cold") for i in range(500)], "doc_id long, text string, source string")
    r = mixing.report(same).groupBy("source_size").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(x.taken - x.target) <= 5 for x in r), r


def test_mixing_of_repeated_rows(spark):
    """Rows without an id, or with the same one, are taken like others; so are repeated rows, one part of which the cut takes."""
    for same in (False, True):
        rows = [(None, "one two three" if same else f"one two w{i}", "a") for i in range(1000)] + [(7, f"w{0 if same else i} b", "b") for i in range(1000)]
        rows += [(i, "x y z", "c") for i in range(500)]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
        got = mixing.report(df).groupBy("source_size").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max(F.col("taken") / F.col("size")).alias("most")).collect()
        assert len(got) == 3 and all(abs(r.taken - r.target) <= 3 and r.most <= 2 for r in got), got
        mixed = mixing.mixed(df).groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("words")).collect()
        assert sorted(r.words for r in mixed) == sorted(r.taken for r in got)
    extra = df.withColumns({"size": F.lit("s"), "h": F.lit("t"), "row": F.lit("u"), "__size": F.lit("v")})
    assert {tuple(r) for r in mixing.mixed(extra).select("size", "h", "row", "__size").collect()} == {("s", "t", "u", "v")}


def test_fit_of_long_documents():
    import numpy as np

    for lengths, counts, budget, off in [([100_000, 100_001, 100_002], [1, 1, 1], 150_000, 50_000), ([70_000], [5], 50_000, 20_000), ([300_000, 7], [3, 1], 500_000, 100_010), ([200_000, 210_001], [9, 9], 1_230_000, 20_000)]:
        take = mixing.fit(np.array(lengths), np.array(counts), budget)
        assert (take <= counts).all() and abs(int((np.array(lengths) * take).sum()) - budget) <= off


def test_hot_class_is_cut_exactly(spark):
    rows = spark.range(60_000).select(F.lit("s").alias("source"), F.lit(10).cast("long").alias("size"), mixing._order_hash(F.col("id"), F.lit("")).alias("h"))
    more = spark.range(20_000).select(F.lit("t").alias("source"), F.lit(7).cast("long").alias("size"), mixing._order_hash(F.col("id"), F.lit("")).alias("h"))
    both = rows.unionByName(more)
    t = mixing.class_table(both)
    got = both.join(t, ["source", "size"]).groupBy("source", "target").agg(F.sum(F.col("size") * (F.col("whole") + (F.col("h") <= F.col("cut")).cast("int") * (F.col("whole") < 2).cast("int"))).alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 10 for r in got), got


def test_sharding(spark, docs, empty):
    out = sharding.report(docs)
    assert ids(out) == ALL and sharding.report(empty).count() == 0
    big = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 3).alias("text"))
    rows = sharding.report(big).groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.count_distinct("slot").alias("k")).collect()
    assert len(rows) == 24 and all((r.n, r.lo, r.hi, r.k) == (1250, 0, 1249, 1250) for r in rows)
    placed = sharding.sharded(docs)
    assert placed.columns == [*docs.columns, "shard_new", "slot"] and ids(placed) == ALL
    assert placed.select("shard_new", "slot").distinct().count() == len(ROWS)


def test_hypergeometric_draws(spark):
    """Moments of the drawn counts against the distribution's."""
    n, total, good, drawn = 4000, 500, 60, 200
    u = (F.col("id") + 0.5) / n
    k = spark.range(n).select(sharding.hypergeometric(u, F.lit(total).cast("long"), F.lit(good).cast("long"), F.lit(drawn).cast("long")).alias("k"))
    mean, var = k.agg(F.avg("k"), F.var_pop("k")).first()
    p = good / total
    assert abs(mean - drawn * p) < 0.02 and abs(var - drawn * p * (1 - p) * (total - drawn) / (total - 1)) < 0.1


def test_communication_matrix_keeps_both_margins(spark):
    blocks = spark.createDataFrame([(i, 100 + 37 * i % 50) for i in range(8)], "block long, n long")
    n = sum(100 + 37 * i % 50 for i in range(8))
    sizes = [n // 5 + (j < n % 5) for j in range(5)]
    rows = {r.block: list(r.places) for r in sharding.communication_matrix(blocks, 3, sizes).collect()}
    assert {b: sum(p) for b, p in rows.items()} == {i: 100 + 37 * i % 50 for i in range(8)}
    assert [sum(p[j] for p in rows.values()) for j in range(5)] == sizes and min(min(p) for p in rows.values()) >= 0


def test_chat(spark):
    odd = [r"<turn x>", r"<\turn", "</turn>\n", r"<\\/turn>", "\\", "", None, "a\r\n", "</turn", "<<turn"]
    rows = [(1, i, "assistant" if i % 3 == 1 else "user", t) for i, t in enumerate(odd)] + [(2, 0, "user", "no reply")] + [(3, 0, "role\nwith > & &#10; </turn>", "x"), (3, 1, "assistant", "y"), (3, 1, "assistant", "y")] + [(4, None, "assistant", "t"), (4, None, None, "s")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted(tuple(r)[:5] for r in chat.read_back(chat.examples(df)).collect())
    assert got == brute.chat([(c, -1 if t is None else t, r or "", x) for c, t, r, x in rows])
    made = chat.examples(df).filter("conv_id = 1").orderBy("example").collect()
    assert len(made) == 4 and sum(r.loss_start is not None for r in made) == 3 and made[-1].loss_start is None
    assert made[0].formatted[made[0].loss_start :][: made[0].loss_chars] == r"<\\turn"
    assert chat.read_back(chat.examples(df.filter("false"))).count() == 0
    long = [(1, 0, "user", "é<turn" * 200_000), (1, 1, "assistant", "</turn" * 100_000), (1, 2, "user", None)]
    wide = spark.createDataFrame(long, "conv_id long, turn long, role string, text string").withColumns({"example": F.lit(5), "turns": F.lit("x"), "parts": F.lit(2.0)})
    assert [tuple(r)[:5] for r in chat.read_back(chat.examples(wide)).collect()] == brute.chat(long)


def test_toxicity(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 3, 5, 7)] + [(2, None), (99, 1)], "doc_id long, toxic int")
    out = toxicity.report(docs, labels)
    assert ids(out) == ALL and all(0 <= r.score <= 1 for r in out.collect())
    assert toxicity.report(empty, labels).count() == 0
    none = toxicity.report(docs, labels.filter("false")).collect()
    assert len({r.score for r in none}) == 1
    assert toxicity.accepted(docs, labels).columns == docs.columns


def test_toxicity_learns_and_misspellings_share_ngrams(spark):
    import random

    rng = random.Random(5)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8)))
    texts = [" ".join(word() for _ in range(rng.randint(5, 300))) for _ in range(400)]
    bad = [i % 3 == 0 for i in range(400)]
    texts = [t + " you utter blockhead " + word() if b else t for t, b in zip(texts, bad)]
    scorer = toxicity.Scorer(*toxicity.train([t.encode() for t in texts[:300]], [int(b) for b in bad[:300]]))
    right = sum((scorer.score(t.encode()) >= 0.5) == b for t, b in zip(texts[300:], bad[300:]))
    assert right >= 95
    # one passage of a very long text says as much as alone, wherever it stands
    calm = " ".join(word() for _ in range(200_000))
    assert scorer.score(calm.encode()) < 0.5 <= min(scorer.score(t.encode()) for t in ("you utter blockhead " + calm, calm + " you utter blockhead", calm[:500_000] + " you utter blockhead " + calm[500_000:]))
    assert scorer.score(b"you utter blokhead") > scorer.score(b"she rin hat soon")


def test_exact_dedup(spark, docs, empty):
    out = exact_dedup.report(docs).collect()
    assert sorted((r.doc_id for r in out), key=lambda x: (x is None, x)) == ALL
    by = {r.doc_id: r for r in out}
    assert by[4].keep_id == 1 and by[4].group_size == 3 and not by[4].kept and by[1].kept
    assert by[2].keep_id == by[3].keep_id == 2 and by[6].text_sha256 == brute.sha(" ")
    assert by[None].keep_id is None and by[None].kept and exact_dedup.report(empty).count() == 0


def test_exact_dedup_keeps_one_row_a_group(spark):
    """Repeated rows of the smallest id, groups within and across snapshot and batch, groups without ids."""
    rows = [(1, "x y"), (1, "x  y"), (1, "x y"), (9, "x\ty")] + [(i, f"text {i % 50}") for i in range(100, 400)] + [(None, "nobody"), (None, "nobody"), (2, None), (3, "")]
    out = exact_dedup.report(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r.text_sha256, []).append(r)
    flat = {}
    for d, t in rows:
        flat.setdefault(brute.sha(brute.SPACE.sub(" ", t or "")), []).append(d)
    assert set(by) == set(flat)
    for digest, own in by.items():
        least = min((d for d in flat[digest] if d is not None), default=None)
        assert sum(r.kept for r in own) == 1 and {(r.keep_id, r.group_size) for r in own} == {(least, len(flat[digest]))}
        assert [r.doc_id for r in own if r.kept] == [least]


def test_binary_fuse():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 10, 500, 60_000):
        keys = rng.integers(-(2**62), 2**62, n)
        f = exact_dedup.BinaryFuse.build(keys)
        assert n == 0 or f.contains(keys).all()
        other = rng.integers(-(2**62), 2**62, 20_000)
        assert f.contains(other).mean() < 0.02 + (n < 3)


def test_license(spark, docs, empty):
    out = license_scan.report(docs).collect()
    assert sorted((r.doc_id for r in out), key=lambda x: (x is None, x)) == ALL
    by = {r.doc_id: r for r in out}
    assert by[7].base_labels == "cc-by-nc" and by[7].first_word == 5 and by[2].n_words == 0 and by[2].score == 0
    assert license_scan.report(empty).count() == 0
    d = spark.createDataFrame([(1, "Permission is hereby granted, free of charge, to any persson obtaning a copy"), (2, "licensed undr the Apache Licence"), (3, "permission to copy a license under the table"), (4, "cc by nc cc by nc")], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scanned(d).collect()}
    assert got[1].labels == "mit" and 0 < got[1].score < 1 and got[2].labels == "apache" and got[3].labels == "" and got[4].n_base == 2 and (got[4].first_word, got[4].last_word) == (0, 3)
    hit = got[1].fuzzy[0]
    assert d.first().text[hit.start : hit.end].startswith("Permission is hereby") and hit.edits > 0


def test_sharding_of_many_copies(spark, monkeypatch):
    """Copies beyond the bound share one carried row; rows that differ in another column only keep it."""
    monkeypatch.setattr(sharding, "COPIES", 50)
    rows = [(None, "same", i % 2) for i in range(500)] + [(1, "t", 0), (1, "t", 1), (1, "t", 1)] + [(i, None, i) for i in range(2, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, copy long").withColumn("m", F.create_map(F.lit("k"), F.col("copy"))).withColumns({"a": F.lit(1), "__n": F.lit(2), "row": F.lit(3)})
    out = sharding.sharded(df).collect()
    assert sorted(((r.doc_id, r.text, r.copy, r.m["k"], r.a, r["__n"], r.row) for r in out), key=str) == sorted(((d, t, c, c, 1, 2, 3) for d, t, c in rows), key=str)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    again = sharding.report(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, sharding.report(df.coalesce(1)).collect()))


def test_near_copies_are_dropped_by_row(spark):
    """One id with different texts: a copy of one text doesn't take the other with it; repeated rows leave one."""
    t, u = ("%s one two three four five six seven eight nine ten eleven" % w for w in ("first", "a b c d e f g"))
    df = spark.createDataFrame([(1, t), (5, t), (5, u), (5, u), (None, u), (None, "alone"), (9, None), (9, None), (8, "")], "doc_id long, text string").withColumns({"row": F.lit(1), "d": F.lit(2), "print": F.lit(3)})
    out = simhash.keep_one(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text, r.row, r.d, r.print) for r in out.collect()), key=str) == sorted([(1, t, 1, 2, 3), (5, u, 1, 2, 3), (None, "alone", 1, 2, 3), (8, "", 1, 2, 3)], key=str)
