"""Every registered document query against a plain Python version on a small table."""

import zlib

import duckdb
import pytest

from tests.llm import brute

pytest.importorskip("fringeline.llm")
from fringeline.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402


def table(sf_dir, name, cols):
    return duckdb.sql(f"select {cols} from '{sf_dir}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def docs(sf_dir):
    return table(sf_dir, "documents", "doc_id, text")


def test_op1(spark, sf_dir, docs):
    assert sorted(tuple(r) for r in QUERIES["op1_simhash"](spark, sf_dir).collect()) == brute.simhash(docs)


def test_op2(spark, sf_dir, docs):
    texts = dict(docs)
    rows = QUERIES["op2_pii"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    terms = brute.pii_terms(docs)
    assert sum(map(len, terms.values())) > 100
    for r in rows:
        counts, digest, spans = brute.pii(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == digest
        own = sorted([(a, list(brute.KINDS).index(k), k, b) for k, a, b in spans] + [(a, 4, "term", b) for a, b, _ in terms[r.doc_id]])
        assert r.spans == ",".join(f"{k}:{a}:{b}" for a, _, k, b in own)
        assert (r.n_term, r.n_removed) == (len(terms[r.doc_id]), sum(not put for *_, put in terms[r.doc_id]))


def test_op3(spark, sf_dir, docs):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = [(d, len(t.encode()), n := len(sp.encode(t)), n > 4096) for d, t in docs]
    assert sorted(tuple(r) for r in QUERIES["op3_token_counts"](spark, sf_dir).collect()) == sorted(want)


def test_op4(spark, sf_dir, docs):
    bench = table(sf_dir, "benchmark", "item_id, text")
    rows = QUERIES["op4_decontaminate"](spark, sf_dir).drop("n_near").collect()
    assert sorted(tuple(r) for r in rows) == brute.decontaminate(docs, bench)


def test_op5(spark, sf_dir):
    docs = table(sf_dir, "documents", "doc_id, source, text")
    rows = {r.doc_id: r for r in QUERIES["op5_mixing"](spark, sf_dir).collect()}
    size, source = {d: len(brute.NOT_SPACE.findall(t or "")) for d, _, t in docs}, {d: s for d, s, _ in docs}
    sums = {}
    for d, s in source.items():
        sums[s] = sums.get(s, 0) + size[d]
    order = sorted(sums, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    capped = set()
    while True:
        free = [s for s in order if s not in capped]
        level = (1.5 * sum(sums.values()) - sum(2 * sums[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sums[s]}
        if not over:
            break
        capped |= over
    taken = dict.fromkeys(order, 0)
    for d, r in rows.items():
        assert (r.size, r.source_size) == (size[d], sums[source[d]])
        assert r.target == pytest.approx(2 * sums[source[d]] if source[d] in capped else level * weight[source[d]])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[d]] += r.taken
    for s in order:
        target = 2 * sums[s] if s in capped else level * weight[s]
        assert abs(taken[s] - target) <= 0.02 * target, s
    # of each class the documents with the smallest hashes, as many as the fit says, whose sum is the nearest to the target that there is
    import struct

    import numpy as np
    import xxhash

    from fringeline.llm import mixing

    texts = {d: t for d, _, t in docs}
    order_of = lambda d: struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(struct.pack("<i", mixing.SEED), xxhash.xxh64_intdigest((texts[d] or "").encode(), xxhash.xxh64_intdigest(str(d).encode(), 42)))))[0]
    for s in order:
        target = 2 * sums[s] if s in capped else level * weight[s]
        classes = {}
        for d in (d for d in source if source[d] == s):
            classes.setdefault(size[d], []).append(d)
        lengths = np.array(sorted(classes))
        counts = np.array([len(classes[z]) for z in lengths])
        whole = min(2, int(target // sums[s]))
        budget = round(target - whole * sums[s]) if whole < 2 else 0
        take = mixing.fit(lengths, counts, budget)
        reached = 1  # a bit for each sum of documents
        for z, k in zip(lengths.tolist(), counts.tolist()):
            for _ in range(k):
                reached |= reached << z
        nearest = next(d for d in range(budget + 1) if reached >> (budget + d) & 1 or reached >> (budget - d) & 1)
        assert abs(int((take * lengths).sum()) - budget) == nearest
        for z, k in zip(lengths.tolist(), take.tolist()):
            for i, d in enumerate(sorted(classes[z], key=order_of)):
                assert rows[d].taken == z * (whole + (i < k))
    assert {d: r.taken for d, r in rows.items()} == {r.doc_id: r.taken for r in QUERIES["op5_mixing"](spark, sf_dir).collect()}


def test_op6(spark, sf_dir, docs):
    texts, rows = dict(docs), QUERIES["op6_sharding"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    by = {}
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        by.setdefault(r.shard, []).append(r.slot)
    assert set(by) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, QUERIES["op6_sharding"](spark, sf_dir).collect()), key=str)


def test_op7(spark, sf_dir):
    talks = table(sf_dir, "conversations", "conv_id, turn, role, text")
    said = r"\### Assistant: </turn> ok"
    talks += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    rows = QUERIES["op7_chat"](spark, sf_dir).collect()
    assert sorted(tuple(r)[:5] for r in rows) == brute.chat(talks)
    assert all(r.formatted_chars > r.loss_chars for r in rows)


def test_op8(spark):
    sf_dir = "/root/testdata/sf0.1"  # smaller tables hold out half a dozen toxic rows, too few to judge by
    toxic = dict(table(sf_dir, "labels", "doc_id, toxic"))
    rows = QUERIES["op8_toxicity"](spark, sf_dir).collect()
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and toxic.get(r.doc_id) is not None]
    ones, zeros = [s for s, t in held if t], [s for s, t in held if not t]
    auc = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / len(ones) / len(zeros)
    assert auc > 0.9
    said = [(r.predicted, toxic[r.doc_id]) for r in rows if r.held_out and toxic.get(r.doc_id) is not None]
    assert sum(p for p, t in said if t) > 0.75 * len(ones) and sum(p for p, t in said if not t) < 0.08 * len(zeros)


def test_op9(spark, sf_dir, docs):
    assert sorted(tuple(r) for r in QUERIES["op9_exact_dedup"](spark, sf_dir).collect()) == brute.exact(docs)


def test_op10(spark, sf_dir, docs):
    texts = dict(docs)
    rows = QUERIES["op10_license"](spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert r.score == 1 or not r.n_base


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    found = con.sql(ORACLE_SQL[name])
    ours = QUERIES[name](spark, sf_dir)
    assert sorted(map(str, map(tuple, ours.select(*found.columns).collect()))) == sorted(map(str, found.fetchall()))
