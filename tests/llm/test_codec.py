"""Chunk reuse against the library itself."""

import hashlib
import random

import pytest

pytest.importorskip("fringeline.llm")
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from fringeline.llm import chunk_codec  # noqa: E402
from fringeline.llm.queries import QUERIES  # noqa: E402

FILE = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "B", "\u00df", "e\u0301", "\u00e9", " ", "\n", "\t", "1", "23", "'s", "'", "?", "<|endoftext|>", "<|", "\u6f22\u5b57", "\u3002", "\u00a0", "\u3000", "\u0130", "\u03a3", "\U0001f600", "=\u0338", "\x1c", "\x85", "don't", "\uac01", "\u1100", "\u1161", "\u00b2"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(FILE)
    t.no_truncation()
    t.no_padding()
    return t


def wanted(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    said = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()


def test_whole_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = sorted((r.doc_id, *wanted(library, r.text)) for r in docs.select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in QUERIES["op11_bpe_codec"](spark, sf_dir).collect()) == want


def test_random_texts(library):
    codec, rnd = chunk_codec.codec(FILE), random.Random(11)
    for k in range(120):
        parts = PARTS if k % 3 else ["a", "B", "'s", "\u6f22\u5b57", "."]  # every third has no sure boundary
        text = "".join(rnd.choice(parts) for _ in range(rnd.choice([5, 100, 3000])))
        assert codec.encode(text.encode()) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a" * 200_000, "ab " * 100_000, " " * 100_000, "1" * 50_000, "\u6f22\u5b57" * 50_000, "'" * 20_000])
def test_very_long(library, text):
    assert chunk_codec.codec(FILE).encode(text.encode()) == library.encode(text, add_special_tokens=False).ids


def test_cuts_cover_and_follow_content():
    rnd = random.Random(5)
    shared = " ".join(rnd.choice(["river", "stone", "\u00fcber", "wind"]) + str(rnd.random()) for _ in range(1000)).encode()
    chunks = []
    for before in (b"", b"something else first, "):
        ends = chunk_codec.cut_places(before + shared)
        assert ends[-1] == len(before + shared) and ends == sorted(set(ends))
        chunks.append({(before + shared)[a:b] for a, b in zip([0, *ends], ends)})
        [c.decode() for c in chunks[-1]]
        assert max(map(len, chunks[-1])) <= chunk_codec.MOST
    assert len(chunks[0] & chunks[1]) >= 0.8 * len(chunks[0])


def test_edges(spark, library):
    """Nulls, repeated rows, shared passages, ids of null, columns named as ours."""
    rnd = random.Random(6)
    passage = " ".join(str(rnd.random()) for _ in range(200))
    rows = [(1, None), (1, None), (2, ""), (3, passage), (3, passage), (None, "x " + passage), (4, passage + " \u6f22 " + passage), (5, "<|endoftext|>" + passage), (6, "\x00 nul")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, row string, ord int")
    want = sorted(((i, *wanted(library, t)) for i, t in rows), key=str)
    assert sorted(map(tuple, chunk_codec.report(docs, FILE).collect()), key=str) == want
    back = chunk_codec.encoded(docs, FILE)
    assert sorted(((r.doc_id, tuple(r.ids)) for r in back.collect()), key=str) == sorted(((i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=str)
    said = back.select("doc_id", chunk_codec.decoded(back["ids"], FILE).alias("t")).collect()
    assert sorted((tuple(r) for r in said), key=str) == sorted(((i, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t in rows), key=str)
    assert chunk_codec.report(docs.limit(0), FILE).count() == 0


def test_full_filter_changes_nothing(spark, sf_dir, library, monkeypatch):
    """Where every bit is set all chunks are joined, and the result is the same."""
    import numpy as np

    monkeypatch.setattr(chunk_codec, "shared_filter", lambda docs: np.full(chunk_codec.FILTER_BITS // 64, 2**64 - 1, np.uint64))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = sorted((r.doc_id, *wanted(library, r.text)) for r in docs.select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in chunk_codec.report(docs, FILE).collect()) == want


def test_words_cut_by_chunks_are_not_encoded(monkeypatch):
    """A text of which all has been learned is put together without the library, as its chunks' ends within words aren't asked for."""
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 12))) for _ in range(3_000))
    of = chunk_codec.Codec(FILE)
    want = of.library.encode(text, add_special_tokens=False).ids
    of.learn([text.encode()])
    assert len(chunk_codec.cut_places(text.encode())) > 20
    monkeypatch.setattr(of, "_learn", lambda units: pytest.fail(f"encoded again: {units}"))
    assert of.encode(text.encode()) == want
