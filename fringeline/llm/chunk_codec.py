"""BPE encoding and decoding with content-defined chunks that documents share.

1. A rolling hash over the last ``REACH`` bytes of a text decides where it is cut, so the same passage is cut alike in whichever text it
   stands. Chunks have ``LEAST`` bytes or more; one that reaches ``MOST`` is cut there. A first pass counts chunks by hash; what occurs twice or
   more sets a bit in a filter of ``FILTER_BITS`` bits, a fixed size.
2. A second pass cuts again. Chunks outside the filter are no other document's and are encoded on the spot; a document without any other is
   finished there and never shuffled. Of the others only a reference leaves, and the text once for each task. A bit that other chunks
   set sends a chunk the long way round and changes no result.
3. Each distinct chunk is then encoded once, and its ids are joined to all references to it; both sides are written, so that a chunk
   in a third of all documents is a skewed join that can be split.
4. A document's pieces come together in order, one at a time.

Joins are repaired where the text is: at each cut the stretch between the last sure boundary before and the first behind it is encoded again,
with a margin on both sides. Sure boundaries stand before white space and before digits, which no token spans. If the margins' tokens
agree with those of the chunks they lie in, the stretch's tokens take the place of the chunks' own; if not, it grows. A chunk without
a sure boundary is left out, and the stretch goes on through it.

Within a chunk each distinct word is encoded once for a worker. Words are found here only in Latin letters; what stands between white space
and has other characters, or the string of a special token, goes whole to the library.

Null texts are empty; an empty text has no ids. Rows are kept apart by their place in the table, so null and repeated ids are rows of their
own. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fringeline.llm.common import kept, scratch, written

#: A cut comes after 2 ** CUT_BITS bytes on average, once LEAST bytes are there.
CUT_BITS = 9
LEAST = 128
MOST = 8192
REACH = 16
FILTER_BITS = 1 << 26
#: Words, and units between white space of LONG_UNIT bytes or fewer, whose ids a worker keeps; and hashes whose counts it keeps before it hands them on.
KEPT_WORDS = 500_000
KEPT_UNITS = 700_000
LONG_UNIT = 64
KEPT_HASHES = 500_000
#: Bytes of ids in a batch.
BATCH_BYTES = 4_000_000

_GEAR = np.random.default_rng(20_240).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_places(text: bytes) -> list[int]:
    """Ends of a text's chunks, its own end included; always between two characters. None for an empty text."""
    n = len(text)
    raw = np.frombuffer(text, np.uint8)
    h = _GEAR[raw]
    step = 1
    while step < REACH:
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        step *= 2
    first = np.append((raw[1:] & 0xC0) != 0x80, True)  # a character begins behind this byte
    marks = (np.flatnonzero((h >> np.uint32(32 - CUT_BITS) == 0) & first) + 1).tolist()
    out, last = [], 0
    for at in [*marks, n]:
        while at - last > MOST:
            last += MOST
            while not first[last - 1]:
                last -= 1
            out.append(last)
        if at - last >= LEAST or at == n > last:
            out.append(at)
            last = at
    return out


class Codec:
    """One tokenizer file in one worker."""

    def __init__(self, file: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(file)
        self.library.no_truncation()
        self.library.no_padding()
        with open(file, encoding="utf-8") as f:
            plan = json.load(f)
        kinds = lambda x, k: [y["type"] for y in (plan[x] or {}).get(k, [])]
        split = (plan["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        if kinds("normalizer", "normalizers") != ["NFC", "Replace", "Lowercase"] or kinds("pre_tokenizer", "pretokenizers") != ["Split", "ByteLevel"] or split["behavior"] != "Removed" or not split["invert"] or plan["post_processor"] or plan["decoder"]:
            raise ValueError("boundaries are known for tokenizers that lower texts and split them into words by a pattern")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.lines = regex.compile("\n|" + split["pattern"]["Regex"])
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        if any(set(s) & set(" \t\n\v\f\r") for s in special):
            raise ValueError("a special token holds white space")
        self.odd = regex.compile("|".join([r"[^\x20-\x7E\t-\r¡-įı-ſ]", *map(regex.escape, special)]))
        self.sure = np.zeros(256, bool)
        self.sure[[c for c in (0x20, *range(9, 14), *range(0x30, 0x3A)) if not any(chr(c) in s for s in special)]] = True
        size = self.library.get_vocab_size()
        self.names = np.array([self.library.id_to_token(i) for i in range(size)], dtype=object)
        self.decimals = np.array([str(i) for i in range(size)], dtype=object)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends_word = np.array([str(name).endswith("</w>") for name in self.names])
        #: ids of words, and of what stands between white space
        self.words_kept: dict[str, bytes] = {}
        self.kept: dict[bytes, bytes] = {}

    def _learn_words(self, words: list[str]) -> None:
        """Ids of new words, in one call: a word's last token alone ends in the word's end sign."""
        ids = np.array(self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.dtype)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) == len(words):
            raw, last = ids.tobytes(), 0
            for word, end in zip(words, (ends * self.dtype.itemsize).tolist()):
                self.words_kept[word] = raw[last:end]
                last = end
        else:
            for word, e in zip(words, self.library.encode_batch_fast(words, add_special_tokens=False)):
                self.words_kept[word] = np.array(e.ids, self.dtype).tobytes()

    def _learn(self, units: list[bytes]) -> dict[bytes, bytes]:
        """Ids of what stands between white space; those of short units are kept."""
        if len(self.kept) > 2 * KEPT_UNITS:  # single texts of that many
            self.kept.clear()
        if len(self.words_kept) > KEPT_WORDS:
            self.words_kept.clear()
        found: dict[bytes, bytes] = {}
        lines = b"\n".join(units).decode()
        if self.odd.search(lines):
            odd = [u for u in units if self.odd.search(u.decode())]
            for u, e in zip(odd, self.library.encode_batch_fast([u.decode() for u in odd], add_special_tokens=False)):
                found[u] = np.array(e.ids, self.dtype).tobytes()
            units = [u for u in units if u not in found]
            lines = b"\n".join(units).decode()
        # all units in one search, a line each
        words, known = self.lines.findall(lines.lower()), self.words_kept
        new = list(set(words).difference(known, "\n"))
        for i in range(0, len(new), 50_000):
            self._learn_words(new[i : i + 50_000])
        known["\n"] = b""
        at, ends = 0, [i for i, w in enumerate(words) if w == "\n"]
        ids = list(map(known.__getitem__, words))
        for u, end in zip(units, [*ends, len(words)]):
            found[u] = ids[at] if end == at + 1 else b"".join(ids[at:end])
            at = end + 1
        self.kept.update(found if max(map(len, found)) <= LONG_UNIT else {u: x for u, x in found.items() if len(u) <= LONG_UNIT})
        return found

    def learn(self, texts: list[bytes]) -> None:
        """Ids of all that is new in some texts, together."""
        units = set().union(*[t.split() for t in texts])
        new = units.difference(self.kept)
        if len(self.kept) + len(new) > KEPT_UNITS:
            self.kept.clear()
            new = units
        if new:
            self._learn(list(new))

    def ids(self, text: bytes) -> bytes:
        """Ids of a text, as the library gives them, in the bytes of ``dtype``."""
        units, known = text.split(), self.kept
        try:
            return b"".join(map(known.__getitem__, units))
        except KeyError:
            out = []
            for i in range(0, len(units), 20_000):
                part = units[i : i + 20_000]
                mine = {u: known[u] for u in part if u in known}
                mine |= self._learn([u for u in dict.fromkeys(part) if u not in mine])
                out += map(mine.__getitem__, part)
            return b"".join(out)

    def seams(self, text: bytes, cuts: list[int]) -> list[tuple[int, int, bytes]]:
        """(begin, end, ids) of the stretch around each cut, inner cuts only; cuts in one stretch have one."""
        places = np.flatnonzero(self.sure[np.frombuffer(text, np.uint8)])
        sure = np.concatenate(([0], places[places > 0], [len(text)]))
        last, at = len(sure) - 1, np.array(cuts)
        spans = dict(zip((np.searchsorted(sure, at, "right") - 1).tolist(), np.searchsorted(sure, at, "left").tolist()))
        out = []
        for lo, hi in spans.items():
            grown = 1
            while True:
                a, b = max(0, lo - grown), min(last, hi + grown)
                lead, tail = self.ids(text[sure[a] : sure[lo]]), self.ids(text[sure[hi] : sure[b]])
                whole = self.ids(text[sure[a] : sure[b]])
                inner = len(whole) - len(tail)
                if whole[: len(lead)] == lead and whole[inner:] == tail and inner >= len(lead):
                    out.append((int(sure[lo]), int(sure[hi]), whole[len(lead) : inner]))
                    break
                if a == 0 and b == last:
                    out.append((0, len(text), whole))
                    return out[-1:]
                grown *= 2
        return out

    def pieces(self, text: bytes, shared: Callable[[bytes], bool]) -> Iterator[tuple[bytes, int, int, bytes] | bytes]:
        """A text in order: ids, or (digest, ids to skip, ids to leave out at the end, chunk) of a shared chunk."""
        ends = cut_places(text)
        seams = self.seams(text, ends[:-1]) if len(ends) > 1 else []
        x, i = 0, 0
        for y, resume, between in [*seams, (len(text), len(text), b"")]:
            if x < y:  # lies within one chunk, as every cut lies within a seam
                while ends[i] < y:
                    i += 1
                begin, end = ends[i - 1] if i else 0, ends[i]
                chunk = text[begin:end]
                digest = digest_of(chunk)
                if shared(digest):
                    skip, leave = (len(self.ids(t)) // self.dtype.itemsize for t in (text[begin:x], text[y:end]))
                    yield digest, skip, leave, chunk
                else:  # what lies between the seams is all that is asked for
                    yield self.ids(text[x:y])
            yield between
            x = resume

    def encode(self, text: bytes) -> list[int]:
        """pieces() put together, with every chunk encoded here."""
        return np.frombuffer(b"".join(self.pieces(text, lambda _: False)), self.dtype).tolist()

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(self.names[ids].tolist())


def digest_of(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _bit(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little") & (FILTER_BITS - 1)


_codecs: dict[str, Codec] = {}


def codec(file: str) -> Codec:
    """One codec for each file and worker process."""
    if file not in _codecs:
        _codecs[file] = Codec(file)
    return _codecs[file]


class _Rows:
    """Rows of one schema, handed on in batches of about BATCH_BYTES; the last value of a row is its size."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, size: int, **values) -> Iterator[pa.RecordBatch]:
        self.rows.append(values)
        self.size += size + 64
        if self.size >= BATCH_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.size = [], 0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, n) of chunks, counted within the task as far as memory goes."""
    seen: Counter[int] = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.int64()), pa.array(seen.values(), pa.int64())], ["hash", "n"])
        seen.clear()
        return out

    for batch in batches:
        for text in batch.column(0).cast(pa.binary()).to_pylist():
            begin = 0
            for end in cut_places(text) if text else ():
                seen[int.from_bytes(digest_of(text[begin:end])[:8], "little", signed=True)] += 1
                begin = end
            if len(seen) > KEPT_HASHES:
                yield flush()
    if seen:
        yield flush()


def shared_filter(docs: DataFrame) -> np.ndarray:
    """The bits of chunks that occur twice or more, FILTER_BITS of them whatever the corpus; brought together by stretches of bits."""
    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    counts = texts.mapInArrow(_counted, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).filter("n > 1")
    bits = counts.select(F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("bit"))
    longs = bits.groupBy(F.shiftright("bit", 6).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, np.int64)
    found = longs.toPandas()
    out[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def _digests(of: Codec):
    """Columns of a document's digests, and a maker of what takes its ids bit by bit."""

    class Sums:
        def __init__(self):
            self.n, self.ids, self.text = 0, hashlib.sha256(), hashlib.sha256()

        def add(self, ids: np.ndarray) -> None:
            if len(ids):
                join = " " if self.n else ""
                self.ids.update((join + " ".join(of.decimals[ids].tolist())).encode())
                self.text.update((join + of.decode(ids)).encode())
                self.n += len(ids)

        def values(self) -> dict:
            return {"n_tokens": self.n, "ids_sha256": self.ids.hexdigest(), "decoded_sha256": self.text.hexdigest()}

    return Sums


def _whole(of: Codec):
    class Ids:
        def __init__(self):
            self.parts = []

        def add(self, ids: np.ndarray) -> None:
            self.parts.append(ids)

        def values(self) -> dict:
            return {"ids": np.concatenate([np.zeros(0, of.dtype), *self.parts]).astype(np.int32).tolist()}

    return Ids


#: What can be made of a document's ids: columns with types, and the maker.
DIGESTS = ("n_tokens long, ids_sha256 string, decoded_sha256 string", [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())], _digests)
IDS = ("ids array<int>", [("ids", pa.list_(pa.int32()))], _whole)


def _made(docs: DataFrame, file: str, form: tuple) -> DataFrame:
    """(doc_id and the form's columns) of every row. Call within scratch()."""
    spark, (sql, arrow, maker) = docs.sparkSession, form
    bits = spark.sparkContext.broadcast(shared_filter(docs))  # a fixed size
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType
    names = [n for n, _ in arrow]
    schema = pa.schema([("doc_id", to_arrow_type(kind)), *arrow, ("row", pa.int64()), ("ord", pa.int32()), ("digest", pa.binary()), ("skip", pa.int32()), ("leave", pa.int32()), ("own", pa.binary()), ("chunk", pa.binary())])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, filled, out, sent = codec(file), bits.value, _Rows(schema), set()
        number = TaskContext.get().partitionId() << 33

        def shared(digest: bytes) -> bool:
            b = _bit(digest)
            return bool(int(filled[b >> 6]) >> (b & 63) & 1)

        for batch in batches:
            texts, ahead = batch.column("text").cast(pa.binary()).to_pylist(), 0
            for at, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), texts)):
                if at == ahead:
                    size, ahead = 0, at
                    while ahead < len(texts) and (ahead == at or size + len(texts[ahead]) < BATCH_BYTES):
                        size, ahead = size + len(texts[ahead]), ahead + 1
                    of.learn(texts[at:ahead])
                number += 1
                parts, asked = [], False
                for piece in of.pieces(text, shared) if text else ():
                    if isinstance(piece, tuple):
                        asked = True
                        parts.append(piece)
                    elif parts and isinstance(parts[-1], list):
                        parts[-1].append(piece)
                    else:
                        parts.append([piece])
                if not asked:
                    made = maker(of)()
                    for part in parts:
                        made.add(np.frombuffer(b"".join(part), of.dtype))
                    yield from out.add(200, doc_id=doc_id, **made.values())
                    continue
                yield from out.add(0, doc_id=doc_id, row=number, ord=-1)
                for at, part in enumerate(parts):
                    if isinstance(part, list):
                        raw = b"".join(part)
                        yield from out.add(len(raw), row=number, ord=at, own=raw)
                        continue
                    digest, skip, leave, chunk = part
                    yield from out.add(0, row=number, ord=at, digest=digest, skip=skip, leave=leave)
                    if digest not in sent:
                        if len(sent) >= KEPT_HASHES:
                            sent.clear()
                        sent.add(digest)
                        yield from out.add(len(chunk), digest=digest, chunk=chunk)
        yield from out.flush()

    told = written(rows.mapInArrow(first, f"doc_id {kind.simpleString()}, {sql}, row long, ord int, digest binary, skip int, leave int, own binary, chunk binary"))

    @F.pandas_udf("binary")
    def encoded_chunk(s: pd.Series) -> pd.Series:
        of, chunks = codec(file), [bytes(c) for c in s]
        of.learn(chunks)
        return pd.Series([of.ids(c) for c in chunks], dtype=object)

    chunks = told.filter("chunk is not null").groupBy("digest").agg(F.any_value("chunk").alias("chunk"))
    chunks = written(chunks.select("digest", encoded_chunk("chunk").alias("of_chunk")))
    asked = told.filter("row is not null and digest is not null").select("row", "ord", "digest", "skip", "leave")
    joined = asked.join(chunks.hint("merge"), "digest").select(F.lit(None).cast(kind).alias("doc_id"), "row", "ord", "skip", "leave", F.col("of_chunk").alias("own"))
    pieces = told.filter("row is not null and digest is null").select("doc_id", "row", "ord", F.lit(0).alias("skip"), F.lit(0).alias("leave"), "own").unionByName(joined)
    done = pa.schema([("doc_id", to_arrow_type(kind)), *arrow])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, out, now, made, name = codec(file), _Rows(done), None, None, None
        for batch in batches:
            for doc_id, row, skip, leave, own in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "row", "skip", "leave", "own")]):
                if row != now:
                    if made is not None:
                        yield from out.add(200, doc_id=name, **made.values())
                    now, name, made = row, doc_id, maker(of)()
                if own is not None:
                    ids = np.frombuffer(own, of.dtype)
                    made.add(ids[skip : len(ids) - leave])
        if made is not None:
            yield from out.add(200, doc_id=name, **made.values())
        yield from out.flush()

    finished = told.filter("row is null and chunk is null").select("doc_id", *names)
    return finished.unionByName(pieces.repartition("row").sortWithinPartitions("row", "ord").mapInArrow(together, f"doc_id {kind.simpleString()}, {sql}"))


def encoded(docs: DataFrame, file: str) -> DataFrame:
    """(doc_id, ids) of every row; ``file`` must lie at the same path on every executor. Written."""
    with scratch(docs.sparkSession):
        return kept(_made(docs, file, IDS))


def decoded(ids: Column, file: str) -> Column:
    """Text of an array of ids, as the library decodes it with special tokens kept; null for null."""

    @F.pandas_udf("string")
    def text(s: pd.Series) -> pd.Series:
        of = codec(file)
        return pd.Series([None if i is None else of.decode(np.asarray(i, np.int64)) for i in s], dtype=object)

    return text(ids)


def report(docs: DataFrame, file: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256. The ids are digested as a document's pieces come, and kept nowhere. Written."""
    with scratch(docs.sparkSession):
        return kept(_made(docs, file, DIGESTS))
