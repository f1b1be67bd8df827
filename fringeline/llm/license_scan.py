"""License scans: exact phrases, and a fuzzy search for short notices.

Texts are lower-cased (A-Z) and cut into words. Base phrases are places where a phrase's words stand consecutively.
The fuzzy search allows a notice ``errors`` edits, but none in the words that tell it from another license (``exact``): it is cut into
errors + 1 seeds, of which one must stand unchanged (pigeonhole); one pass of an automaton over all seeds finds them, and
the regex library's bounded-error matching verifies the stretch around each seed. A match begins and ends with whole words.

Of a notice's matches that overlap, the one with the fewest edits is reported, the leftmost of equals; all others stay, however near
they are. A match that lies within a longer notice's match is not reported (attribution, within attribution noncommercial).

Null texts are empty: no words, score 0. Repeated rows get the same result. There is no shuffle; the work grows with the text.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fringeline.llm.common import ascii_words

#: Fixed values of the contract: phrase words and label.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: The method's short notices: text in the words of a normalised document, label, edits allowed, words without edits.
NOTICES = (
    ("under the mit license", "mit", 2, "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6, ""),
    ("apache license version 1", "apache-1", 2, "1"),
    ("apache license version 2", "apache-2", 2, "2"),
    ("licensed under the apache license", "apache", 3, ""),
    ("gnu general public license", "gpl", 2, "gnu"),
    ("gnu lesser general public license", "lgpl", 3, "gnu"),
    ("gnu affero general public license", "agpl", 3, "gnu"),
    ("gnu free documentation license", "gfdl", 2, "gnu"),
    ("mozilla public license", "mpl", 2, ""),
    ("eclipse public license", "epl", 2, ""),
    ("common development and distribution license", "cddl", 4, ""),
    ("boost software license", "boost", 2, ""),
    ("redistribution and use in source and binary forms", "bsd", 4, ""),
    ("neither the name of the copyright holder nor the names of its contributors may be used", "bsd", 6, ""),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 6, ""),
    ("this is free and unencumbered software released into the public domain", "unlicense", 5, ""),
    ("creative commons attribution", "cc-by", 2, ""),
    ("creative commons attribution sharealike", "cc-by-sa", 3, ""),
    ("creative commons attribution share alike", "cc-by-sa", 3, ""),
    ("creative commons attribution noncommercial", "cc-by-nc", 3, ""),
    ("creative commons attribution non commercial", "cc-by-nc", 3, ""),
    ("creative commons attribution noderivatives", "cc-by-nd", 3, ""),
    ("creative commons attribution no derivatives", "cc-by-nd", 3, ""),
    ("creative commons zero", "cc0", 1, ""),
    ("all rights reserved", "all-rights-reserved", 1, ""),
)
#: Verified stretches that a worker keeps; the store is emptied when it is full.
KEPT = 200_000
MATCH_SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, fuzzy array<struct<label:string,first_word:int,end_word:int,start:int,end:int,edits:int>>"

_engine: list = []


def _seeds(notice: str, errors: int) -> list[tuple[str, int]]:
    """errors + 1 pieces of near equal length, with their offsets."""
    cuts = [round(i * len(notice) / (errors + 1)) for i in range(errors + 2)]
    return [(notice[a:b], a) for a, b in zip(cuts, cuts[1:])]


def engine():
    """(automaton of all seeds, verifiers, verified stretches), one for each worker."""
    if not _engine:
        import ahocorasick
        import regex

        at: dict[str, list[tuple[int, int]]] = {}
        for i, (notice, _, errors, _) in enumerate(NOTICES):
            for seed, offset in _seeds(notice, errors):
                at.setdefault(seed, []).append((i, offset))
        automaton = ahocorasick.Automaton()
        for seed, uses in at.items():
            automaton.add_word(seed, (len(seed), uses))
        automaton.make_automaton()
        verify = [regex.compile(rf"(?b)(?<!\S)(?:{regex.escape(n)}){{e<={e}}}(?!\S)") for n, _, e, _ in NOTICES]
        _engine.append((automaton, verify, {}))
    return _engine[0]


def _verified(i: int, stretch: str) -> tuple[int, int, int] | None:
    """(start, end, edits) of a notice's best match in a stretch of whole words."""
    _, verify, known = engine()
    if (i, stretch) not in known:
        if len(known) > KEPT:
            known.clear()
        m = verify[i].search(stretch)
        exact = NOTICES[i][3]
        sound = m and (not exact or exact in m[0].split(" "))
        known[i, stretch] = (m.start(), m.end(), sum(m.fuzzy_counts)) if sound else None
    return known[i, stretch]


def _fuzzy(flat: str) -> list[tuple[int, int, int, int]]:
    """(notice, start, end, edits) in the flat text."""
    automaton = engine()[0]
    found: dict[int, dict[tuple[int, int], int]] = {}
    for last, (length, uses) in automaton.iter(flat):
        for i, offset in uses:
            notice, _, errors, _ = NOTICES[i]
            start = last - length + 1 - offset
            # the whole words of the stretch that a match on this seed can reach
            low, high = max(0, start - errors), min(len(flat), start + len(notice) + errors)
            if low and flat[low - 1] != " ":
                low = flat.find(" ", low, high) + 1 or high
            if high < len(flat) and flat[high] != " ":
                high = flat.rfind(" ", low, high)
            m = _verified(i, flat[low:high]) if low < high else None
            if m:
                found.setdefault(i, {})[low + m[0], low + m[1]] = m[2]
    out = []
    for i, own in found.items():
        taken: list[tuple[int, int]] = []
        for (start, end), edits in sorted(own.items(), key=lambda x: (x[1], x[0])):
            k = bisect_left(taken, (start, end))
            if (k == 0 or taken[k - 1][1] <= start) and (k == len(taken) or end <= taken[k][0]):
                taken.insert(k, (start, end))
                out.append((i, start, end, edits))
    # by start, longest first, fewest edits first: what ends no later than an earlier one lies within it
    kept, furthest = [], -1
    for m in sorted(out, key=lambda m: (m[1], -m[2], m[3])):
        if m[2] > furthest:
            kept.append(m)
            furthest = m[2]
    return kept


def scan(text: str) -> tuple:
    """The values of MATCH_SCHEMA for one text."""
    words = [w.decode("utf-8", "replace") for w in ascii_words(text.encode("utf-8", "replace"))]
    flat, begins = " ".join(words), []
    padded, base = f" {flat} ", []
    for phrase, label in BASE:
        at = padded.find(f" {phrase} ")
        while at >= 0:
            begins = begins or list(accumulate((len(w) + 1 for w in words), initial=0))
            base.append((bisect_left(begins, at), label))
            at = padded.find(f" {phrase} ", at + 1)
    own = {label for _, label in base}
    fuzzy, spans = [], None
    for i, start, end, edits in _fuzzy(flat) if flat else ():
        begins = begins or list(accumulate((len(w) + 1 for w in words), initial=0))
        spans = spans or _word_spans(text)
        first, last = bisect_left(begins, start), bisect_right(begins, end) - 1
        fuzzy.append((NOTICES[i][1], first, last + 1, spans[first][0], spans[last][1], edits, 1 - edits / len(NOTICES[i][0])))
    labels = sorted({*own, *(f[0] for f in fuzzy)})
    score = 1.0 if base else max((f[6] for f in fuzzy), default=0.0)
    at = [i for i, _ in base]
    return len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(labels), score, [dict(zip(("label", "first_word", "end_word", "start", "end", "edits"), f)) for f in sorted(fuzzy)]


def _word_spans(text: str) -> list[tuple[int, int]]:
    import regex

    return [m.span() for m in regex.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, ...) with the columns of MATCH_SCHEMA; ``fuzzy`` holds spans in words and in code points."""
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [c.split()[0] for c in MATCH_SCHEMA.split(", ")[:8]]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), *((n, pa.int32()) for n in ("first_word", "end_word", "start", "end", "edits"))]))]

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(t or "") for t in batch.column("text").to_pylist()]
            cols = list(zip(*rows)) or [()] * 8
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, types))], ["doc_id", *names])

    return docs.mapInArrow(scan_batches, f"doc_id {kind}, {MATCH_SCHEMA}")


def report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_fuzzy."""
    return scanned(docs).withColumn("n_fuzzy", F.size("fuzzy").cast("long")).drop("fuzzy")
