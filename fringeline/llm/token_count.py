"""Token counts by rank-synchronous merging of ragged numpy arrays.

The vocabulary is read from a sentencepiece BPE model with byte fallback. A text gets the dummy prefix and
its spaces become the marker; it is cut where no piece can reach across. The distinct pre-tokens of a batch
are held as one flat symbol array with sequence ids, and in every round each sequence merges the pair of
lowest rank, all sequences at once, until no pair is left. The surviving symbols are counted; a symbol
outside the vocabulary counts its UTF-8 bytes.

In a round a sequence's occurrences of its lowest rank are merged from the left up to the first whose merge makes a pair of the same or
a lower rank with what then stands beside it; that pair has its turn in the next round. This is the library's order of merges. Where
all pairs of a run tie, as those of spaces do, a round would merge one pair only: a sequence above ``CHAIN`` symbols in which that
happens is finished alone, by a heap of its pairs.

Null texts are empty; an empty text has no tokens.
"""

from __future__ import annotations

import re
from collections import Counter
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Counts of pre-tokens that a worker keeps; the store is emptied when it is full.
KEPT = 400_000
#: Pre-tokens above this many characters are merged on their own and not kept.
LONG = 200
#: Symbols of a sequence above which ties are merged by a heap instead of round by round.
CHAIN = 64


class RankMerger:
    """Pairs of symbol ids to ranks and merged ids, for one model."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = [i for i in range(sp.get_piece_size()) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)]
        skip = set(special)
        pieces = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if i not in skip}
        scores = sorted({-s for p, s in pieces.items() if len(p) > 1})
        rank_of = {s: r for r, s in enumerate(scores)}
        self.ids = {p: i for i, p in enumerate(pieces)}
        pairs = {}
        for piece, score in pieces.items():
            for k in range(1, len(piece)):
                a, b = self.ids.get(piece[:k]), self.ids.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (rank_of[-score], self.ids[piece])
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)
        inner = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.joined = inner
        self.marks_inside = any(MARK in p.lstrip(MARK) for p in pieces)
        self.kept: dict[str, int] = {}

    def pre_tokens(self, text: str) -> list[str]:
        """Parts of a text that no piece reaches across."""
        marked = MARK + text.replace(" ", MARK)
        return [marked] if self.marks_inside else re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", marked)

    def _cut(self, token: str) -> list[str]:
        """Cut a long pre-token between characters that are neighbours in no piece."""
        at = [i for i in range(1, len(token)) if token[i - 1 : i + 1] not in self.joined]
        return [token[a:b] for a, b in zip([0, *at], [*at, len(token)])]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, the largest number where there is none; -1 stands for no symbol."""
        pair = (left << 32) | right
        at = np.searchsorted(self.keys, pair)
        at[at == len(self.keys)] = 0
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == pair), self.ranks[at], np.iinfo(np.int64).max)

    def count(self, tokens: list[str]) -> np.ndarray:
        """Surviving symbols of each pre-token."""
        out = np.zeros(len(tokens), np.int64)
        flat, seq = [], []
        for i, token in enumerate(tokens):
            for c in token:
                s = self.ids.get(c)
                if s is None:
                    out[i] += len(c.encode("utf-8", "surrogatepass"))
                    s = -1
                flat.append(s)
            seq.append(len(token))
        sym, owner = np.array(flat, dtype=np.int64), np.repeat(np.arange(len(tokens)), seq)
        while len(sym):
            pair = (sym[:-1] << 32) | sym[1:]
            ok = (owner[1:] == owner[:-1]) & (sym[:-1] >= 0) & (sym[1:] >= 0)
            at = np.searchsorted(self.keys, pair)
            at[at == len(self.keys)] = 0
            ok &= self.keys[at] == pair
            where = np.flatnonzero(ok)
            if not len(where):
                break
            at, who = at[where], owner[where]
            start = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
            size = np.diff(np.concatenate((start, [len(who)])))
            best = np.repeat(np.minimum.reduceat(self.ranks[at], start), size)
            take = self.ranks[at] == best
            where, at, who, best = where[take], at[take], who[take], best[take]
            # runs of overlapping occurrences: every second one, from the left
            spot = np.arange(len(where))
            lone = np.concatenate(([True], (who[1:] != who[:-1]) | (np.diff(where) != 1)))
            use = (spot - np.maximum.accumulate(np.where(lone, spot, 0))) % 2 == 0
            where, at, who, best = where[use], at[use], who[use], best[use]
            # what stands beside each merged symbol when it is made: to the left the last merge may have changed it
            made = self.merged[at]
            side = np.concatenate(([-1], sym, [-1, -1]))
            owned = np.concatenate(([-1], owner, [-1, -1]))
            left = np.where(owned[where] == who, side[where], -1)
            right = np.where(owned[where + 3] == who, side[where + 3], -1)
            close = np.flatnonzero((np.diff(where) == 2) & (who[1:] == who[:-1])) + 1
            left[close] = made[close - 1]
            stops = np.minimum(self._ranks(left, made), self._ranks(made, right)) <= best
            before = np.cumsum(stops) - stops
            first = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
            use = before == np.repeat(before[first], np.diff(np.concatenate((first, [len(who)]))))
            stuck = np.unique(who[~use])
            where, at = where[use], at[use]
            sym[where] = self.merged[at]
            keep = np.ones(len(sym), bool)
            keep[where + 1] = False
            if len(stuck):
                for i in stuck[np.bincount(owner[keep], minlength=len(tokens))[stuck] > CHAIN].tolist():
                    a, b = np.searchsorted(owner, (i, i + 1))
                    out[i] += self._finished(sym[a:b][keep[a:b]].tolist())
                    keep[a:b] = False
            sym, owner = sym[keep], owner[keep]
            # sequences that merged nothing are finished
            live = np.zeros(len(tokens), bool)
            live[who] = True
            done = ~live[owner]
            if done.any():
                np.add.at(out, owner[done & (sym >= 0)], 1)
                sym, owner = sym[~done], owner[~done]
        np.add.at(out, owner[sym >= 0], 1)
        return out

    def _finished(self, sym: list[int]) -> int:
        """Surviving symbols of one sequence: the lowest rank first, of equals the leftmost."""
        pairs, n = self.pairs, len(sym)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]

        def ranked(i: int) -> tuple[int, int, int] | None:
            j = after[i]
            got = pairs.get(sym[i] << 32 | sym[j]) if j >= 0 and sym[i] >= 0 and sym[j] >= 0 else None
            return (got[0], i, got[1]) if got else None

        heap = [x for x in map(ranked, range(n)) if x]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i = top[1]
            if sym[i] < 0 or ranked(i) != top:
                continue  # one of its symbols has gone
            j = after[i]
            sym[i], sym[j], after[i] = top[2], -2, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (new := ranked(k)):
                    heappush(heap, new)
        return sum(s >= 0 for s in sym)

    def count_texts(self, texts: list[str]) -> list[int]:
        """Tokens of every text; texts are taken one at a time, so memory follows the longest."""
        out, wait, new = [], [], {}

        def flush() -> None:
            names = list(new)
            for token, n in zip(names, self.count(names).tolist()):
                new[token] = n
            for i, words in wait:
                out[i] += sum(new[w] * n for w, n in words)
            self.kept.update(new)
            wait.clear()
            new.clear()

        for text in texts:
            out.append(0)
            if not text:
                continue
            missing = []
            for token, n in Counter(self.pre_tokens(text)).items():
                known = self.kept.get(token)
                if known is not None:
                    out[-1] += n * known
                elif len(token) > LONG:
                    out[-1] += n * int(self.count(self._cut(token)).sum())
                else:
                    new.setdefault(token, 0)
                    missing.append((token, n))
            if missing:
                wait.append((len(out) - 1, missing))
            if len(new) > 20_000:
                flush()
            if len(self.kept) > KEPT:
                self.kept.clear()
        if new:
            flush()
        return out


_mergers: dict[str, RankMerger] = {}


def merger(model_file: str) -> RankMerger:
    """One merger for each model and worker process."""
    if model_file not in _mergers:
        _mergers[model_file] = RankMerger(model_file)
    return _mergers[model_file]


def count_tokens(text: Column, model_file: str) -> Column:
    """Number of tokens of a text column; ``model_file`` must lie at the same path on every executor."""

    @F.pandas_udf("long")
    def counted(s: pd.Series) -> pd.Series:
        return pd.Series(merger(model_file).count_texts([t or "" for t in s]), dtype="int64")

    return counted(text)


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row; there is no shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), count_tokens(text, model_file).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
