"""Sliding histograms for moving medians and modes: a window that moves by a column gains and loses one pixel a row.

A block's values become ranks. For every row of the block a histogram of its window's ranks is kept in two levels, coarse and fine, and all
rows move by a column at once, so a step costs as many updates as the window has rows, not pixels.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Histograms:
    """Counts of ranks below ``size`` for ``rows`` windows."""

    def __init__(self, rows: int, size: int):
        self.step = max(1, int(np.sqrt(size)))
        self.fine = np.zeros((rows, -(-size // self.step), self.step), np.int32)
        self.coarse = np.zeros(self.fine.shape[:2], np.int32)
        self.row = np.arange(rows)

    def add(self, row: np.ndarray, rank: np.ndarray, by: int) -> None:
        np.add.at(self.coarse, (row, rank // self.step), by)
        np.add.at(self.fine, (row, rank // self.step, rank % self.step), by)

    def counted(self) -> None:
        """To be called after a step, before the questions below."""
        self.sums = np.cumsum(self.coarse, axis=1)

    def at(self, k: np.ndarray) -> np.ndarray:
        """Rank of each window's k-th value, from 0; the window must have it."""
        part = np.minimum((self.sums <= k[:, None]).sum(axis=1), self.coarse.shape[1] - 1)
        before = np.where(part > 0, self.sums[self.row, part - 1], 0)
        inside = np.cumsum(self.fine[self.row, part], axis=1)
        return part * self.step + (inside <= (k - before)[:, None]).sum(axis=1)

    def below(self, rank: np.ndarray) -> np.ndarray:
        """Number of each window's values of a lower rank."""
        part, rest = np.minimum(rank // self.step, self.coarse.shape[1] - 1), rank - np.minimum(rank // self.step, self.coarse.shape[1] - 1) * self.step
        before = np.where(part > 0, self.sums[self.row, part - 1], 0)
        inside = np.cumsum(self.fine[self.row, part], axis=1)
        return before + np.where(rest > 0, inside[self.row, np.minimum(rest, self.step) - 1], 0)

    def fullest(self) -> np.ndarray:
        """The rank that each window has most often, the lowest of equals."""
        return self.fine.reshape(len(self.row), -1).argmax(axis=1)


def median(h: Histograms, n: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = lambda k: values[np.minimum(h.at(k), len(values) - 1)]
    return (at((n - 1) // 2) + at(n // 2)) / 2


def mode(h: Histograms, n: np.ndarray, values: np.ndarray) -> np.ndarray:
    return values[h.fullest()]


def mode_median(bin_size: float) -> Callable:
    """Median of the values in the fullest bin and the two beside it."""

    def of(h: Histograms, n: np.ndarray, values: np.ndarray) -> np.ndarray:
        values, beyond = values[:-1], values[-1:]
        bins = np.floor(values / bin_size)
        starts = np.flatnonzero(np.append(True, np.diff(bins) != 0))
        # counts of whole bins, from the counts of their ranks
        counts = np.add.reduceat(h.fine.reshape(len(n), -1)[:, : len(values)], starts, axis=1)
        top = bins[starts[counts.argmax(axis=1)]]
        low, high = np.searchsorted(bins, top - 1), np.searchsorted(bins, top + 1, "right")
        first = h.below(low)
        inside = h.below(high) - first
        values = np.append(values, beyond)
        at = lambda k: values[np.minimum(h.at(k), len(values) - 1)]
        return (at(first + np.maximum(inside - 1, 0) // 2) + at(first + inside // 2)) / 2

    return of


def sweep(grid: np.ndarray, reach: list[int], how: Callable) -> tuple[np.ndarray, np.ndarray]:
    """``how`` of the windows of a grid (NaN where there is nothing), and their numbers of values, for the places that are len(reach) // 2 from its edges.

    ``reach`` has the half width of each row of the window, from the top. Windows without values give NaN.
    """
    h = len(reach) // 2
    height, width = grid.shape[0] - 2 * h, grid.shape[1] - 2 * h
    there = np.isfinite(grid)
    values, ranks = np.unique(grid[there], return_inverse=True)
    rank = np.full(grid.shape, -1, np.int64)
    rank[there] = ranks
    out, many = np.full((height, width), np.nan), np.zeros((height, width), np.int64)
    if not len(values):
        return out, many
    hist, n = Histograms(height, len(values)), np.zeros(height, np.int64)
    rows = np.arange(height)

    def moved(offset: int, col: int, by: int) -> None:
        if 0 <= col < grid.shape[1]:
            found = rank[offset : offset + height, col]
            have = found >= 0
            hist.add(rows[have], found[have], by)
            n[have] += by

    for j in range(width):
        for offset, half in enumerate(reach):
            if j == 0:
                for col in range(h - half, h + half + 1):
                    moved(offset, col, 1)
            else:
                moved(offset, j + h + half, 1)
                moved(offset, j + h - half - 1, -1)
        hist.counted()
        some = n > 0
        # windows without values ask for rank 0 of nothing and are left out
        got = how(hist, np.maximum(n, 1), np.append(values, np.nan))
        out[some, j], many[:, j] = got[some], n
    return out, many
