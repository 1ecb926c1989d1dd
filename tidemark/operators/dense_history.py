"""Exact median and deviations for blocks with very many rows.

A list per row costs a block's square. Here the values of one block are indexed once (a
wavelet matrix over their ranks), and each distinct window is answered from the index,
many together, in about ``n log^2 n``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class Sums:
    """Sums of stretches, added up from pair sums inside them.

    Differences of running sums would let a huge value outside a stretch spoil its sum.
    """

    def __init__(self, values: np.ndarray):
        self.levels = [values.astype("float64")]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            self.levels.append(np.concatenate([below, np.zeros(len(below) % 2)]).reshape(-1, 2).sum(axis=1))

    def of(self, lo, hi):
        lo, hi, total = lo.copy(), hi.copy(), np.zeros(len(lo))
        for level in self.levels:
            padded = np.append(level, 0.0)
            left, right = (lo < hi) & (lo % 2 == 1), (lo < hi) & (hi % 2 == 1)
            total += np.where(left, padded[np.minimum(lo, len(level))], 0.0)
            lo = (lo + left) // 2
            total += np.where(right, padded[np.maximum(hi - 1, 0)], 0.0)
            hi = hi // 2
        return total


class Ranges:
    """Order statistics of any stretch ``values[lo:hi]``, for arrays of stretches.

    Sums are of distances from a value in the middle of all, ``centre``, which are smaller. There is a
    level for each bit of the ranks of distinct values; sums are kept of the order behind a level, in
    which the lower and the higher values of a stretch are stretches again.
    """

    def __init__(self, values: np.ndarray):
        self.sorted, rank = np.unique(values, return_inverse=True)
        self.centre = self.sorted[np.partition(rank, len(rank) // 2)[len(rank) // 2]]
        self.away = self.sorted - self.centre
        self.levels = []
        for bit in reversed(range(max(1, int(len(self.sorted) - 1).bit_length()))):
            low = (rank >> bit) & 1 == 0
            before = np.concatenate([[0], np.cumsum(low)])
            rank = np.concatenate([rank[low], rank[~low]])
            self.levels.append((bit, before, Sums(self.away[rank])))

    def _find(self, lo, hi, k, lower=None, upper=None):
        """The rank of the value with ``k`` smaller ones before it in its stretch, how many equal ones are
        before it, and how many there are. Sums of smaller and larger values are added to ``lower`` and ``upper``."""
        rank = np.zeros(len(lo), dtype=np.int64)
        for bit, before, sums in self.levels:
            from_low, to_low = before[lo], before[hi]
            from_high, to_high = before[-1] + lo - from_low, before[-1] + hi - to_low
            high = k >= to_low - from_low
            if lower is not None:
                at = np.flatnonzero(high)
                lower[at] += sums.of(from_low[at], to_low[at])
            if upper is not None:
                at = np.flatnonzero(~high)
                upper[at] += sums.of(from_high[at], to_high[at])
            k = np.where(high, k - (to_low - from_low), k)
            rank |= high.astype(np.int64) << bit
            lo, hi = np.where(high, from_high, from_low), np.where(high, to_high, to_low)
        return rank, k, hi - lo

    def kth(self, lo, hi, k):
        """The value with ``k`` smaller ones before it in its stretch."""
        return self.sorted[self._find(lo, hi, k)[0]]

    def median(self, lo, hi):
        n = hi - lo
        return (self.kth(lo, hi, (n - 1) // 2) + self.kth(lo, hi, n // 2)) / 2

    def mean_dev(self, lo, hi, median):
        n = hi - lo
        half = (n + 1) // 2
        below, above = np.zeros(len(lo)), np.zeros(len(lo))
        rank, before, _ = self._find(lo, hi, half - 1, lower=below)
        below += (before + 1) * self.away[rank]
        alone = half >= n
        rank, before, equal = self._find(lo, hi, np.where(alone, 0, half), upper=above)
        above = np.where(alone, 0.0, above + (equal - before) * self.away[rank])
        middle = median - self.centre
        return (middle * half - below + above - middle * (n - half)) / n

    def mad(self, lo, hi, median):
        """The median distance from the median.

        Distances grow to both sides of the middle; a search finds how many of the smaller
        half lie on the lower side. With an even number the next distance counts too.
        """
        n = hi - lo
        half, k = (n + 1) // 2, (n - 1) // 2

        def lower(i):
            return median - self.kth(lo, hi, np.clip(half - 1 - i, 0, n - 1))

        def upper(j):
            return self.kth(lo, hi, np.clip(half + j, 0, n - 1)) - median

        first, last = np.maximum(0, k + 1 - (n - half)), np.minimum(k + 1, half)
        while (first < last).any():
            middle = (first + last) // 2
            more = (first < last) & (lower(middle) < upper(k - middle))
            last = np.where(more | (first >= last), last, middle)
            first = np.where(more, middle + 1, first)
        taken = k + 1 - first
        low = np.maximum(np.where(first > 0, lower(first - 1), -np.inf),
                         np.where(taken > 0, upper(taken - 1), -np.inf))
        high = np.minimum(np.where(first < half, lower(first), np.inf),
                          np.where(taken < n - half, upper(taken), np.inf))
        return np.where(n % 2 == 1, low, (low + high) / 2)


def window_stats(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, at_once: int = 200_000):
    """Length, median and both deviations of each stretch. Equal stretches, as of rows of one time, are answered
    once, and only so many together that a step's arrays stay small."""
    ranges, width = Ranges(values), len(values) + 1
    asked, back = np.unique(lo * width + hi, return_inverse=True)
    found = np.empty((3, len(asked)))
    for i in range(0, len(asked), at_once):
        lo_, hi_ = np.divmod(asked[i:i + at_once], width)
        median = ranges.median(lo_, hi_)
        found[:, i:i + at_once] = median, ranges.mad(lo_, hi_, median), ranges.mean_dev(lo_, hi_, median)
    return hi - lo, *found[:, back]


def block_stats(block: pa.Table, span: int, min_samples: float, ties: list[str]) -> pa.Table:
    """The own rows of one block of one key that have enough history, with its statistics."""
    block = block.sort_by([("_us", "ascending"), *[(t, "ascending") for t in ties]])
    us = block["_us"].to_numpy()
    values = block["_value"].to_numpy(zero_copy_only=False).astype("float64")
    known = np.isfinite(values)
    lo = np.searchsorted(us[known], us - span, side="left")
    # The rows before a row: all earlier times, and with an order those before it at its own.
    hi = np.cumsum(known) - known if ties else np.searchsorted(us[known], us, side="left")
    asked = np.flatnonzero(block["_own"].to_numpy(zero_copy_only=False) & (hi - lo > min_samples) & (hi > lo))
    lo, hi = lo[asked], hi[asked]
    picked = block.take(pa.array(asked)).drop_columns(["_us", "_value", "_own", *ties])
    if len(asked):
        stats = window_stats(values[known], lo, hi)
    else:
        stats = (np.array([]),) * 4
    for name, kind, column in zip(("hist_n", "hist_median", "hist_mad", "hist_mean_dev"),
                                  (pa.int32(), pa.float64(), pa.float64(), pa.float64()), stats):
        picked = picked.append_column(name, pa.array(column, type=kind, from_pandas=True, safe=False)
                                      if len(asked) else pa.array([], type=kind))
    return picked
