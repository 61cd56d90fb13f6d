"""Periodic runs of words, found with an enhanced suffix array.

Words are runs of bytes without ASCII white space.  A *run* is a stretch of
consecutive words with smallest period q (words q apart are equal) that no
neighbouring word extends, of at least ``least_words`` words and
``least_periods`` periods.  Collapsing drops every word that a run holds
after its first q words.

The texts of a block of about ``BLOCK`` words (always whole texts) are strung
together, each with its own end mark, and sorted by prefix doubling; the ranks
of every doubling answer how far two places agree, forwards and backwards.
From the suffix array, its inverse (ISA) and the common prefixes (LCP):

* every LCP interval of depth d is cut into its children where the LCP is d;
* for every suffix i of all children but the largest, i+d and i-d are looked
  up in the ISA: if one lies in the interval and the words after the two
  copies differ, a square with period d ends there and cannot go on
  (branching tandem repeat);
* rotating the square to the left as far as words d apart agree gives the
  whole run.  Periods that are multiples give the same stretch: the smallest
  stays.

Only the smaller children are listed, so the work is n log n, and no tree is
built.  A text is searched by itself in one task; nothing is shuffled.

Edge cases: null and blank texts have no words and no runs, and collapse to
an empty text; repeated rows are searched each; a very long text is a block
of its own, with memory in proportion to its words; an empty table gives an
empty result.  All input columns are kept, one whose name is that of an added
column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import add_columns

LEAST_WORDS = 24
LEAST_PERIODS = 3
BLOCK = 1 << 17
ADDED = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, strongest struct<start:bigint,length:bigint,period:bigint>, collapsed string"
_PORTION = 1 << 18


class EnhancedSuffixArray:
    """Suffix array, ranks and common prefixes of a sequence of numbers whose
    last one is its only greatest."""

    def __init__(self, symbols: np.ndarray):
        self.symbols, self.n = symbols, len(symbols)
        self.order = np.argsort(symbols, kind="stable")
        held = symbols[self.order]
        self.ranks = [self._ranked(np.concatenate(([True], held[1:] != held[:-1])))]
        step = 1
        while True:
            rank = self.ranks[-1]
            sorted_rank = rank[self.order]
            more = sorted_rank[1:] == sorted_rank[:-1]
            tied = np.flatnonzero(np.concatenate((more, [False])) | np.concatenate(([False], more)))
            if not len(tied):
                break
            # Tied suffixes agree on ``step`` symbols, so none of them ends there.
            at = self.order[tied]
            key = sorted_rank[tied].astype(np.int64) * self.n + rank[at + step]
            by = np.argsort(key, kind="stable")
            self.order[tied], key = at[by], key[by]
            fresh = np.ones(self.n, bool)
            fresh[tied[1:]] = (key[1:] != key[:-1]) | (tied[1:] != tied[:-1] + 1)
            self.ranks.append(self._ranked(fresh))
            step *= 2
        self.place = self.ranks[-1]

    def _ranked(self, fresh: np.ndarray) -> np.ndarray:
        rank = np.empty(self.n, np.int32)
        rank[self.order] = np.maximum.accumulate(np.where(fresh, np.arange(self.n), 0))
        return rank

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from ``a`` and ``b`` on are equal."""
        size = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 2, -1, -1):
            same = np.flatnonzero(self.ranks[level][a + size] == self.ranks[level][b + size])
            size[same] += 1 << level
        return size

    def agree_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before ``a`` and ``b`` (a < b) are equal."""
        size = np.zeros(len(a), np.int64)
        for level in range(len(self.ranks) - 2, -1, -1):
            step = 1 << level
            inside = np.flatnonzero(a - size >= step)
            rank = self.ranks[level]
            same = inside[rank[a[inside] - size[inside] - step] == rank[b[inside] - size[inside] - step]]
            size[same] += step
        return size

    def common(self) -> np.ndarray:
        """Common prefix of each suffix and the one before it, in order."""
        shared = np.zeros(self.n, np.int64)
        shared[1:] = self.agree(self.order[:-1], self.order[1:])
        return shared

    def intervals(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Children of all LCP intervals of depth one or more, the largest of
        each left out: first and last place of the child, depth, first and
        last place of the interval."""
        shared = self.common()
        split = np.flatnonzero(shared > 0)
        depth = shared[split]
        left, right = _reach(shared, split, depth)
        # Cuts of one interval lie side by side once sorted by its first place.
        by = np.lexsort((split, -depth, left))
        split, depth, left, right = split[by], depth[by], left[by], right[by]
        start = np.concatenate(([True], (left[1:] != left[:-1]) | (depth[1:] != depth[:-1]))) if len(split) else np.empty(0, bool)
        first = np.flatnonzero(start)
        # A child begins at each cut, and one at the interval's first place.
        ends_next = np.append(start[1:], [True] * bool(len(split)))
        last = np.where(ends_next, right, np.append(split[1:], 0) - 1)
        low = np.concatenate((left[first], split))
        high = np.concatenate((split[first] - 1, last))
        own = np.concatenate((np.arange(len(first)), np.cumsum(start) - 1))
        big = np.lexsort((low - high, own))
        lead = np.concatenate(([True], own[big][1:] != own[big][:-1])) if len(big) else np.empty(0, bool)
        small = big[~lead]
        of = first[own[small]]
        return low[small], high[small], depth[of], left[of], right[of]

    def squares(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and period of every branching tandem repeat."""
        low, high, depth, left, right = self.intervals()
        size = high - low + 1
        total = np.cumsum(size)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        a = 0
        while a < len(size):
            # Portions of children; a large child is a portion of its own.
            b = max(a + 1, int(np.searchsorted(total, total[a] - size[a] + _PORTION, side="right")))
            child = np.repeat(np.arange(a, b), size[a:b])
            place = np.arange(len(child)) - np.repeat(total[a:b] - size[a:b] - (total[a] - size[a]), size[a:b]) + low[child]
            at, d, lo, hi = self.order[place], depth[child], left[child], right[child]
            for first, other in ((at, at + d), (at - d, at - d)):
                ok = other >= 0
                rank = self.place[np.where(ok, other, 0)]
                ok &= (rank >= lo) & (rank <= hi)
                start, period = first[ok], d[ok]
                branch = self.symbols[start + period] != self.symbols[start + 2 * period]
                found.append((start[branch], period[branch]))
            a = b
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        start, period = (np.concatenate(x) for x in zip(*found, strict=True))
        both = np.unique(np.stack([start, period]), axis=1)
        return both[0], both[1]

    def runs(self, least_words: int, least_periods: int) -> np.ndarray:
        """Rows of start, length, smallest period, by start and period."""
        start, period = self.squares()
        end = start + 2 * period
        start = start - self.agree_before(start, start + period)
        ok = end - start >= np.maximum(least_words, least_periods * period)
        start, end, period = start[ok], end[ok], period[ok]
        by = np.lexsort((period, end, start))
        start, end, period = start[by], end[by], period[by]
        least = np.concatenate(([True], (start[1:] != start[:-1]) | (end[1:] != end[:-1]))) if len(start) else np.empty(0, bool)
        rows = np.stack([start, end - start, period], axis=1)[least]
        return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _reach(shared: np.ndarray, split: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the widest interval around each cut in which
    no common prefix is under ``depth``."""
    low, high = [shared], [shared]
    span = 1
    while 2 * span < len(shared):
        # Least of ``2 * span`` values up to, and from, every place on.
        up, down = low[-1].copy(), high[-1].copy()
        up[span:] = np.minimum(up[span:], low[-1][:-span])
        up[:span] = 0
        down[:-span] = np.minimum(down[:-span], high[-1][span:])
        down[-span:] = 0
        low.append(up)
        high.append(down)
        span *= 2
    left, right = split.copy(), split.copy()
    for level in range(len(low) - 1, -1, -1):
        step = 1 << level
        some = left >= step
        some[some] = low[level][left[some] - 1] >= depth[some]
        left[some] -= step
        some = right + step < len(shared)
        some[some] = high[level][right[some] + 1] >= depth[some]
        right[some] += step
    return left - 1, right


def find_runs(texts: list[list[bytes]], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each sequence of words."""
    number: dict[bytes, int] = {}
    symbols: list[int] = []
    for i, words in enumerate(texts):
        symbols.extend([number.setdefault(w, len(number)) for w in words])
        symbols.append(-1 - i)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(symbols) == len(texts):
        return found
    # End marks: one for each text, above all words.
    whole = np.array(symbols, np.int64)
    whole = np.where(whole < 0, len(number) - 1 - whole, whole)
    sizes = np.fromiter((len(w) + 1 for w in texts), np.int64, len(texts))
    begin = np.cumsum(sizes) - sizes
    rows = EnhancedSuffixArray(whole).runs(least_words, least_periods)
    own = np.searchsorted(begin, rows[:, 0], side="right") - 1
    rows[:, 0] -= begin[own]
    for text, row in zip(own.tolist(), rows.tolist(), strict=True):
        found[text].append(tuple(row))
    return found


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words left, joined by one space."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _blocks(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        words = text.split() if text else []
        if held and size + len(words) > BLOCK:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words) + 1
    if held:
        yield held


def collapse_runs(docs: DataFrame, text_col: str = "text", least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """``docs`` with ``n_words``, all ``runs`` (by start and period), the
    ``strongest`` of them (null if none) and the ``collapsed`` text."""

    def fill(texts: list[bytes | None]) -> list[list]:
        sizes, runs, best, left = [], [], [], []
        for block in _blocks(texts):
            for words, own in zip(block, find_runs(block, least_words, least_periods), strict=True):
                sizes.append(len(words))
                runs.append(own)
                best.append(strongest(own))
                left.append(collapse(words, own).decode("utf-8", "replace"))
        named = [None if b is None else dict(zip(("start", "length", "period"), b, strict=True)) for b in best]
        return [sizes, [[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], named, left]

    taken = {c.lower() for c in docs.columns}
    name = next(n for n in ("raw", *(f"raw_{i}" for i in range(len(taken) + 1))) if n not in taken)
    return add_columns(docs.withColumn(name, F.col(f"`{text_col}`").cast("binary")), ADDED, fill, name).drop(name)
