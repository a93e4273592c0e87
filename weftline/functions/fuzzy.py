"""Token-set similarity of names.

Both texts are split into sets of tokens. Without tokens on a side the score is
0. If they share tokens and one side has no others it is 100. Otherwise it is
the best of three comparisons of joined, sorted tokens: shared plus rest against
shared plus rest, and shared alone against either. Two texts compare as
100 * (1 - d / (len1 + len2)), d the insertions and deletions between them.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@functools.lru_cache(1 << 16)
def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits of an integer."""
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & at.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


#: Texts of a batch up to this length are rows of a table of characters, with bits in a machine word.
SHORT = 32
#: Texts of one such table.
SLICE = 4_096


def common_lengths(a: pd.Series, b: pd.Series) -> np.ndarray:
    """Length of the longest common subsequence of each two texts: short ones all at once, a character's column at a time."""
    a, b = a.tolist(), b.tolist()
    size = np.array([len(t) for t in a], dtype="int64"), np.array([len(t) for t in b], dtype="int64")
    short = (size[0] <= SHORT) & (size[1] <= SHORT) & np.array(["\0" not in x and "\0" not in y for x, y in zip(a, b)], dtype=bool)
    out = np.zeros(len(a), dtype="int32")
    for k in np.flatnonzero(~short):
        out[k] = _common(a[k], b[k])
    which = np.flatnonzero(short)
    for part in np.split(which, range(SLICE, len(which), SLICE)):
        if len(part):
            out[part] = _columns([a[k] for k in part], [b[k] for k in part], size[0][part])
    return out


def _columns(a: list[str], b: list[str], size: np.ndarray) -> np.ndarray:
    # a text's end is filled with zeros, which are no character
    def table(texts: list[str]) -> np.ndarray:
        wide = np.array(texts)
        return np.ascontiguousarray(wide.view("uint32").reshape(len(texts), -1).T) if wide.itemsize else np.zeros((0, len(texts)), dtype="uint32")

    left, right = table(a), table(b)
    full = ((np.uint64(1) << size.astype("uint64")) - np.uint64(1)).astype("uint32")
    row = full.copy()
    for c in right:
        at = np.zeros(len(row), dtype="uint32")
        for k, d in enumerate(left):
            at |= ((d == c) & (d != 0)).astype("uint32") << np.uint32(k)
        u = row & at
        row = ((row + u) | (row - u)) & full
    return size - np.bitwise_count(row)


def _ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * _common(a, b) / total if total else 100.0


def score(a: str | None, b: str | None) -> float:
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    shared, dx, dy = sorted(x & y), sorted(x - y), sorted(y - x)
    if shared and not (dx and dy):
        return 100.0
    left, right = " ".join([*shared, *dx]), " ".join([*shared, *dy])
    best = _ratio(left, right)
    if shared:
        s = " ".join(shared)
        best = max(best, _ratio(s, left), _ratio(s, right))
    return best


#: Texts with more tokens or characters are compared one by one.
TOKENS, CHARS = 8, 60


def _common_near(left: np.ndarray, right: np.ndarray, size: np.ndarray, most: int) -> np.ndarray:
    """Length of the longest common subsequence of texts in rows of codes, filled with zeros: of those that more than ``most`` insertions and deletions part it may come out shorter, as no character meets one that is further off."""
    kind = np.uint32 if left.shape[1] <= SHORT else np.uint64
    out = np.zeros(len(left), dtype="int64")
    for at in range(0, len(left), SLICE):
        here = slice(at, at + SLICE)
        a, b = np.ascontiguousarray(left[here].T), np.ascontiguousarray(right[here].T)
        b = np.where(b == 0, np.iinfo(b.dtype).max, b)
        full = ((np.uint64(1) << size[here].astype("uint64")) - np.uint64(1)).astype(kind)
        row = full.copy()
        for n, c in enumerate(b):
            met = np.zeros(len(row), dtype=kind)
            for k in range(max(0, n - most), min(len(a), n + most + 1)):
                met |= (a[k] == c).astype(kind) << kind(k)
            u = row & met
            row = ((row + u) | (row - u)) & full
        out[here] = size[here] - np.bitwise_count(row)
    return out


class Compared:
    """Which of many texts are close, pair by pair: what a comparison reads is worked out once for each text, most pairs go by bits, and only what is left has its common length counted.

    The bits are a text's characters, numbered among their equals, and its tokens; two texts' sets differ by no more
    than the insertions and deletions between them, and of a text that shared tokens cover, one of the longest is shared.
    """

    def __init__(self, texts: list[str], threshold: float):
        self.texts, self.threshold, self.share = texts, threshold, threshold / 100
        self.tokens = [sorted(set(t.split())) for t in texts]
        self.count = np.array([len(t) for t in self.tokens], dtype="int64")
        joined = [" ".join(t) for t in self.tokens]
        self.size = np.array([len(t) for t in joined], dtype="int64")
        self.odd = (self.count > TOKENS) | (self.size > CHARS) | np.array(["\0" in t for t in joined], dtype=bool)
        plain = [[] if o else t for t, o in zip(self.tokens, self.odd)]
        # tokens as numbers and lengths, in rows; -1 is none
        known: dict[str, int] = {}
        flat = np.array([known.setdefault(t, len(known)) for ts in plain for t in ts], dtype="int64")
        long = np.array([len(t) for t in known], dtype="int64")
        self.codes = np.array([*known, "-"]).view("uint32").reshape(len(known) + 1, -1)[:-1]
        self.codes = self.codes.astype("uint8") if self.codes.max(initial=0) < 255 else self.codes
        n = np.array([len(t) for t in plain], dtype="int64")
        there = np.arange(int(n.max(initial=1))) < n[:, None]
        self.ids = np.full(there.shape, -1, dtype="int64")
        self.ids[there] = flat
        self.lengths = np.zeros(there.shape, dtype="int64")
        self.lengths[there] = long[flat]
        order = np.argsort(-self.lengths, axis=1, kind="stable")
        down = np.take_along_axis(self.lengths, order, 1)
        first = np.cumsum(down + 1, axis=1) - down - 1 <= self.size[:, None] * (2 * (1 - self.share) / (2 - self.share)) + 1e-9
        bit = lambda ids, at: np.bitwise_or.reduce(np.where(at & (ids >= 0), np.uint64(1) << (ids & 63).astype("uint64"), np.uint64(0)), axis=1)
        self.all, self.longest = bit(self.ids, there), bit(np.take_along_axis(self.ids, order, 1), first)
        self.chars = self._characters(["" if o else t for t, o in zip(joined, self.odd)])

    @staticmethod
    def _characters(texts: list[str]) -> list[np.ndarray]:
        wide = np.array([*texts, "-"])
        codes = np.sort(wide.view("uint32").reshape(len(wide), -1)[:-1], axis=1)
        at = np.arange(codes.shape[1])
        begins = np.where(np.diff(codes, axis=1, prepend=np.uint32(0xFFFFFFFF)) != 0, at, 0)
        turn = at - np.maximum.accumulate(begins, axis=1)
        mixed = (codes.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)) ^ (turn.astype("uint64") * np.uint64(0xC2B2AE3D27D4EB4F))
        where = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(57)
        one = np.where(codes > 0, np.uint64(1) << (where & np.uint64(63)), np.uint64(0))
        return [np.bitwise_or.reduce(np.where(where >> np.uint64(6) == half, one, np.uint64(0)), axis=1) for half in (0, 1)]

    @staticmethod
    def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of a's tokens are among b's."""
        same = np.zeros(a.shape, dtype=bool)
        for k in range(b.shape[1]):
            same |= a == b[:, k : k + 1]
        return same & (a >= 0)

    def _rests(self, i: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts without the tokens that are shared, in rows of codes, and their lengths."""
        ids, lengths = self.ids[i], self.lengths[i]
        kept = (ids >= 0) & ~shared
        wide = self.codes.shape[1]
        out = np.zeros((len(i), int(self.size[i].max()) + wide + 1), dtype=self.codes.dtype)
        end = np.zeros(len(i), dtype="int64")
        for k in range(ids.shape[1]):
            rows = np.flatnonzero(kept[:, k])
            later = rows[end[rows] > 0]
            out[later, end[later]] = ord(" ")
            end[later] += 1
            out[rows[:, None], end[rows, None] + np.arange(wide)] = self.codes[ids[rows, k]]
            end[rows] += lengths[rows, k]
        return out[:, : int(end.max())], end

    def close(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each pair of places in texts, whether its score reaches the threshold."""
        out = np.zeros(len(i), dtype=bool)
        total = self.size[i] + self.size[j]
        differ = sum(np.bitwise_count(half[i] ^ half[j]).astype("int64") for half in self.chars)
        alike = differ <= (1 - self.share) * total + 1e-9
        may = alike | ((self.longest[i] & self.all[j]) != 0) | ((self.longest[j] & self.all[i]) != 0)
        odd = self.odd[i] | self.odd[j]
        for k in np.flatnonzero(odd):
            out[k] = score(self.texts[i[k]], self.texts[j[k]]) >= self.threshold
        at = np.flatnonzero(may & ~odd & (self.count[i] > 0) & (self.count[j] > 0))
        if not len(at):
            return out
        i, j, total = i[at], j[at], total[at]
        a, b = self.ids[i], self.ids[j]
        same = self._same(a, b)
        n = same.sum(axis=1)
        least = np.minimum(self.size[i], self.size[j])
        shared = (self.lengths[i] * same).sum(axis=1) + np.maximum(n - 1, 0)
        begin = np.where(n > 0, shared + 1, 0)
        held = (n > 0) & (n == np.minimum(self.count[i], self.count[j]))
        sure = held | ((n > 0) & (200.0 * shared / (shared + least) >= self.threshold))
        # the longest common subsequence is as long as it has to be only where characters are alike
        left = np.flatnonzero(~sure & alike[at] & (200.0 * least / total >= self.threshold))
        if len(left):
            again = self._same(b[left], a[left])
            (x, size), (y, _) = self._rests(i[left], same[left]), self._rests(j[left], again)
            most = int(((1 - self.share) * total[left] + 1e-9).max())
            sure[left] = 200.0 * (begin[left] + _common_near(x, y, size, most)) / total[left] >= self.threshold
        out[at] = sure
        return out


@F.pandas_udf(T.DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([score(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.IntegerType())
def common_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Length of the longest common subsequence of two texts."""
    return pd.Series(common_lengths(a, b), dtype="int32")
