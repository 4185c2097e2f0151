"""Order of suffixes in a text of bounded size by a difference cover sample, one suffix bucket at a time.

The sample takes the positions whose residue modulo the period lies in a
difference cover; its suffixes are ranked first (to a bounded depth) by doubling.
Suffixes to be sorted come in buckets of one residue, so in a bucket the next
sampled position is the same distance ahead for all. They are compared by the
bytes up to there; longer ties fall to the sample's ranks. Memory is the text,
the sample's ranks and one bucket's keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: A perfect difference set: every residue modulo 31 is a difference of two of its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)


def _words(text: np.ndarray, at: np.ndarray, n: int) -> list[np.ndarray]:
    """The n bytes from each position as big-endian numbers of up to 8 bytes, first ones first."""
    out = []
    for i in range(0, n, 8):
        m = min(8, n - i)
        x = np.zeros(len(at), np.uint64)
        for j in range(m):
            x = (x << np.uint64(8)) | text[at + (i + j)].astype(np.uint64)
        out.append(x)
    return out


def _ranks(columns: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of rows by several columns."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        s = c[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


class CoverSample:
    """Ranks of the sampled suffixes by their first PERIOD, 2 PERIOD, ... bytes, up to half of ``depth`` at least.

    ``text`` holds ``size`` bytes and ``2 * depth`` bytes of padding.
    """

    def __init__(self, text: np.ndarray, size: int, depth: int):
        self.text, self.depth = text, depth
        residue = np.zeros(PERIOD, bool)
        residue[list(COVER)] = True
        place = np.flatnonzero(residue[np.arange(size) % PERIOD])
        self.number = np.full(size + 2 * depth, -1, np.int64)
        self.number[place] = np.arange(len(place))
        self.ranks = [(PERIOD, _ranks(_words(text, place, PERIOD)))]
        while 2 * self.ranks[-1][0] <= depth:
            have, rank = self.ranks[-1]
            ahead = self.number[place + have]  # a multiple of the period ahead, so sampled too
            self.ranks.append((2 * have, _ranks([rank, np.where(ahead >= 0, rank[ahead], -1)])))
        self.gap = [next(d for d in range(PERIOD) if residue[(r + d) % PERIOD]) for r in range(PERIOD)]

    def equal_runs(self, at: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Sort the suffixes ``at``, cut to ``depth`` bytes, bucket by bucket; yields (order, flag: equal to the one before)."""
        residue = at % PERIOD
        for r in np.unique(residue):
            own = np.flatnonzero(residue == r)
            pos, done = at[own], self.gap[r]
            keys = [bucket[own], *_words(self.text, pos, done)]
            for have, rank in reversed(self.ranks):  # the rest in ranked pieces, then the bytes that are left
                while self.depth - done >= have:
                    keys.append(rank[self.number[pos + done]])
                    done += have
            keys += _words(self.text, pos + done, self.depth - done)
            order = np.lexsort(keys[::-1])
            same = np.zeros(len(order), bool)
            same[1:] = True
            for k in keys:
                s = k[order]
                same[1:] &= s[1:] == s[:-1]
            yield own[order], same
