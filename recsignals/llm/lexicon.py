"""A minimal acyclic transducer from words to id sequences, as flat arrays in one file that workers memory-map.

States share suffixes: words are added in byte order, and a state whose outgoing
arcs, outputs and finality equal those of an earlier one is replaced by it. Ids
stand as far towards the root as words with a common prefix allow; what a word
that is a prefix of others lacks at its end is the final output of its state.

The arcs of all states lie interleaved in one table (row displacement): the arc
of state s for byte b is cell ``base[s] + b`` if ``owner`` there says s.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from recsignals.llm.textbuf import segments

ROOT = 0


def _common(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class _Builder:
    """Words in byte order -> states as (final output or None, ((byte, output, target), ...))."""

    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.last = b""
        # The path of the last word, not yet registered: per state its finished arcs, its final output, and the open arc.
        self.arcs: list[list] = [[]]
        self.final: list[tuple | None] = [None]
        self.open: list[tuple[int, tuple]] = []

    def _close(self, depth: int) -> None:
        """Register the states below ``depth`` of the last word's path."""
        while len(self.open) > depth:
            key = (self.final.pop(), tuple(self.arcs.pop()))
            at = self.register.get(key)
            if at is None:
                at = self.register[key] = len(self.states)
                self.states.append(key)
            byte, out = self.open.pop()
            self.arcs[-1].append((byte, out, at))

    def add(self, word: bytes, ids: tuple) -> None:
        shared = _common(self.last, word)
        self._close(shared)
        for d in range(shared):  # ids that the word doesn't share move down
            byte, out = self.open[d]
            n = _common(out, ids)
            ids, rest = ids[n:], out[n:]
            if rest:
                self.open[d] = (byte, out[:n])
                self.arcs[d + 1] = [(b, rest + o, t) for b, o, t in self.arcs[d + 1]]
                if self.final[d + 1] is not None:
                    self.final[d + 1] = rest + self.final[d + 1]
                if d + 1 < len(self.open):
                    b, o = self.open[d + 1]
                    self.open[d + 1] = (b, rest + o)
        for b in word[shared:]:
            self.open.append((b, ids))
            ids = ()
            self.arcs.append([])
            self.final.append(None)
        self.final[-1] = ids
        self.last = word

    def finish(self) -> list[tuple]:
        """All states, the root first."""
        self._close(0)
        root = (self.final[0], tuple(self.arcs[0]))
        return [root, *self.states]


def compile_words(words: Iterable[tuple[bytes, Iterable[int]]], path: str) -> dict:
    """Write the transducer of (word, ids) pairs with distinct, non-empty words; returns its sizes."""
    b = _Builder()
    longest = 0
    for word, ids in sorted((w, tuple(i)) for w, i in words):
        b.add(word, ids)
        longest = max(longest, len(word))
    states = b.finish()
    pool, place = [], {}

    def put(out: tuple) -> tuple[int, int]:
        if out not in place:
            place[out] = len(pool)
            pool.extend(out)
        return place[out], len(out)

    # Registered states are numbered from 0; the root comes before them. Large states choose their place first.
    base = np.zeros(len(states), np.uint32)
    free, low, cells = np.ones(1 << 16, bool), 0, []
    for s in sorted(range(len(states)), key=lambda s: -len(states[s][1])):
        arcs = states[s][1]
        if not arcs:
            continue
        at, offsets = low, np.array([a[0] for a in arcs]) - arcs[0][0]
        while True:  # the first free cells, 1,024 at a time, that leave room for all arcs
            if len(free) < at + 2048:
                free = np.concatenate([free, np.ones(len(free), bool)])
            fits = free[at : at + 1024].copy()
            for o in offsets[1:]:
                fits &= free[at + o : at + o + 1024]
            hit = int(fits.argmax())
            if fits[hit] and at + hit >= arcs[0][0]:
                at += hit
                break
            at += max(1, min(1024, arcs[0][0] - at - hit)) if fits[hit] else 1024
        base[s] = at - arcs[0][0]
        for byte, out, target in arcs:
            free[base[s] + byte] = False
            cells.append((int(base[s]) + byte, s, target + 1, *put(out)))
        while not free[low]:
            low += int(free[low:].argmax()) or len(free) - low
            if low == len(free):
                free = np.concatenate([free, np.ones(len(free), bool)])
    final = [(0, 0, 0) if f is None else (1, *put(f)) for f, _ in states]
    size = int(base.max()) + 256
    owner, target, start, length = (np.zeros(size, np.uint32) for _ in range(4))
    owner[:] = 0xFFFFFFFF
    for cell, s, t, a, n in cells:
        owner[cell], target[cell], start[cell], length[cell] = s, t, a, n
    ends = np.array(final, np.uint32).reshape(-1, 3)
    arrays = [base, owner, target, start, length, *(np.ascontiguousarray(ends[:, j]) for j in range(3)), np.array(pool, np.uint32)]
    with open(path, "wb") as f:
        f.write(np.array([len(states), size, len(pool), longest], "<u8").tobytes())
        for a in arrays:
            f.write(a.astype("<u4").tobytes())
    return {"states": len(states), "arcs": len(cells), "cells": size, "ids": len(pool), "longest": longest}


class Lexicon:
    """A transducer file, memory-mapped; looks up many words at a time."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        states, cells, ids, self.longest = (int(x) for x in raw[:32].view("<u8"))
        at, found = 32, []
        for n in [states, cells, cells, cells, cells, states, states, states, ids]:
            found.append(raw[at : at + 4 * n].view("<u4"))
            at += 4 * n
        self.base, self.owner, self.target, self.start, self.length, self.final, self.final_start, self.final_length, self.pool = found

    def transduce(self, buf: np.ndarray, first: np.ndarray, end: np.ndarray, unseen) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of the words ``buf[first[i]:end[i]]``; ``unseen(i)`` gives those of a word that isn't in the lexicon, as an id array."""
        size = end - first
        # One slot per byte for its arc's output, and one per word for the final output.
        slot = np.concatenate(([0], np.cumsum(size + 1)))
        start, length = np.zeros(int(slot[-1]), np.int64), np.zeros(int(slot[-1]), np.int64)
        known = np.zeros(len(first), bool)
        live = np.flatnonzero((size > 0) & (size <= self.longest))
        state, step = np.full(len(live), ROOT, np.int64), 0
        while len(live):
            cell = self.base[state].astype(np.int64) + buf[first[live] + step]
            ok = self.owner[cell] == state
            live, cell = live[ok], cell[ok]
            start[slot[live] + step], length[slot[live] + step] = self.start[cell], self.length[cell]
            state = self.target[cell].astype(np.int64)
            step += 1
            over = size[live] == step
            done, last = live[over], state[over]
            is_word = self.final[last] == 1
            done, last = done[is_word], last[is_word]
            known[done] = True
            start[slot[done] + step], length[slot[done] + step] = self.final_start[last], self.final_length[last]
            live, state = live[~over], state[~over]
        rest, pool = np.flatnonzero(~known), self.pool
        if len(rest):
            length[segments(slot[rest], size[rest] + 1)] = 0
            added = [unseen(int(i)) for i in rest]
            counts = np.array([len(a) for a in added], np.int64)
            start[slot[rest]] = len(pool) + np.concatenate(([0], np.cumsum(counts)[:-1]))
            length[slot[rest]] = counts
            pool = np.concatenate([pool, *added])
        total = np.concatenate(([0], np.cumsum(length)))
        return pool[segments(start, length)], total[slot[1:]] - total[slot[:-1]]
