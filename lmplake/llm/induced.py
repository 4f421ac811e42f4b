"""Suffix sorting by external induced sorting, in bulk.

The suffixes of a byte shard are sorted by their first ``depth`` bytes, with the common
prefix (up to ``depth``) of neighbours:

1. suffixes are classified (S: smaller than the next one, L: larger), and the leftmost S
   positions (LMS) found;
2. the LMS substrings are sorted by one induction and named by their order;
3. the string of names, a third of the text, is sorted recursively: the names of pairs
   of neighbours are named again, each level doubling the reach, until names are unique
   or reach ``depth`` bytes;
4. from the sorted LMS suffixes, all L suffixes and then all S suffixes are induced: the
   suffixes are visited in order, and each visited suffix gives out its left neighbour as
   a tuple (first byte, order of arrival, common prefix), which a priority queue hands
   back in order. The common prefix of two tuples with the same first byte is one more
   than the least common prefix between the suffixes that gave them out, so it is carried
   along and never computed by comparing text.

The queue takes tuples in bulk, one array for all of a step; since arrivals for a byte
are already in order, it is a row of first-in-first-out lists by byte. It keeps up to
``memory`` tuples and spills the lists beyond to unnamed files (a task's own scratch, as
Spark's spill files are: never read by another task, gone with it), so a shard may be
far larger than memory; the arrays of a large shard are mapped to such files, too.
"""

from __future__ import annotations

import tempfile

import numpy as np

from lmplake.llm.common import U64, mix

SYMBOLS = 258  # 0: end of the shard, 1: end of a string, 2 + byte
MEMORY = 1 << 24


def scratch(n: int, dtype, memory: int = MEMORY) -> np.ndarray:
    """An array in memory, or mapped to an unnamed file when it is large."""
    if n <= 16 * memory:
        return np.empty(n, dtype)
    f = tempfile.TemporaryFile()
    f.truncate(n * np.dtype(dtype).itemsize)
    return np.memmap(f, dtype, "r+", shape=(n,))


class BulkQueue:
    """Tuples (position, common prefix) by first byte, in order of arrival."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.held = memory, 0
        self.lists: list[list] = [[] for _ in range(SYMBOLS)]
        self.files: dict[int, object] = {}
        self.spilled = 0

    def push(self, symbol: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.lists[symbol].append((pos, lcp))
        self.held += len(pos)
        if self.held > self.memory:
            for s in sorted(range(SYMBOLS), key=lambda s: -sum(len(p) for p, _ in self.lists[s]))[:8]:
                self._spill(s)

    def _spill(self, symbol: int) -> None:
        if not self.lists[symbol]:
            return
        f = self.files.get(symbol)
        if f is None:
            f = self.files[symbol] = tempfile.TemporaryFile()
        for pos, lcp in self.lists[symbol]:
            f.write((pos.astype(np.int64) << 8 | lcp).tobytes())
            self.held -= len(pos)
            self.spilled += len(pos)
        self.lists[symbol] = []

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples of a byte, oldest first."""
        parts, self.lists[symbol] = self.lists[symbol], []
        self.held -= sum(len(p) for p, _ in parts)
        f = self.files.pop(symbol, None)
        if f is not None:
            f.seek(0)
            both = np.frombuffer(f.read(), np.int64)
            f.close()
            parts = [(both >> 8, (both & 255).astype(np.uint8)), *parts]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])


class Induction:
    """One pass over the suffixes in (ascending or descending) order."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, depth: int, memory: int = MEMORY):
        self.text, self.wanted, self.depth = text, wanted, depth
        self.queue = BulkQueue(memory)
        self.least = np.zeros(SYMBOLS, np.int64)  # least common prefix since the last tuple of each byte

    def visit(self, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Visit suffixes in order, each with the common prefix with the one visited before."""
        if not len(pos):
            return
        left = pos - 1
        give = np.flatnonzero((left >= 0) & self.wanted[left])
        symbol = self.text[left[give]]
        order = np.argsort(symbol, kind="stable")
        give, symbol = give[order], symbol[order]
        cuts = np.flatnonzero(np.diff(symbol)) + 1
        total = int(lcp.min())
        was = self.least.copy()
        self.least = np.minimum(self.least, total)
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(give)]):
            if i == j:
                continue
            s, at = int(symbol[i]), give[i:j]
            starts = np.append(0, at + 1)
            mins = np.minimum.reduceat(lcp, starts[starts < len(lcp)])
            got = mins[:len(at)].astype(np.int64)
            got[0] = min(got[0], was[s])
            self.queue.push(s, left[at], np.minimum(got + 1, self.depth).astype(np.uint8))
            self.least[s] = int(mins[len(at)]) if len(mins) > len(at) else self.depth

    def bucket(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """Visit all queued suffixes of a byte, those that they give out themselves included."""
        pos, lcp = [], []
        while True:
            p, c = self.queue.pop(symbol)
            if not len(p):
                break
            if not pos:
                c[0] = 0  # the first of its byte
            pos.append(p)
            lcp.append(c)
            self.visit(p, c)
        if not pos:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate(pos), np.concatenate(lcp)


def induce(text: np.ndarray, is_s: np.ndarray, runs: np.ndarray, seeds: np.ndarray, seed_lcp: np.ndarray, depth: int,
           memory: int = MEMORY):
    """Yields (position, common prefix with the one before) of all suffixes in descending
    order of first bytes; inside a byte ascending. ``seeds``: LMS suffixes in order."""
    cut = np.searchsorted(text[seeds], np.arange(SYMBOLS + 1))
    up = Induction(text, ~is_s, depth, memory)
    large = []
    for s in range(SYMBOLS):
        pos, lcp = up.bucket(s)
        large.append((pos, lcp))
        own, own_lcp = seeds[cut[s]:cut[s + 1]], seed_lcp[cut[s]:cut[s + 1]].copy()
        if len(own):
            own_lcp[0] = min(runs[pos[-1]], runs[own[0]], depth) if len(pos) else 0
            up.visit(own, own_lcp)
    down = Induction(text, is_s, depth, memory)
    for s in range(SYMBOLS - 1, -1, -1):
        # descending: c is the common prefix with the suffix visited before, the next larger one
        pos, c = down.bucket(s)
        l_pos, l_lcp = large[s]
        large[s] = None
        if len(l_pos):
            back = np.append(l_lcp[1:][::-1], np.uint8(0)).astype(np.uint8)
            first = min(runs[l_pos[-1]], runs[pos[-1]], depth) if len(pos) else 0
            down.visit(l_pos[::-1], np.append(np.uint8(first), back[:len(l_pos) - 1]).astype(np.uint8))
        up_pos = pos[::-1]
        up_lcp = np.append(np.uint8(0), c[1:][::-1]).astype(np.uint8)[:len(pos)]
        if len(pos) and len(l_pos):
            up_lcp[0] = min(runs[l_pos[-1]], runs[up_pos[0]], depth)
        if len(pos) or len(l_pos):
            yield np.concatenate([l_pos, up_pos]), np.concatenate([l_lcp, up_lcp]).astype(np.uint8)


def suffix_order(text: np.ndarray, depth: int, memory: int = MEMORY):
    """``text``: uint16 symbols, the last one 0 and no other. Yields arrays (positions,
    common prefixes): by first symbol descending, and in order inside each symbol."""
    n = len(text)
    ends = np.flatnonzero(text[1:] != text[:-1]) + 1
    starts = np.append(0, ends)
    length = np.diff(np.append(starts, n))
    value = text[starts].astype(np.int32)
    run_s = np.append(value[1:] > value[:-1], True)
    is_s = scratch(n, bool, memory)
    is_s[:] = np.repeat(run_s, length)
    runs = scratch(n, np.int32, memory)  # symbols left in the run
    runs[:] = np.repeat(starts + length, length) - np.arange(n)
    lms = starts[1:][run_s[1:] & ~run_s[:-1]]
    m = len(lms)
    # sort the LMS substrings: seeds in any order inside a symbol
    seeds = lms[np.argsort(text[lms], kind="stable")]
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = [p[is_lms[p]] for p, _ in induce(text, is_s, runs, seeds, np.zeros(m, np.uint8), depth, memory)]
    order = np.concatenate([[n - 1], *order[::-1]])  # the end is induced by nothing and comes first
    # equal substrings get one name
    h = (mix(text.astype(U64) + U64(3)) * np.multiply.accumulate(np.full(n, 0x9E3779B97F4A7C15 | 1, U64)))
    sums = np.append(U64(0), np.cumsum(h))
    inverse = np.multiply.accumulate(np.full(n, pow(0x9E3779B97F4A7C15 | 1, -1, 2 ** 64), U64))
    end = np.append(lms[1:], n - 1) + 1
    span = end - lms
    value = (sums[end] - sums[lms]) * inverse[lms]
    which = np.searchsorted(lms, order)
    new = np.ones(m, bool)
    new[1:] = (value[which][1:] != value[which][:-1]) | (span[which][1:] != span[which][:-1])
    names = np.empty(m, np.int64)
    names[which] = np.cumsum(new) - 1
    # the reduced string: name pairs of neighbours until they are unique or reach the depth
    step = 1
    while names.max() + 1 < m and 2 * step < 2 * depth:
        pair = names * (m + 1) + np.append(names[step:] + 1, np.zeros(min(step, m), np.int64))[:m]
        order_ = np.argsort(pair, kind="stable")
        fresh = np.ones(m, bool)
        fresh[1:] = pair[order_][1:] != pair[order_][:-1]
        names[order_] = np.cumsum(fresh) - 1
        step *= 2
    final = np.argsort(names, kind="stable")
    seeds = lms[final]
    # common prefixes of neighbouring LMS suffixes, symbol by symbol for those still equal
    lcp = np.zeros(m, np.uint8)
    live = np.arange(1, m)
    for d in range(depth):
        a, b = seeds[live - 1] + d, seeds[live] + d
        ok = (a < n) & (b < n)
        ok[ok] = text[a[ok]] == text[b[ok]]
        live = live[ok]
        if not len(live):
            break
        lcp[live] = d + 1
    yield from induce(text, is_s, runs, seeds, lcp, depth, memory)


def earliest_equal(strings: list[bytes] | tuple[np.ndarray, np.ndarray], depth: int, memory: int = MEMORY):
    """(text, first): the symbols of the concatenated strings, and for each position the least
    position whose ``depth`` bytes are equal (itself if there is none before)."""
    raw, offs = strings
    size = np.diff(offs)
    text = scratch(len(raw) + len(size) + 1, np.uint16, memory)
    at = np.arange(len(raw)) + np.repeat(np.arange(len(size)), size)
    text[:] = 1
    text[at] = raw.astype(np.uint16) + 2
    text[-1] = 0
    first = scratch(len(text), np.int64, memory)
    first[:] = np.arange(len(text))
    for pos, lcp in suffix_order(text, depth, memory):
        heads = np.flatnonzero(lcp < depth)
        if not len(heads) or heads[0] != 0:
            heads = np.append(0, heads)
        least = np.minimum.reduceat(pos, heads)
        first[pos] = np.repeat(least, np.diff(np.append(heads, len(pos))))
    return text, first, at
