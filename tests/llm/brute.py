"""Plain, slow versions of the operators that the tests compare with."""

from __future__ import annotations

import hashlib
from collections import Counter


def union_find(edges, nodes):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_bag(text, n=5):
    words = (text or "").lower().split()
    if not words:
        return None
    return Counter(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def weighted_jaccard(a, b):
    low = sum((a & b).values())
    return low / (sum(a.values()) + sum(b.values()) - low)


def near_classes(rows, threshold=0.8):
    bags = [(k, shingle_bag(t)) for k, t in rows if k is not None]
    edges = [(a, b) for i, (a, x) in enumerate(bags) for b, y in bags[:i]
             if x and y and weighted_jaccard(x, y) >= threshold]
    return union_find(edges, {k for k, _ in bags})


def repeats(rows, length):
    """{doc: (bytes, removed, spans, digest)}; a null key is after all others."""
    last = (1 << 63) - 1
    seen = {}
    keyed = [(last if d is None else d, (t or "").encode()) for d, t in rows]
    for d, b in sorted(keyed):
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i:i + length], (d, i))
    out = {}
    for (d, b), (name, _) in zip(keyed, rows):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] < (d, i):
                gone[i:i + length] = b"\1" * length
        rest = bytes(x for x, c in zip(b, gone) if not c)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[name] = (len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest())
    return out


def edit_distance_inside(item, passage):
    """Least Levenshtein distance between item and any substring of passage."""
    cost = [0] * (len(passage) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(passage, 1):
            new.append(min(cost[j] + 1, new[-1] + 1, cost[j - 1] + (a != b)))
        cost = new
    return min(cost)
