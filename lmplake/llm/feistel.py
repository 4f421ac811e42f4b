"""A keyed permutation of [0, n) for any n: a balanced Feistel network over the
next even number of bits, walked along its cycles until the value is below n."""

from __future__ import annotations

import numpy as np

from lmplake.llm.common import U64, mix

FEISTEL_ROUNDS = 6


def permute(x: np.ndarray, n: np.ndarray | int, key: np.ndarray | int, rounds: int = FEISTEL_ROUNDS) -> np.ndarray:
    """Images of x under the permutation of [0, n) with that key (all per row)."""
    x = np.asarray(x, U64)
    n = np.broadcast_to(np.asarray(n, U64), x.shape)
    key = mix(np.broadcast_to(np.asarray(key, U64), x.shape) + U64(1))
    half = np.ones(x.shape, U64)  # bits of each half: 4^half >= n
    while (low := (U64(1) << (half * U64(2))) < n).any():
        half = half + low.astype(U64)
    mask = (U64(1) << half) - U64(1)
    out, live = x.copy(), np.arange(len(x))
    while len(live):
        h, m, k = half[live], mask[live], key[live]
        left, right = out[live] >> h, out[live] & m
        for r in range(rounds):
            left, right = right, left ^ (mix(right ^ (k + U64(r * 0x632BE59BD9B4E019 % 2 ** 64))) & m)
        out[live] = (left << h) | right
        live = live[out[live] >= n[live]]
    return out.astype(np.int64)
