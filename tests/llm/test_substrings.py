import random

import numpy as np
import pytest

from lmplake.llm import induced as I
from lmplake.llm import substrings as S
from tests.llm.brute import repeats

SCHEMA = "doc_id long, text string, n_bytes int"


def corpus(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdeé ") for _ in range(rng.randrange(20, 90))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else
                 "".join(rng.choice("abcdefghij ") for _ in range(rng.randrange(0, 60))) for _ in range(rng.randrange(0, 6))]
        rows.append((i * 3, "".join(parts), 0))
    rows += [(500, rows[7][1], 0), (501, rows[7][1], 0), (2, None, 0), (4, "", 0), (502, "ab" * 200, 0), (503, "a" * 150, 0),
             (504, "a" * 90, 0), (None, rows[9][1], 0), (21, rows[7][1], 0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,segment", [(1, 1 << 21), (2, 37)])
def test_equals_brute_force(frame, monkeypatch, seed, segment):
    monkeypatch.setattr(S, "SEGMENT", segment)
    monkeypatch.setattr(S, "SHARD_BYTES", 300)
    rows = corpus(seed)
    out = S.remove_repeats(frame(rows, SCHEMA), length=24, with_text=True).collect()
    want = repeats([(a, b) for a, b, _ in rows], 24)
    assert len(out) == len(rows)
    for r in out:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]
        assert len(r["kept"]) == r["n_bytes"] - r["n_removed"] == r["n_bytes"] - sum(s["end"] - s["start"] for s in r["spans"])


def test_repeated_rows_and_empty(frame):
    text = "some text that is longer than the length " * 4
    rows = [(3, text, 0), (3, text, 0), (1, "", 0)]
    out = S.remove_repeats(frame(rows, SCHEMA), length=24).collect()
    want = repeats([(3, text), (1, "")], 24)
    assert sorted((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in out) == sorted(
        [(3, want[3][1], want[3][3])] * 2 + [(1, 0, want[1][3])])
    assert S.remove_repeats(frame([], SCHEMA)).collect() == []


def test_anchors_cover_each_window_once():
    raw = np.frombuffer(random.Random(4).randbytes(3000) + b"q" * 500, np.uint8)
    offs = np.array([0, 100, 100, 130, 2000, 3500])
    seen = []
    for row, s, n, _, _ in S.pieces(raw, offs, 40):
        seen += [(int(r), int(a) + k) for r, a, c in zip(row, s, n) for k in range(int(c))]
    assert sorted(seen) == [(r, k) for r in range(5) for k in range(max(0, int(offs[r + 1] - offs[r]) - 39))]


@pytest.mark.parametrize("memory", [8, 1 << 20])
def test_induced_order_equals_sorting(memory):
    rng = random.Random(memory)
    for _ in range(60):
        alphabet = rng.choice([b"a", b"ab", b"abc", bytes(range(97, 120)), b"\x00\xff"])
        strings = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(0, 50))) for _ in range(rng.randrange(1, 9))]
        strings += strings[:2]
        text = np.array([x for s in strings for x in [*(b + 2 for b in s), 1]] + [0], np.uint16)
        depth = rng.choice([3, 9, 100])
        got = list(I.suffix_order(text, depth, memory))[::-1]
        pos = np.concatenate([p for p, _ in got])
        lcp = np.concatenate([c for _, c in got])
        t = text.tolist()
        assert sorted(pos.tolist()) == list(range(len(t) - 1))  # all but the end mark
        for i in range(1, len(pos)):
            a, b = t[pos[i - 1]:pos[i - 1] + depth], t[pos[i]:pos[i] + depth]
            assert a <= b
            assert lcp[i] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_the_queue_spills_and_keeps_its_order():
    q = I.BulkQueue(memory=10)
    for i in range(50):
        q.push(5 + i % 2, np.arange(i * 10, i * 10 + 3), np.full(3, i, np.uint8))
    assert q.spilled
    pos, lcp = q.pop(5)
    assert pos.tolist() == [i * 10 + k for i in range(0, 50, 2) for k in range(3)]
    assert lcp.tolist() == [i for i in range(0, 50, 2) for _ in range(3)]
    assert len(q.pop(5)[0]) == 0


def test_one_id_for_several_texts(frame):
    """Also texts of equal short digest, and the id that stands for null inside."""
    import xxhash
    length = 20
    low, seen = {}, []
    for i in range(2000):  # two texts with the same 16 bits of digest
        t = f"text number {i} of some length " * (1 + i % 3)
        h = xxhash.xxh64(t.encode(), seed=42).intdigest() & 0xFFFF
        if h in low and len(low[h]) != len(t):
            seen = [low[h], t]
            break
        low[h] = t
    assert seen
    last = (1 << 63) - 1
    rows = [(1, seen[0]), (1, seen[1]), (1, seen[1]), (2, "x" * 50 + seen[1]), (last, seen[0] + "y" * 50), (None, "y" * 50), (None, "z"), (3, None)]
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"]) for r in
                 S.remove_repeats(frame(rows, "doc_id long, text string"), length=length).collect())
    first = sorted([r for r in rows[:2]], key=lambda r: len(r[1]))
    keyed = [((0, i) if r in first else None, r) for i, r in enumerate(rows)]
    order = {r: k for k, r in enumerate([*first, rows[3], (3, None), rows[4], *sorted(rows[5:7], key=lambda r: len(r[1]))])}
    want = repeats([(order[r], r[1]) for _, r in keyed], length)
    assert got == sorted((str(r[0]), *want[order[r]][:2]) for r in rows)
